import random
import re
from collections import Counter

from brandtrack.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "n_lines": len(lines),
    }


def texts():
    rng = random.Random(11)
    found = [None, "", " \n\t", "a", "one two\none two\n\n one two", "x " * 7, "x " * 8, "x " * 9, "é#ß|\x0bz\x85w\xa0q 🙂"]
    for _ in range(150):
        words = [rng.choice("a b c dd ee é # % \n \t | <x>".split(" ")) for _ in range(rng.randrange(60))]
        text = rng.choice([" ", "\n", "  "]).join(words)
        found.append(text * rng.choice([1, 1, 2]))
    found.append(" ".join(f"w{k % 700}" for k in range(20_000)))
    return found


def test_measurements_equal_plain_counting(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_words string")
    got = {r["doc_id"]: r.asDict() for r in qr.ledger(docs).collect()}
    for i, text in rows:
        want = measured(text)
        assert {k: got[i][k] for k in want} == want, text
        scope = {k: v for k, v in want.items()}
        failed = {r.name for r in qr.RULES if eval(r.fails, {}, scope)}  # noqa: S307
        assert got[i]["failure_bits"] == qr.mask(failed)


def test_verdicts_follow_the_policy(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    book = qr.ledger(docs).cache()
    for version, names in qr.POLICIES.items():
        for row in qr.apply_policy(book, version).collect():
            assert row["kept"] == (row["failure_bits"] & qr.mask(names) == 0)
    for row in qr.digest(docs).collect():
        assert not (row["base_failed"] and row["kept"])
        assert row["base_failed"] == (row["n_words"] < 20 or 100 * row["n_repeat_words"] > 30 * row["n_words"])


def test_ablations_equal_counting_row_by_row(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    book = qr.ledger(docs)
    bits = [r["failure_bits"] for r in book.collect()]
    got = {(r["policy"], r["rule"]): r for r in qr.ablations(book).collect()}
    for version, names in qr.POLICIES.items():
        for name in names:
            one, rest = qr.mask([name]), qr.mask([n for n in names if n != name])
            row = got.pop((version, name))
            assert row["n_failed"] == sum(b & one != 0 for b in bits)
            assert row["n_failed_alone"] == sum(b & one != 0 and b & rest == 0 for b in bits)
            assert row["n_kept_without"] == sum(b & rest == 0 for b in bits)
    assert not got


def test_repeated_rows_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id long, text string")
    assert qr.digest(docs).count() == 3
    assert qr.digest(docs.limit(0)).collect() == []
    assert qr.ablations(qr.ledger(docs.limit(0))).collect() == []
