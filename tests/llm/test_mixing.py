import random

import duckdb
import pytest

from brandtrack.llm import check_sql, mixing


def rows(seed, n=300):
    rng = random.Random(seed)
    found = []
    for i in range(n):
        source = rng.choice(["src0"] * 6 + ["src1", "src2", "src3", "src9", None])
        lang = rng.choice(["en", "en", "de", None])
        text = rng.choice([None, "", "w " * rng.randrange(1, 40), "w\t" * rng.randrange(200)])
        found.append((rng.choice([i, i, i, None]), text, lang, source))
    return found + found[:20]


MIXES = [
    mixing.PRODUCTION,
    mixing.Mix(domains={"src1": "a", "src9": "b"}, weights={("a",): 9, ("b",): 0}, share_num=9, share_den=10, max_epochs=1),
    mixing.Mix(domains={"src1": "a"}, weights={("a",): 50, ("web", "de"): 7}, share_num=3, share_den=2, max_epochs=4),
    mixing.Mix(share_num=100, share_den=1, max_epochs=2),
]


@pytest.mark.parametrize("k", range(len(MIXES)))
def test_choice_equals_the_sql(spark, k):
    data = rows(k)
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    got = sorted(map(repr, (tuple(r) for r in mixing.digest(docs, MIXES[k]).collect())))
    given = docs.toArrow()  # noqa: F841
    want = duckdb.sql(check_sql.mix_sql(MIXES[k], "given")).fetchall()
    assert got == sorted(map(repr, want))


def leaves(spark, *found):
    return spark.createDataFrame(found, "domain string, lang string, source string, tokens long")


def test_shortages_go_to_siblings_before_other_subtrees(spark):
    table = leaves(
        spark, ("x", "en", "a", 10), ("x", "en", "b", 1000), ("x", "de", "c", 1000), ("y", "en", "d", 1000)
    )
    mix = mixing.Mix(share_num=1200, share_den=3010, max_epochs=1)
    got = {r["source"]: r["budget"] for r in mixing.leaf_budgets(table, mix).collect()}
    # 600 to each domain, 300 to each language of x; what a cannot take goes to b alone
    assert got == {"a": 10, "b": 290, "c": 300, "d": 600}


def test_a_short_subtree_passes_its_rest_upwards(spark):
    table = leaves(spark, ("x", "en", "a", 10), ("x", "de", "b", 20), ("y", "en", "c", 1000), ("z", "en", "d", 1000))
    mix = mixing.Mix(weights={("y",): 2}, share_num=630, share_den=2030, max_epochs=1)
    got = {r["source"]: r["budget"] for r in mixing.leaf_budgets(table, mix).collect()}
    assert got == {"a": 10, "b": 20, "c": 400, "d": 200}


def test_epochs_repeat_documents_and_keep_within_the_budget(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "en", "s") for i in range(50)], "doc_id long, text string, lang string, source string")
    mix = mixing.Mix(share_num=5, share_den=2, max_epochs=3)
    copies = [r["copies"] for r in mixing.mix_documents(docs, mix).collect()]
    assert sum(copies) == 125 and set(copies) == {2, 3}
    other = mixing.Mix(share_num=5, share_den=2, max_epochs=3, seed=99)
    first = {r["doc_id"] for r in mixing.mix_documents(docs, mix).filter("copies = 3").collect()}
    assert first != {r["doc_id"] for r in mixing.mix_documents(docs, other).filter("copies = 3").collect()}


def test_columns_pass_through_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, "a b", "en", "s", "x", "y")], "doc_id long, text string, lang string, source string, extra string, n_tokens string"
    )
    got = mixing.mix_documents(docs, mixing.Mix(share_num=1, share_den=1)).collect()
    assert got[0].asDict() == {
        "doc_id": 1, "text": "a b", "lang": "en", "source": "s", "extra": "x", "domain": "web", "n_tokens": 2, "copies": 1
    }
    assert mixing.mix_documents(docs.limit(0)).collect() == []


def test_columns_of_any_name_pass_through(spark):
    names = ["domain", "n_tokens", "copies", "row", "epochs", "cut", "text_key", "_copy", "cut_domain", "_mix_cut"]
    data = [(*r, *["mine"] * len(names)) for r in rows(1, 60)]
    docs = spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, {', '.join(f'{n} string' for n in names)}")
    got = mixing.choose(docs, MIXES[1]).select("row.*")
    assert got.columns == docs.columns and got.count() > 5
    assert {tuple(r)[4:] for r in got.collect()} == {("mine",) * len(names)}
    plain = mixing.digest(docs.drop(*names), MIXES[1])
    assert sorted(r["doc_id"] or 0 for r in got.collect()) == sorted(r["doc_id"] or 0 for r in plain.collect())
