import random
import re
from collections import Counter

import numpy as np

from brandtrack.llm import decontamination as dc


def bag(words, n=5):
    n = min(n, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else Counter()


def alike(a, b):
    weigh = lambda s: sum(map(len, s))
    common = sum(weigh(s) * min(n, b[s]) for s, n in a.items())
    total = sum(weigh(s) * n for s, n in (a + b).items())
    return common / (total - common)


def brute(text, items):
    """Items with an alike window, over all windows."""
    words = re.findall(r"\w+", (text or "").lower())
    found = set()
    for i, item in items:
        own = re.findall(r"\w+", (item or "").lower())
        size = min(len(own), len(words))
        n = min(5, len(own))
        if not own or len(words) < n:
            continue
        for k in range(len(words) - size + 1):
            if alike(bag(words[k : k + size], n), bag(own, n)) >= dc.SIMILAR:
                found.add(i)
    return found


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7)))
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 4, 5, 6, 15, 30, 60])))) for i in range(25)]
    docs = []
    for i in range(80):
        words = [word() for _ in range(rng.randrange(80))]
        for _ in range(rng.randrange(3)):
            passage = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                at = rng.randrange(len(passage))
                passage[at : at + 1] = rng.choice([[word()], [], [word(), passage[at]]])
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(words).replace("b", rng.choice("bB"))))
    return items, docs


def test_matches_equal_brute_force_over_all_windows():
    for seed in range(4):
        items, docs = corpus(seed)
        index, shingler = dc.index_items(items), dc.Shingler()
        for _, text in docs:
            got = {index.ids[k] for k, *_ in dc.find(text, index, shingler)}
            assert got == brute(text, items), text


def flipped(rng, prints, n_bits):
    out = prints.copy()
    for bit in rng.choice(256, n_bits, replace=False).tolist():
        out[bit // 64] ^= np.uint64(1 << (bit % 64))
    return out


def test_the_tables_find_everything_within_the_radius_and_little_else():
    rng = np.random.default_rng(1)
    items = dc.index_items([(i, " ".join(f"w{rng.integers(1000)}" for _ in range(30))) for i in range(300)])
    for _ in range(300):
        k, n_bits = int(rng.integers(300)), int(rng.integers(0, dc.RADIUS + 1))
        window, item = items.near(flipped(rng, items.prints[k], n_bits)[None, :], 30)
        assert k in item.tolist()
        assert not items.near(flipped(rng, items.prints[k], n_bits)[None, :], 29)[0].size
    others = rng.integers(0, 1 << 63, size=(100, 4), dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, size=(100, 4), dtype=np.uint64)
    met = set()
    for k, table in enumerate(items.tables):
        met |= set(zip(*(x.tolist() for x in table.look_up(others.view(np.uint16)[:, k]))))
    assert len(met) < 0.2 * 100 * 300


def test_candidates_come_from_the_tables():
    items, docs = corpus(2)
    index, shingler = dc.index_items(items), dc.Shingler()
    assert any(dc.find(text, index, shingler) for _, text in docs)
    index.tables = []
    assert not any(dc.find(text, index, shingler) for _, text in docs)


def test_repeated_items_are_collected_once_and_large_indexes_are_split(spark, monkeypatch):
    items, docs = corpus(4)
    benchmark = spark.createDataFrame(items * 50, "item_id long, text string")
    (whole,) = dc.item_blocks(benchmark)
    assert len(whole.ids) == len(items)
    monkeypatch.setattr(dc, "INDEX_BYTES", whole.nbytes - 1)
    assert sorted(i for part in dc.item_blocks(benchmark) for i in part.ids) == sorted(i for i, _ in items)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in dc.matches(frame, benchmark).collect())
    assert got == sorted((d, i) for d, t in docs for i in brute(t, items))
    monkeypatch.setattr(dc, "ITEM_BYTES", 100)
    assert len(list(dc.item_blocks(benchmark))) > 5


def test_rows_nulls_copies_and_blocks_of_items(spark, monkeypatch):
    items, docs = corpus(9)
    items = [*items, (None, "some item without a number that still is one"), (99, None), (98, "")]
    rows = [*docs, docs[0], (None, items[5][1]), (None, None), (500, ""), (501, "Some item, without a number that still is one!")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, item_id string")
    want = sorted(((d, i) for d, t in rows for i in brute(t, items)), key=repr)
    got = dc.matches(frame, benchmark)
    assert sorted(((r["doc_id"], r["item_id"]) for r in got.collect()), key=repr) == want
    monkeypatch.setattr(dc, "ITEM_BLOCK", 7)
    again = dc.matches(frame, benchmark)
    assert sorted(((r["doc_id"], r["item_id"]) for r in again.collect()), key=repr) == want
    left = dc.drop_contaminated(frame, benchmark)
    assert left.columns == frame.columns
    kept = [(i, t) for i, t in rows if not brute(t, items)]
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=repr) == sorted(kept, key=repr)
    assert dc.matches(frame.limit(0), benchmark).collect() == []
    assert dc.matches(frame, benchmark.limit(0)).collect() == []
    assert dc.drop_contaminated(frame, benchmark.limit(0)).count() == len(rows)
