import math
import random

import numpy as np
import pytest

from brandtrack.llm import hard_negatives as hn

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows):
    """Result rows by scoring all pairs of anchors and rows with Python's integers."""
    kept = set()
    for i, e, label in rows:
        if i is not None and label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            kept.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in e)))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for a in kept:
        if a[0] % 100:
            continue
        positives = sorted((-dot(a[2], r[2]), r[0]) for r in kept if r != a and r[1] == a[1])[:5]
        for p, i in positives:
            inside = sorted((-dot(a[2], r[2]), r[0]) for r in kept if r[1] != a[1] and 30 * -p <= 100 * dot(a[2], r[2]) <= 90 * -p)
            out += [(a[0], i, rank, n, -p, -s) for rank, (s, n) in enumerate(inside[:10], 1)]
    return sorted(out)


def frame(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, vec int, leaf string"
    return spark.createDataFrame([(*r, 1, "x") for r in rows], schema)


def check(spark, rows):
    got = hn.digest(frame(spark, rows))
    assert got.columns == COLUMNS
    found = sorted(tuple(r) for r in got.collect())
    assert found == plain(rows)
    return found


def random_rows(seed, n=700, dim=6, labels=10):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = (centres[label] + rng.normal(size=dim) * 0.7).astype(np.float32) / 4
        rows.append((i, [float(x) for x in v], label))
    return rows


@pytest.mark.parametrize("seed, leaf, block", [(1, 20, 64), (2, 24, 16_384)])
def test_all_windows_equal_brute_force(spark, monkeypatch, seed, leaf, block):
    monkeypatch.setattr(hn, "LEAF", leaf)
    monkeypatch.setattr(hn, "BLOCK_ROWS", block)
    monkeypatch.setattr(hn, "SAMPLE", 300)
    monkeypatch.setattr(hn, "SCORES", 500)
    assert len(check(spark, random_rows(seed))) > 100


def test_nulls_ties_repeated_rows_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = random_rows(3, 150, 3, 4)
    rows += [(None, [1.0, 1.0, 1.0], 1), (300, None, 1), (400, [1.0, 1.0, 1.0], None), (500, [1.0, None, 1.0], 1)]
    rows += [(600, [nan, 1.0, 1.0], 1), (701, [inf, 1.0, 1.0], 2), (800, [], 2), (900, [0.5], 1), (1000, [0.0, 0.0, 0.0], 1)]
    rows += [(1100 + i, [0.25, 0.25, -0.5], i % 3) for i in range(40)]  # one vector, many ids
    rows += [(1100, [0.25, 0.25, -0.5], 0)] * 30 + [(100, [0.1, 0.9, 0.0], 1), (100, [0.1, 0.9, 0.0], 2)]
    check(spark, rows)


def test_empty_tables_and_tables_without_anchors_or_partners(spark):
    assert check(spark, [(1, None, 1)]) == []
    assert hn.digest(frame(spark, random_rows(1, 3)).limit(0)).collect() == []
    assert check(spark, [(i, [1.0, 0.0], 1) for i in range(1, 9)]) == []
    assert check(spark, [(100, [1.0, 0.0], 1), (3, [0.5, 0.5], 1)]) == []
    assert check(spark, [(100, [1.0, 0.0], 1)]) == []


def test_scores_beyond_doubles_are_exact_and_beyond_64_bits_an_error(spark):
    big = float(2**19)
    rows = [(100, [big, 1.0], 1), (1, [big, 1.0], 1), (2, [big / 2, 1.0], 2), (3, [big / 2, 0.5], 3), (4, [big * 0.875, 3.0], 2)]
    assert len(check(spark, rows)) == 3
    with pytest.raises(ValueError, match="64 bits"):
        hn.digest(frame(spark, [(100, [3e30, 1.0], 1), (1, [1.0, 1.0], 1)])).collect()


def test_ranges_leave_out_leaves_but_no_vector_in_the_window():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 4)) * 300
    points = np.round(centres[rng.integers(8, size=3000)] + rng.normal(size=(3000, 4)) * 15)
    tree = hn.Tree(points[:600], (points**2).sum(axis=1).max(), leaf=40)
    leaves = tree.descend(points)
    anchors = points[:200]
    scores = anchors @ points.T
    high = np.quantile(scores, 0.97, axis=1)
    low = np.quantile(scores, 0.95, axis=1)
    reached = tree.reach(anchors, low, high)
    inside = (scores >= low[:, None]) & (scores <= high[:, None])
    for a in range(len(anchors)):
        assert reached[a, leaves[inside[a]]].all()
    assert reached.mean() < 0.6  # of all pairs of anchors and leaves


def test_every_leaf_has_its_rows_and_equal_points_make_one_leaf():
    same = np.ones((500, 3))
    tree = hn.Tree(same, 3.0)
    assert tree.n_leaves == 1 and not tree.nodes
    rng = random.Random(2)
    points = np.array([[rng.randrange(50) for _ in range(3)] for _ in range(900)], dtype=float)
    tree = hn.Tree(points, (points**2).sum(axis=1).max(), leaf=10)
    assert set(tree.descend(points).tolist()) <= set(range(tree.n_leaves))
    assert tree.n_leaves > 20
