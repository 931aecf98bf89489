import hashlib
import random
import zlib

import numpy as np
import pytest

from brandtrack.llm import prefix_trie as pt

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(seqs):
    """Nodes of ``{conv_id: [(role, text), ...]}`` by looking at every prefix."""
    nodes = {}
    for c, turns in seqs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        under = [p for p in nodes if p[: len(path)] == path]
        ends = ",".join(str(c) for c in sorted(c for c in members if len(seqs[c]) == len(path)))
        out.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
            sum(len(p) == len(path) + 1 for p in under), sum(not any(q[:-1] == p for q in nodes if q) for p in under),
            sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in under if p), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def in_order(rows):
    said = lambda r: (r or "", )
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()[:30]
            convs.setdefault(c, []).append((turn is not None, turn or 0, mark, role, text))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn int, role string, text string, depth int, ends string")


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_rows(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(6)))
        rows += [(c, i, rng.choice("uua"), t) for i, t in enumerate(text)]
        rows += [(c, rng.choice([None, 2, 99]), None, rng.choice([None, "", "é"]))] * rng.randrange(3)
    return rows


@pytest.mark.parametrize("parts", [1, 9, 60])
def test_nodes_equal_plain_prefixes(spark, parts):
    rows = random_rows(parts) + [(None, 1, "user", "a"), (10**12, 1, "user", "far")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        convs = in_order(rows)
        assert got(pt.digest(frame(spark, rows))) == plain(rebuilt(convs))
        if parts == 9:
            assert got(pt.conversation_trie(frame(spark, rows))) == plain(convs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_small_cases(spark):
    assert pt.digest(frame(spark, []).limit(0)).collect() == []
    assert got(pt.digest(frame(spark, [(None, 1, "u", "a")]))) == []
    # conversation 7 takes all its turns from conversation 5, which is absent: it has none
    assert zlib.crc32(b"7") % 9 > 1
    only = got(pt.digest(frame(spark, [(7, 0, "u", "a")])))
    assert only == [(7, 0, None, 1, 0, 1, 0, hashlib.sha256(b"7").hexdigest())]
    same = [(5 * i, t, "u", "hello") for i in range(30) for t in range(3)]
    assert got(pt.conversation_trie(frame(spark, same))) == plain(in_order(same))
    long = [(0, t, "u", f"turn {t}") for t in range(3000)] + [(5, t, "u", f"turn {t}") for t in range(2999)]
    nodes = got(pt.conversation_trie(frame(spark, long)))
    assert len(nodes) == 3001 and sum(n[3] for n in nodes) == 3001 + 3000


def test_children_of_broadcast_and_of_salted_seams_are_the_same(spark, monkeypatch):
    rows = random_rows(5, 60)
    want = got(pt.digest(frame(spark, rows)))
    monkeypatch.setattr(pt, "MOST_SEAMS", 0)
    assert got(pt.digest(frame(spark, rows))) == want


def test_packed_arrays_hold_each_node_once_and_nothing_else():
    rng = random.Random(1)
    for _ in range(60):
        wide = rng.choice([2, 5, 300])
        seqs = sorted({tuple(rng.randrange(wide) for _ in range(rng.randrange(6))) for _ in range(rng.randrange(1, 400))})
        flat = np.array([x for s in seqs for x in s], dtype=np.int64)
        ids = pt.turn_ids(np.stack([flat, flat], axis=1))
        lengths = np.array([len(s) for s in seqs])
        begins = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        levels, codes = pt.make_dense(pt.grow_levels(ids, begins, lengths), ids)
        prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)} | {()}
        assert len(levels.parent) == len(prefixes)
        trie = pt.pack(levels)
        assert len(set(trie.slots.tolist())) == len(prefixes) and (trie.check >= 0).sum() == len(prefixes) - 1
        assert len(trie.check) <= 3 * (len(prefixes) + wide)
        code_of = dict(zip(flat.tolist(), codes.tolist()))
        for _ in range(200):
            path = tuple(rng.randrange(wide + 1) for _ in range(rng.randrange(6)))
            state = np.zeros(1, np.int64)
            for x in path:
                state = trie.step(state, np.array([code_of.get(x, -1)]))
                if state[0] < 0:
                    break
            assert (state[0] >= 0) == (path in prefixes)


def test_ids_are_hashed_as_a_stream(spark):
    ids = [3 * i for i in range(9000)]
    rows = [(i, 0, "u", "same") for i in ids]
    nodes = got(pt.conversation_trie(frame(spark, rows)))
    want = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert nodes[1][3] == 9000 and nodes[1][7] == want
