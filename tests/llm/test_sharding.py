import hashlib
import math
import zlib
from collections import Counter

from brandtrack.llm import sharding as sh


def draw(key, node):
    digits = hashlib.md5(f"{key}:{node.name}".encode()).hexdigest()[:13]
    return -math.log((int(digits, 16) + 0.5) / 2**52) / node.weight


def least(key, node):
    """A node's draw: the least below it."""
    return min(least(key, c) for c in node.children) if node.children else draw(key, node) if node.weight else math.inf


def descend(key, node):
    while node.children:
        node = min(node.children, key=lambda c: least(key, c))
    return node.shard


def placed(spark, tree, n=3000):
    docs = spark.range(n).selectExpr("id as doc_id", "cast(id as string) as text")
    return {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in sh.assign(docs, tree).collect()}


def test_shards_equal_plain_descent(spark):
    for tree in (sh.even_tree(8), sh.even_tree(5, 3), sh.reweigh(sh.even_tree(8), {0: 3.0, 5: 0.0})):
        got = placed(spark, tree, 400)
        grown = sh.grow(tree)
        assert got == {i: (descend(i, tree), descend(i, grown)) for i in range(400)}


def test_a_new_shard_takes_rows_only_into_itself(spark):
    for n in (1, 7, 8):
        got = placed(spark, sh.even_tree(n))
        moved = [(a, b) for a, b in got.values() if a != b]
        assert {b for _, b in moved} == {n}
        assert abs(len(moved) / 3000 - 1 / (n + 1)) < 0.05


def test_the_law_holds_from_any_number_of_shards_to_the_next(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "cast(id as string) as text")
    before = None
    for n in range(1, 18):
        got = {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in sh.assign(docs, sh.even_tree(n)).collect()}
        if before:
            assert all(got[i][0] == grown for i, (_, grown) in before.items()), n
            assert all(got[i][0] in (shard, n - 1) for i, (shard, _) in before.items())
        before = got


def test_rows_of_one_id_do_not_share_a_slice(spark):
    rows = [(None, f"text {i}") for i in range(4000)] + [(1, f"other {i}") for i in range(100)]
    docs = sh.assign(spark.createDataFrame(rows, "doc_id long, text string"), sh.even_tree(2))
    slices = docs.groupBy(sh._slice("doc_id")).count().agg({"count": "max"}).first()[0]
    assert slices < 40
    got = sh.with_slots(docs).collect()
    for shard in range(2):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_columns_of_any_name_pass_through(spark):
    names = ["_shard", "_slice", "_place", "_first", "_rows", "_row", "_id", "_size", "_text_crc32"]
    docs = spark.createDataFrame([(i, f"t{i}", *range(9)) for i in range(30)], f"doc_id long, text string, {', '.join(f'{n} int' for n in names)}")
    got = sh.shard_documents(docs)
    assert got.columns == [*docs.columns, "size", "text_crc32", "law", "shard", "grown_shard", "slot"]
    assert {tuple(r)[2:11] for r in got.collect()} == {tuple(range(9))}


def test_shares_follow_weights_and_changes_stay_in_their_subtree(spark):
    tree = sh.even_tree(8)
    changed = sh.reweigh(tree, {2: 2.0, 3: 0.0})
    before, after = placed(spark, tree), placed(spark, changed)
    moved = [(before[i][0], after[i][0]) for i in before if before[i][0] != after[i][0]]
    assert moved and all(a == 3 or b == 2 for a, b in moved)
    assert not any(a == 2 or b == 3 for a, b in moved)
    heavy = Counter(s for s, _ in placed(spark, sh.reweigh(tree, {0: 5.0}), 6000).values())
    assert abs(heavy[0] / 6000 - 5 / 12) < 0.03
    assert abs(heavy[7] / 6000 - 1 / 12) < 0.02


def test_digest_columns(spark):
    rows = [(i, f"text é {i}" * (i % 5)) for i in range(500)] + [(7, "other"), (7, "other"), (8, None), (None, None), (None, "a")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, shard string, size int")
    got = sh.digest(docs).collect()
    assert sh.digest(docs).columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    want = Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", descend("null" if i is None else i, sh.even_tree(8)))
        for i, t in rows
    )
    assert Counter(tuple(r)[:5] for r in got) == want
    for shard in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert sh.digest(docs.limit(0)).collect() == []


def test_documents_keep_their_columns_and_are_written_by_shard(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * i, "en", i) for i in range(40)], "doc_id long, text string, lang string, slot int")
    placed = sh.shard_documents(docs)
    assert set(placed.columns) == {*docs.columns, "size", "text_crc32", "law", "shard", "grown_shard"}
    sh.write_shards(placed, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 40 and {p.name for p in (tmp_path / "shards").glob("shard=*")} <= {f"shard={i}" for i in range(8)}
