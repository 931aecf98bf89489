import hashlib
import random

import pyarrow as pa
import pytest

from brandtrack.llm import line_dedup as ld
from brandtrack.llm.tables import Workspace

BLANKS = " \t\n\x0b\x0c\r"
UP = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def key(line):
    return line.strip(BLANKS).translate(UP)


def plain(rows):
    """Result rows by counting, without hashes, ranges or bitmaps."""
    held = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            held.setdefault(key(line), set()).add(doc)
    size = lambda doc: (doc is not None, doc or 0)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keep = [
            line for line in lines
            if not (len(key(line)) >= 20 and len(held[key(line)]) >= 3 and doc != max(held[key(line)], key=size))
        ]
        out.append((doc, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, pos int, kept string")


def check(spark, rows):
    got = ld.digest(frame(spark, rows))
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows)


def test_hand_made_documents(spark):
    long = "This line is long enough, É"
    rows = [
        (1, f"{long}\nshort\n\t {long.upper().replace('É', 'É')} \r"),
        (2, f"a\n{long}\n\n"),
        (9, f"{long}\n{long}\nb"),
        (4, "only in two documents, so it stays\nx"),
        (5, "only in two documents, so it stays"),
        (6, None),
        (7, ""),
        (8, "\n"),
        (None, f"{long}\nz"),
        (None, f"{long}"),
        (3, "one document twice, so it stays"), (3, "one document twice, so it stays\n!"), (10, "one document twice, so it stays"),
        (11, "nineteen characters"), (12, "nineteen characters"), (13, "nineteen characters"),
        (14, "twenty characters 20"), (15, "  twenty characters 20\x0b"), (16, "TWENTY characters 20"), (16, "TWENTY characters 20"),
        (17, "é" * 20), (18, "é" * 20), (19, "É" * 20), (20, "é" * 20),
    ]
    check(spark, rows)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_random_documents_over_many_ranges(spark, parts):
    rng = random.Random(parts)
    common = [f"common line number {i} of the test" for i in range(6)]
    rows = []
    for i in range(300):
        n = rng.randrange(0, 9)
        lines = [common[int(rng.random() ** 3 * 6)] if rng.random() < 0.6 else f"line {rng.randrange(150)} that may repeat" for _ in range(n)]
        rows.append((rng.choice([None, i, i, i, i % 20]), "\n".join(lines)))
    rows += rows[:40]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def found_in(rows, cuts, sizes):
    """What the streams of the sorted rows give, cut into ranges and these into batches."""
    out, parts = [], [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    schema = pa.schema({"high": pa.int64(), "low": pa.int64(), "known": pa.bool_(), "doc": pa.int64(), "text_hash": pa.int64(), "pos": pa.int32(), "n_lines": pa.int32()})
    for part, own in enumerate(parts):
        batches = [pa.RecordBatch.from_pylist(own[i : i + sizes], schema=schema) for i in range(0, len(own), sizes)]
        for batch in ld.stream_range(iter(batches), part):
            out += batch.to_pylist()
    return out


def test_any_cut_into_ranges_and_batches_gives_the_same_rows():
    rng = random.Random(3)
    for _ in range(300):
        rows = [
            {"high": rng.randrange(4), "low": rng.randrange(2), "known": True, "doc": rng.randrange(6), "text_hash": 0, "pos": p, "n_lines": 99}
            for p in range(rng.randrange(1, 30))
        ]
        rows.sort(key=lambda r: (r["high"], r["low"], -r["doc"], r["pos"]))
        held = {}
        for r in rows:
            held.setdefault((r["high"], r["low"]), set()).add(r["doc"])
        of = lambda r: held[r["high"], r["low"]]
        want = {r["pos"] for r in rows if len(of(r)) >= 3 and r["doc"] != max(of(r))}
        cuts = sorted(rng.randrange(len(rows) + 1) for _ in range(rng.randrange(4)))
        found = found_in(rows, cuts, rng.randrange(1, 6))
        reports = {}
        for r in (r for r in found if r["kind"] == "run"):
            reports.setdefault((r["high"], r["low"]), []).append(r)
        got = {r["pos"] for r in found if r["kind"] == "drop"}
        for r in (r for r in found if r["kind"] == "open"):
            own = sorted(reports[r["high"], r["low"]], key=lambda x: x["part"])
            total = sum(x["n_docs"] for x in own) - sum(a["last_doc"] == b["doc"] for a, b in zip(own, own[1:]))
            if total >= 3 and r["doc"] != own[0]["doc"]:
                got.add(r["pos"])
        assert got == want
        assert len([r for r in found if r["kind"] == "run"]) <= 2 * (len(cuts) + 1)


def test_bitmaps_are_small_and_come_back():
    for n, dropped in ((1, [0]), (9, [3, 8]), (100_000, list(range(0, 100_000, 1000)))):
        bitmap = ld.pack(dropped, n)
        kept = ld.unpack(bitmap, n)
        assert [i for i in range(n) if not kept[i]] == dropped
    assert len(bitmap) < 1000


def test_bitmaps_only_for_rows_that_lose_lines_and_other_columns_pass(spark):
    line = "a line that four documents share"
    rows = [(i, f"{line}\nown {i}") for i in range(4)] + [(9, None), (8, "x")]
    docs = frame(spark, rows)
    bitmaps = ld.keep_bitmaps(docs, Workspace(spark)).collect()
    assert sorted((r["doc"], r["n_lines"], r["n_dropped"]) for r in bitmaps) == [(0, 2, 1), (1, 2, 1), (2, 2, 1)]
    got = ld.drop_lines(docs)
    assert got.columns == docs.columns
    want = [(0, "own 0"), (1, "own 1"), (2, "own 2"), (3, f"{line}\nown 3"), (8, "x"), (9, None)]
    assert sorted(tuple(r) for r in got.collect()) == [(*r, 1, "x") for r in want]
    assert ld.digest(docs.limit(0)).collect() == []
