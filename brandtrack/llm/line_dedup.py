"""Removal of lines that many documents share.

A line's key is the line without white space at its ends, A-Z in lower case. Long keys that enough documents hold stay
in the largest document that holds them and go from all others. The hashes of the keys are dealt out by range, sorted
by document (largest first) and position, and each range is streamed once: the first document of a key keeps it, and
what follows goes as soon as a third document has come. A common key may fill several ranges, as ranges are cut
by document and position too. So each task reports its first and its last key beside its rows; these two rows a
task, joined up, settle the rows at the seams. What comes out is a compressed bitmap of the lines to keep for
each document that loses some, not text; ``drop_lines`` applies bitmaps.

Defined results: a null text is one empty line; a null id is one document, smaller than all others; rows of one id are
one document, which keeps its lines in all rows if it is the largest; repeated rows have one bitmap between them and
keep their number; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from .tables import Workspace

#: The least length of a key, in how many documents it must be, and the white space around lines.
LEAST_CHARS = 20
LEAST_DOCS = 3
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ROW = ("known", "doc", "text_hash")
OCCURRENCE = ("high", "low", *ROW, "pos", "n_lines")
#: What a task reports: rows to drop, rows at a seam (``open``) and its first and last key (``run``).
FOUND = (
    "kind string, part int, high long, low long, known boolean, doc long, text_hash long, pos int, n_lines int, "
    "n_docs long, last_known boolean, last_doc long"
)


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _row_columns(id_col: str, text_col: str) -> list[Column]:
    """What tells rows apart: the id, which may be null, and a hash of the text."""
    return [
        F.col(id_col).isNotNull().alias("known"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc"),
        F.xxhash64(_text(text_col)).alias("text_hash"),
    ]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line whose key is long enough: 120 bits of the key's hash, the row it is in, its position."""
    lines = F.split(_text(text_col), "\n")
    each = docs.select(*_row_columns(id_col, text_col), lines.alias("lines"), F.monotonically_increasing_id().alias("at"))
    each = each.select(*ROW, "at", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    keyed = each.withColumn("key", line_key(F.col("line"))).filter(F.char_length("key") >= LEAST_CHARS)
    digest = F.md5("key")
    high, low = (F.conv(F.substring(digest, start, 15), 16, 10).cast("long") for start in (1, 16))
    return keyed.select(high.alias("high"), low.alias("low"), *ROW, "pos", "n_lines", "at")


class _Run:
    """The key that a stream is in: how many documents it has had, and rows of its second one that wait for a third."""

    def __init__(self, is_first: bool, head: dict):
        self.is_first, self.head, self.n_docs, self.last = is_first, head, 0, head
        self.waiting: list[pa.RecordBatch] = []

    def report(self, part: int) -> dict:
        ends = {"last_known": self.last["known"], "last_doc": self.last["doc"]}
        return {"kind": "run", "part": part, "n_docs": self.n_docs, **self.head, **ends}


SCHEMA = pa.schema(
    {
        "kind": pa.string(), "part": pa.int32(), "high": pa.int64(), "low": pa.int64(), "known": pa.bool_(),
        "doc": pa.int64(), "text_hash": pa.int64(), "pos": pa.int32(), "n_lines": pa.int32(),
        "n_docs": pa.int64(), "last_known": pa.bool_(), "last_doc": pa.int64(),
    }
)


def _found(rows: pa.RecordBatch, kind: str, part: int) -> pa.RecordBatch:
    n = rows.num_rows
    own = {"kind": pa.array([kind] * n, pa.string()), "part": pa.array([part] * n, pa.int32())}
    columns = {**own, **{name: rows.column(name) for name in OCCURRENCE}}
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in SCHEMA], schema=SCHEMA)


def stream_range(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
    """One sorted range of occurrences: its rows to drop, the rows that its neighbours decide, its first and last key.

    Of the first key nothing is known here, as it may have begun in the range before. Of the last key only the rows of
    its second document are open, and only while there is no third.
    """
    names = ("high", "low", "known", "doc")
    first = run = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        values = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]

        def row(at: int) -> dict:
            return {c: v[at].item() for c, v in zip(names, values)}  # noqa: B023

        is_start = run is None
        run = run or _Run(True, row(0))
        moved = [np.concatenate(([v[0] != run.last[c]], v[1:] != v[:-1])) for c, v in zip(names, values)]
        new_run = moved[0] | moved[1]
        new_doc = new_run | moved[2] | moved[3]
        new_doc[0] |= is_start
        number = np.cumsum(new_run)  # 0: the key that the stream was in
        counted = np.cumsum(new_doc)
        start = np.maximum.accumulate(np.where(new_run, np.arange(n), -1))
        rank = counted - np.where(start >= 0, counted[start] - 1, -run.n_docs)
        final = np.zeros(number[-1] + 1, dtype=np.int64)
        np.maximum.at(final, number, rank)

        is_open = (number == 0) & run.is_first
        drop = ~is_open & (rank > 1) & (final[number] >= LEAST_DOCS)
        if number[0] == 0:
            at = int(np.searchsorted(number, 1)) - 1
            run.n_docs, run.last = int(rank[at]), row(at)
            if run.n_docs >= LEAST_DOCS:
                yield from (_found(rows, "drop", part) for rows in run.waiting)
                run.waiting = []
        for kind, chosen in (("drop", drop), ("open", is_open)):
            if chosen.any():
                yield _found(batch.filter(pa.array(chosen)), kind, part)
        if number[-1] > 0:
            first = first or run
            run = _Run(False, row(int(start[-1])))
            run.n_docs, run.last = int(rank[-1]), row(n - 1)
        if not run.is_first and run.n_docs < LEAST_DOCS:
            waiting = (number == number[-1]) & (rank > 1)
            if waiting.any():
                run.waiting.append(batch.filter(pa.array(waiting)))
    if run is None:
        return
    yield from (_found(rows, "open", part) for rows in run.waiting)
    reports = [run.report(part)] if first is None else [first.report(part), run.report(part)]
    yield pa.RecordBatch.from_pylist(reports, schema=SCHEMA)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return stream_range(batches, TaskContext.get().partitionId())


def at_seams(found: DataFrame) -> DataFrame:
    """The open rows that go, from all reports of their key.

    There are two reports a task at most, which bounds what is broadcast. A document that ends one range and begins
    the next counts once.
    """
    reports = found.filter("kind = 'run'").select("high", "low", "part", "n_docs", "known", "doc", "last_known", "last_doc")
    along = Window.partitionBy("high", "low").orderBy("part")
    again = (F.lag("last_known").over(along) == F.col("known")) & (F.lag("last_doc").over(along) == F.col("doc"))
    counted = reports.withColumn("again", F.coalesce(again, F.lit(False)).cast("int"))
    keys = counted.groupBy("high", "low").agg(
        F.sum(F.col("n_docs") - F.col("again")).alias("total"),
        F.min_by(F.struct("known", "doc"), "part").alias("largest"),
    )
    keys = keys.filter(F.col("total") >= LEAST_DOCS).select("high", "low", "largest")
    rows = found.filter("kind = 'open'").select(*OCCURRENCE)
    joined = rows.join(F.broadcast(keys), ["high", "low"])
    return joined.filter(F.struct("known", "doc") != F.col("largest")).select(*ROW, "pos", "n_lines")


def pack(dropped: list[int], n_lines: int) -> bytes:
    """A bit for each line, 1 where it stays, compressed."""
    bits = np.ones(n_lines, dtype=np.uint8)
    bits[dropped] = 0
    return zlib.compress(np.packbits(bits).tobytes())


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    bits = np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8)
    return np.unpackbits(bits, count=n_lines).astype(bool)


@F.pandas_udf(BinaryType())
def _packed(dropped: pd.Series, n_lines: pd.Series) -> pd.Series:
    return pd.Series([pack(d, n) for d, n in zip(dropped, n_lines)], dtype=object)


@F.pandas_udf(StringType())
def _kept(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    """Texts without the lines of bit 0; only rows with a bitmap are sent here with a text."""
    out = []
    for t, b in zip(text, bitmap):
        lines = None if b is None else t.split("\n")
        out.append(None if b is None else "\n".join(np.array(lines, dtype=object)[unpack(b, len(lines))]))
    return pd.Series(out, dtype=object)


def keep_bitmaps(docs: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(known, doc, text_hash, n_lines, n_dropped, bitmap)`` for each row that loses lines.

    Occurrences are written first: dealing them out by range reads them twice, and a lost task reads the same rows.
    """
    lines = work.keep(occurrences(docs, id_col, text_col), "lines")
    order = ["high", "low", F.col("known").desc(), F.col("doc").desc(), "text_hash", "pos", "at"]
    ranges = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    found = work.keep(ranges.select(*OCCURRENCE).mapInArrow(_stream, FOUND), "found")
    dropped = found.filter("kind = 'drop'").select(*ROW, "pos", "n_lines").unionByName(at_seams(found))
    rows = dropped.groupBy(*ROW).agg(F.first("n_lines").alias("n_lines"), F.collect_set("pos").alias("dropped"))
    n_dropped = F.size("dropped").alias("n_dropped")
    return work.keep(rows.select(*ROW, "n_lines", n_dropped, _packed("dropped", "n_lines").alias("bitmap")), "bitmaps")


def _applied(docs: DataFrame, bitmaps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows as ``given``, with their text, its number of lines, how many go and what stays."""
    rows = docs.select(F.struct("*").alias("given"), *_row_columns(id_col, text_col), _text(text_col).alias("whole"))
    joined = rows.join(bitmaps.drop("n_lines"), [*ROW], "left")
    lost = F.when(F.col("bitmap").isNotNull(), F.col("whole"))
    return joined.select(
        "given",
        "whole",
        (F.size(F.split("whole", "\n"))).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(_kept(lost, "bitmap"), "whole").alias("kept"),
    )


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the lines that they share with larger ones. A null text stays null."""
    bitmaps = keep_bitmaps(docs, Workspace(docs.sparkSession), id_col, text_col)
    kept = F.when(F.col(f"given.{text_col}").isNotNull(), F.col("kept"))
    columns = [kept.alias(c) if c == text_col else F.col("given")[c].alias(c) for c in docs.columns]
    return _applied(docs, bitmaps, id_col, text_col).select(*columns)


def digest(docs: DataFrame) -> DataFrame:
    """Per document its lines, how many go, and the hash of what stays."""
    slim = docs.select("doc_id", "text")
    rows = _applied(slim, keep_bitmaps(slim, Workspace(docs.sparkSession)), "doc_id", "text")
    kept = F.sha2(F.col("kept"), 256).alias("kept_sha256")
    return rows.select("given.doc_id", "n_lines", "n_dropped", kept)
