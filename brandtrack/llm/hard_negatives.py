"""Hard negatives of anchor vectors, found exactly through a multiway hyperplane tree with distance ranges.

All vectors are lifted to one sphere (one more component fills up their norm), so that a window of inner products
with an anchor is an annulus of distances around it. The tree is fitted on a bounded sample: a node has split
points far from each other, a vector goes to the nearest, and so down to a leaf. All rows are indexed, and for each split
point and each sibling subtree the least and the largest distance of *all* rows there are kept. An anchor walks
down the tree: where, for some split point, its distance and the range of a subtree can't meet its annulus, the
subtree is left out. What stays is scanned exactly: leaves are cut into blocks of rows, and the anchors that
reach a block are streamed past it. Scores that sample rows reach narrow the window first: they are rows of the table, so
the wanted ones score no less.

First each anchor's positives are found this way, then, in the windows that these give, its negatives.

Defined results: rows with a null id, label, vector or component, or a component that is no finite number, take no part;
rows that are equal in all three count once, rows that share an id only are rows of their own; a shorter vector is
filled up with zeros; ties go to the smaller id; an empty table or one without anchors has no result. Squared norms
must be under 2**55, so that all products are exact: else there is an error, never a wrong score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import Workspace

#: Rows the tree is fitted on, drawn by a hash; split points of a node; sample rows that make a leaf.
SAMPLE = 8192
FANOUT = 24
LEAF = 24
#: Rows of a leaf that are scanned together, scores held at once, and anchors routed at once.
BLOCK_ROWS = 16_384
SCORES = 2_000_000
ROUTED = 256


@dataclass(frozen=True)
class Mine:
    """How many positives and negatives, and the window of a negative's score in hundredths of the positive's."""

    positives: int = 5
    negatives: int = 10
    least: int = 30
    most: int = 90


# --- the tree ----------------------------------------------------------------------------------------


@dataclass
class Node:
    """Split points, what is below each (``-1 - leaf`` or a node), and for each point (row) and each subtree (column)
    the range of distances."""

    points: np.ndarray
    below: list[int]
    low: np.ndarray = field(init=False)
    high: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        shape = (len(self.below),) * 2
        self.low, self.high = np.full(shape, np.inf), np.full(shape, -np.inf)


class Tree:
    """The tree over vectors of ``dim`` components whose squared norm is at most ``norm2``."""

    def __init__(self, sample: np.ndarray, norm2: float, fanout: int = FANOUT, leaf: int = LEAF):
        self.norm2, self.fanout, self.leaf_size = norm2, fanout, leaf
        self.nodes: list[Node] = []
        self.n_leaves = 0
        lifted = self.lift(sample)
        self.root = self._grow(lifted) if len(lifted) else self._leaf()

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        rest = self.norm2 - (vectors**2).sum(axis=1)
        return np.column_stack((vectors, np.sqrt(np.maximum(rest, 0))))

    def _leaf(self) -> int:
        self.n_leaves += 1
        return -self.n_leaves

    def _grow(self, points: np.ndarray) -> int:
        if len(points) <= self.leaf_size:
            return self._leaf()
        chosen = [0]
        gap = self._distances(points, points[:1])[:, 0]
        while len(chosen) < self.fanout and gap.max() > self.slack:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, self._distances(points, points[chosen[-1:]])[:, 0])
        if len(chosen) < 2:
            return self._leaf()
        node = Node(points[chosen], [])
        at = len(self.nodes)
        self.nodes.append(node)
        nearest = self._distances(points, node.points).argmin(axis=1)
        node.below = [self._grow(points[nearest == i]) for i in range(len(chosen))]
        node.__post_init__()
        return at

    @property
    def slack(self) -> float:
        """More than rounding can change a distance."""
        return 1e-6 * np.sqrt(self.norm2)

    def _distances(self, lifted: np.ndarray, points: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 * self.norm2 - 2 * (lifted @ points.T), 0))

    def descend(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector; the ranges grow with them."""
        leaves = np.zeros(len(vectors), np.int64)
        lifted = self.lift(vectors)
        todo = [(self.root, np.arange(len(vectors)))]
        while todo:
            at, rows = todo.pop()
            if at < 0:
                leaves[rows] = -1 - at
                continue
            node = self.nodes[at]
            gaps = self._distances(lifted[rows], node.points)
            nearest = gaps.argmin(axis=1)
            for j in np.unique(nearest):
                own = gaps[nearest == j]
                node.low[:, j] = np.minimum(node.low[:, j], own.min(axis=0))
                node.high[:, j] = np.maximum(node.high[:, j], own.max(axis=0))
                todo.append((node.below[j], rows[nearest == j]))
        return leaves

    def reach(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which leaves (columns) can hold a vector whose product with the anchor (row) is in ``[low, high]``."""
        reached = np.zeros((len(anchors), self.n_leaves), bool)
        own = (anchors**2).sum(axis=1)
        inner = np.sqrt(np.maximum(own + self.norm2 - 2 * high, 0)) - self.slack
        outer = np.sqrt(np.maximum(own + self.norm2 - 2 * low, 0)) + self.slack
        todo = [(self.root, np.flatnonzero(low <= high))]
        while todo:
            at, rows = todo.pop()
            if at < 0:
                reached[rows, -1 - at] = True
                continue
            node = self.nodes[at]
            gaps = np.sqrt(np.maximum(own[rows, None] + self.norm2 - 2 * (anchors[rows] @ node.points[:, :-1].T), 0))
            for j, below in enumerate(node.below):
                if not np.isfinite(node.low[0, j]):
                    continue  # no row is there
                nearest = np.maximum(gaps - node.high[:, j], node.low[:, j] - gaps).max(axis=1)
                farthest = (gaps + node.high[:, j]).min(axis=1)
                meets = (nearest <= outer[rows]) & (farthest >= inner[rows])
                if meets.any():
                    todo.append((below, rows[meets]))
        return reached

    def ranges(self) -> list[tuple[int, int, float, float]]:
        """``(node, cell, low, high)`` of the cells that vectors have come to."""
        return [
            (k, c, float(node.low.flat[c]), float(node.high.flat[c]))
            for k, node in enumerate(self.nodes)
            for c in np.flatnonzero(np.isfinite(node.low.ravel())).tolist()
        ]

    def set_ranges(self, cells: list[tuple[int, int, float, float]]) -> None:
        for node in self.nodes:
            node.__post_init__()
        for k, c, low, high in cells:
            self.nodes[k].low.flat[c], self.nodes[k].high.flat[c] = low, high


# --- rows --------------------------------------------------------------------------------------------


def whole_vectors(rows: DataFrame, id_col: str, label: Column, vector_col: str, scale: int = 1) -> DataFrame:
    """``(vec_id, label, vec)`` of the rows that take part, with each component ``floor(scale * x)``."""
    known = F.expr(f"forall(`{vector_col}`, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    vec = F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = rows.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & known)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), vec.alias("vec")).filter(
        "label is not null"
    )


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """Lists of integers as rows, filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == dim).all():
        return flat.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.arange(dim) < lengths[:, None]] = flat
    return out


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


@dataclass
class Index:
    """A fitted tree with the number of blocks of each leaf, and the sample as rows of the table."""

    tree: Tree
    dim: int
    exact: bool  # products fit the integers that doubles hold
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    n_blocks: list[int] = field(default_factory=list)

    def numbers(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors in the type whose products are exact."""
        return vectors.astype(np.float64) if self.exact else vectors


def fit(rows: DataFrame) -> Index:
    """The tree over a sample of ``(vec_id, label, vec)``. The driver receives the sample and two numbers."""
    norm2 = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    most = rows.agg(F.max(norm2).alias("norm2"), F.max(F.size("vec")).alias("dim")).first()
    dim, top = int(most["dim"] or 0), float(most["norm2"] or 0) * (1 + 1e-9)
    if top >= 2**55:
        raise ValueError("hundredfold inner products do not fit 64 bits")
    drawn = rows.orderBy(F.xxhash64("vec_id", "label", "vec"), "vec_id", "label", "vec").limit(SAMPLE).toArrow()
    vectors = _matrix(drawn.column("vec").combine_chunks(), dim)
    ids, labels = (drawn.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "label"))
    _, once = np.unique(np.column_stack((ids, labels, vectors)), axis=0, return_index=True)
    ids, labels, vectors = ids[once], labels[once], vectors[once]
    return Index(Tree(vectors.astype(np.float64), top), dim, top < 2**52, ids, labels, vectors)


INDEXED = "kind int, leaf int, vec_id long, label long, vec array<long>, cell int, low double, high double"


def _placer(index: Index) -> Callable:
    """Rows with their leaf; at the end of a task the ranges of its rows as ``(leaf: node, cell, low, high)``."""
    schema = pa.schema(
        [("kind", pa.int32()), ("leaf", pa.int32()), ("vec_id", pa.int64()), ("label", pa.int64()),
         ("vec", pa.list_(pa.int64())), ("cell", pa.int32()), ("low", pa.float64()), ("high", pa.float64())]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = index.tree
        tree.set_ranges([])
        for batch in batches:
            if not batch.num_rows:
                continue
            leaves = tree.descend(_matrix(batch.column("vec"), index.dim).astype(np.float64))
            n = batch.num_rows
            own = {"kind": pa.array(np.zeros(n, np.int32)), "leaf": pa.array(leaves.astype(np.int32))}
            own |= {c: batch.column(c).cast(schema.field(c).type) for c in ("vec_id", "label", "vec")}
            yield pa.RecordBatch.from_arrays([own.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)
        cells = [dict(zip(("kind", "leaf", "cell", "low", "high"), (1, *c))) for c in tree.ranges()]
        yield pa.RecordBatch.from_pylist(cells, schema=schema)

    return place


def build(rows: DataFrame, work: Workspace) -> tuple[Index, DataFrame]:
    """The index and all rows with leaf and block.

    The driver receives one row for each cell of the tree and each leaf: the sample's size bounds both.
    """
    index = fit(rows)
    placed = work.keep(rows.mapInArrow(_placer(index), INDEXED), "placed")
    cells = placed.filter("kind = 1").groupBy("leaf", "cell").agg(F.min("low"), F.max("high")).collect()
    index.tree.set_ranges([tuple(r) for r in cells])
    leaves = placed.filter("kind = 0")
    counts = {r["leaf"]: r["count"] for r in leaves.groupBy("leaf").count().collect()}
    index.n_blocks = [-(-counts.get(leaf, 0) // BLOCK_ROWS) for leaf in range(index.tree.n_leaves)]
    n_blocks = F.element_at(F.lit(index.n_blocks or [0]), F.col("leaf") + 1)
    block = F.pmod(F.xxhash64("vec_id"), n_blocks).cast("int")
    return index, leaves.select("leaf", block.alias("block"), "vec_id", "label", "vec")


# --- anchors -----------------------------------------------------------------------------------------

ANCHOR = "vec_id long, label long, vec array<long>"
ROUTE = f"leaf int, {ANCHOR}, positive_id array<long>, positive_score array<long>, low array<long>, high array<long>"
ANCHOR_KEY = ("anchor_id", "anchor_label", "anchor_hash")
LEAST, MOST = np.iinfo(np.int64).min // 4, np.iinfo(np.int64).max // 4


def _best_of_sample(index: Index, scores: np.ndarray, fits: np.ndarray, n: int, low: np.ndarray) -> np.ndarray:
    """The n-th best fitting score of each row, or ``low`` where the sample has fewer."""
    if scores.shape[1] < n:
        return low
    kept = np.where(fits, scores, LEAST)
    nth = np.partition(kept, -n, axis=1)[:, -n].astype(np.int64)
    return np.maximum(low, nth)


def _router(index: Index, mine: Mine, for_positives: bool) -> Callable:
    """An anchor's row for each leaf that its windows reach.

    For positives there is one window, open to the top. For negatives there is one for each positive; those that do not
    reach a leaf are empty there (``low > high``).
    """
    schema = pa.schema(
        [("leaf", pa.int32()), ("vec_id", pa.int64()), ("label", pa.int64())]
        + [(c, pa.list_(pa.int64())) for c in ("vec", "positive_id", "positive_score", "low", "high")]
    )

    def windows(rows: pa.RecordBatch, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, labels = _numbers(rows, "vec_id"), _numbers(rows, "label")
        scores = index.numbers(vectors) @ index.numbers(index.vectors).T
        same = labels[:, None] == index.labels
        if for_positives:
            itself = (ids[:, None] == index.ids) & same
            low = np.full(len(ids), LEAST)
            return _best_of_sample(index, scores, same & ~itself, mine.positives, low)[:, None], np.full((len(ids), 1), MOST)
        reached = _matrix(rows.column("positive_score"), mine.positives)
        given = rows.column("positive_score").value_lengths().to_numpy(zero_copy_only=False)
        low, high = -(-mine.least * reached // 100), mine.most * reached // 100
        high[np.arange(mine.positives) >= given[:, None]] = LEAST
        for k in range(mine.positives):
            fits = ~same & (scores >= low[:, k, None]) & (scores <= high[:, k, None])
            low[:, k] = _best_of_sample(index, scores, fits, mine.negatives, low[:, k])
        return low, high

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROUTED):
                rows = batch.slice(at, ROUTED)
                vectors = _matrix(rows.column("vec"), index.dim)
                low, high = windows(rows, vectors)
                floats = vectors.astype(np.float64)
                reached = np.stack([index.tree.reach(floats, low[:, k], high[:, k]) for k in range(low.shape[1])])
                anchor, leaf = np.nonzero(reached.any(axis=0))
                own = rows.take(pa.array(anchor))
                open_high = np.where(reached[:, anchor, leaf].T, high[anchor], LEAST - 1)
                columns = {"leaf": pa.array(leaf.astype(np.int32)), "low": pa.array(list(low[anchor])), "high": pa.array(list(open_high))}
                columns |= {c: own.column(c) for c in ("vec_id", "label", "vec")}
                if not for_positives:
                    columns |= {c: own.column(c) for c in ("positive_id", "positive_score")}
                n = len(anchor)
                yield pa.RecordBatch.from_arrays(
                    [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema
                )

    return route


FOUND = "anchor_id long, anchor_label long, anchor_hash long, positive_id long, positive_score long, place int, vec_id long, score long"


class _Block:
    """The rows of a block that a stream has brought: equal ones come together and count once."""

    def __init__(self, key: tuple[int, int]):
        self.key = key
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.ready = None

    def add(self, rows: pa.RecordBatch, dim: int) -> None:
        ids, labels, vectors = _numbers(rows, "vec_id"), _numbers(rows, "label"), _matrix(rows.column("vec"), dim)
        if self.parts:
            before = [p[-1:] for p in self.parts[-1]]
        else:
            before = [ids[:0], labels[:0], vectors[:0]]
        i, l, v = (np.concatenate(pair) for pair in zip(before, (ids, labels, vectors)))
        new = np.ones(len(i), bool)
        new[1:] = (i[1:] != i[:-1]) | (l[1:] != l[:-1]) | (v[1:] != v[:-1]).any(axis=1)
        new = new[len(before[0]) :]
        if new.any():
            self.parts.append((ids[new], labels[new], vectors[new]))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.ready is None:
            self.ready = tuple(np.concatenate(p) for p in zip(*self.parts))
        return self.ready


def _scanner(index: Index, mine: Mine, for_positives: bool) -> Callable:
    """Rows and anchors sorted by block, rows first: the best rows of each anchor and window in each block."""
    schema = pa.schema([(c, pa.int64()) for c in ("anchor_id", "anchor_label", "anchor_hash", "positive_id", "positive_score")] + [("place", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
    most = mine.positives if for_positives else mine.negatives

    def best(anchors: pa.RecordBatch, block: _Block) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = block.rows()
        whole = index.numbers(vectors).T
        step = max(1, SCORES // max(1, len(ids)))
        for at in range(0, anchors.num_rows, step):
            part = anchors.slice(at, step)
            own_ids, own_labels = _numbers(part, "vec_id"), _numbers(part, "label")
            own = _matrix(part.column("vec"), index.dim)
            scores = (index.numbers(own) @ whole).astype(np.int64)
            same = own_labels[:, None] == labels
            if for_positives:
                fits = same
                twins = np.argwhere(same & (own_ids[:, None] == ids))
                for a, r in twins:
                    if (own[a] == vectors[r]).all():
                        fits[a, r] = False
            else:
                fits = ~same
            low, high = (_matrix(part.column(c), 1 if for_positives else mine.positives) for c in ("low", "high"))
            for k in range(low.shape[1]):
                anchor, row = np.nonzero(fits & (scores >= low[:, k, None]) & (scores <= high[:, k, None]))
                if not len(anchor):
                    continue
                score = scores[anchor, row]
                order = np.lexsort((ids[row], -score, anchor))
                anchor, row, score = anchor[order], row[order], score[order]
                begins = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
                rank = np.arange(len(anchor)) - np.repeat(begins, np.diff(np.append(begins, len(anchor))))
                keep = rank < most
                anchor, row, score = anchor[keep], row[keep], score[keep]
                n = len(anchor)
                if for_positives:
                    positive = {"positive_id": pa.nulls(n, pa.int64()), "positive_score": pa.nulls(n, pa.int64())}
                else:
                    positive = {c: pa.array(_matrix(part.column(c), mine.positives)[anchor, k]) for c in ("positive_id", "positive_score")}
                columns = {
                    "anchor_id": pa.array(own_ids[anchor]), "anchor_label": pa.array(own_labels[anchor]),
                    "anchor_hash": pa.array(_numbers(part, "anchor_hash")[anchor]), **positive,
                    "place": pa.array(np.full(n, k, np.int32)), "vec_id": pa.array(ids[row]), "score": pa.array(score),
                }
                yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block((-1, -1))
        for batch in batches:
            keys = np.column_stack([_numbers(batch, c) for c in ("leaf", "block", "kind")])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                if b == a:
                    continue
                rows, (leaf, number, kind) = batch.slice(a, b - a), keys[a].tolist()
                if block.key != (leaf, number):
                    block = _Block((leaf, number))
                if kind == 0:
                    block.add(rows, index.dim)
                elif block.parts:
                    yield from best(rows, block)

    return scan


def _search(index: Index, blocks: DataFrame, anchors: DataFrame, mine: Mine, for_positives: bool) -> DataFrame:
    """The best rows for each anchor and window over all blocks that its windows reach."""
    routed = anchors.mapInArrow(_router(index, mine, for_positives), ROUTE)
    n_blocks = F.element_at(F.lit(index.n_blocks), F.col("leaf") + 1)
    queries = routed.withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    shape = ["leaf", "block", "kind", "vec_id", "label", "vec", "positive_id", "positive_score", "low", "high", "anchor_hash"]
    queries = queries.withColumns({"kind": F.lit(1), "anchor_hash": F.xxhash64("vec")}).select(shape)
    none = F.lit(None).cast("array<long>")
    rows = blocks.select("leaf", "block", F.lit(0).alias("kind"), "vec_id", "label", "vec", *[none.alias(c) for c in shape[6:10]], F.lit(0).cast("long").alias("anchor_hash"))
    together = rows.unionByName(queries).repartition("leaf", "block")
    together = together.sortWithinPartitions("leaf", "block", "kind", "vec_id", "label", "vec")
    found = together.mapInArrow(_scanner(index, mine, for_positives), FOUND)
    order = Window.partitionBy(*ANCHOR_KEY, "place").orderBy(F.col("score").desc(), "vec_id")
    most = mine.positives if for_positives else mine.negatives
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mine_negatives(rows: DataFrame, is_anchor: Column, mine: Mine = Mine()) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` from ``(vec_id, label, vec)``.

    ``is_anchor`` is a condition on ``vec_id`` and ``label``.
    """
    work = Workspace(rows.sparkSession)
    index, blocks = build(rows, work)
    if not any(index.n_blocks):
        return _shown(rows.sparkSession.createDataFrame([], FOUND + ", rank int"))
    anchors = work.keep(blocks.filter(is_anchor).select("vec_id", "label", "vec").distinct(), "anchors")
    positives = _search(index, blocks, anchors, mine, for_positives=True)
    best = F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("best")
    listed = positives.groupBy(*ANCHOR_KEY).agg(best).select(
        *ANCHOR_KEY, F.col("best.vec_id").alias("positive_id"), F.col("best.score").alias("positive_score")
    )
    keyed = anchors.withColumns({"anchor_id": F.col("vec_id"), "anchor_label": F.col("label"), "anchor_hash": F.xxhash64("vec")})
    with_positives = work.keep(keyed.join(listed, [*ANCHOR_KEY]).drop(*ANCHOR_KEY), "positives")
    return _shown(_search(index, blocks, with_positives, mine, for_positives=False))


def _shown(found: DataFrame) -> DataFrame:
    return found.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def digest(embeddings: DataFrame) -> DataFrame:
    """Negatives of the anchors whose id is divisible by 100, with labels moved on where the id is divisible by 7."""
    label, vec_id = F.col("label"), F.col("vec_id")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = whole_vectors(embeddings.select("vec_id", "label", "embedding"), "vec_id", moved, "embedding", 256)
    return mine_negatives(rows, F.col("vec_id") % 100 == 0)
