"""The trie of conversations that begin alike, and what serving their common turns once would save.

Conversations come as sequences of turn hashes. Equal ones are folded into one, and the distinct ones are dealt out by
range in lexicographic order: each range is a prefix shard, and a common beginning, however common, is cut
wherever its continuations differ. A shard gives its turns dense ids, packs its trie into BASE and CHECK arrays
(the child of state ``s`` by turn ``t`` is ``BASE[s] + t`` if ``CHECK`` there is ``s``) and walks all its conversations
through them, level by level. Neighbouring shards share only nodes on the last path of one and the first path of the
other, so these few nodes are merged across shards, what a seam counts twice is taken off, and all others are final.

Defined results: turns without a conv_id belong to no conversation; a null role or text is empty; equal turn numbers
come in order of the MD5 of role and text, and repeated rows are repeated turns; a conversation without turns is a
member of the root alone; an empty table has no root. The hashes of one conversation (24 bytes a turn) are held
in one task, its texts are not; the sorted ids of equal conversations are hashed as a stream, in pieces of 4,096 numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sizing import Lookup, attach
from .tables import Workspace

#: Which turns a conversation takes from which other one.
FAMILY = 5
HEADS = 9
#: Numbers of conversations whose ids are put in one piece.
PIECE = 4096
#: Places that are tried for the children of one node, near the first hole and all along, before the arrays' end is taken.
TRIES = 32
#: The most rows of seam nodes that are broadcast (some 100 bytes each); beyond, their children are joined salted.
MOST_SEAMS = 500_000
SALTS = 16


# --- sequences -------------------------------------------------------------------------------------


def _turns(conversations: DataFrame) -> DataFrame:
    """Turns as ``(conv_id, turn, high, low, n_bytes)``: 120 bits of a hash of role and text instead of these."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    high, low = (F.conv(F.substring(said, at, 15), 16, 10).cast("long") for at in (1, 16))
    return conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        high.alias("high"),
        low.alias("low"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )


def sequences(conversations: DataFrame) -> DataFrame:
    """``(conv_id, keys, sizes)``: each conversation's turn hashes in order, two numbers a turn, and text bytes."""
    turn = F.struct("turn", "high", "low", "n_bytes")
    whole = _turns(conversations).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("said"))
    return _hashed(whole)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """As ``sequences``, where each conversation's first turns come from the first of its family."""
    turn = F.struct("conv_id", "turn", "high", "low", "n_bytes")
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    families = _turns(conversations).groupBy(family.alias("family")).agg(F.sort_array(F.collect_list(turn)).alias("all"))
    each = families.select(
        "all",
        F.expr(f"slice(filter(all, t -> t.conv_id = family), 1, {HEADS})").alias("head"),
        F.explode(F.expr("array_distinct(transform(all, t -> t.conv_id))")).alias("conv_id"),
    )
    n_head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    own = each.withColumns({"n_head": n_head.cast("int"), "own": F.expr("filter(all, t -> t.conv_id = conv_id)")})
    said = F.expr("concat(slice(head, 1, n_head), slice(own, n_head + 1, size(own)))")
    return _hashed(own.select("conv_id", said.alias("said")))


def _hashed(whole: DataFrame) -> DataFrame:
    return whole.select(
        "conv_id",
        F.expr("flatten(transform(said, t -> array(t.high, t.low)))").alias("keys"),
        F.expr("transform(said, t -> t.n_bytes)").alias("sizes"),
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of ids sorted by sequence: one hash per sequence, fed piece by piece."""
    seq = None
    for batch in batches:
        out = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("seq", "ids", "n", "least"))):
            if row[0] != seq:
                if seq is not None:
                    out.append((seq, total, least, state.hexdigest()))
                seq, total, least, state = row[0], 0, row[3], hashlib.sha256()
            state.update((b"," if total else b"") + row[1].encode())
            total += row[2]
        yield _table(out)
    if seq is not None:
        yield _table([(seq, total, least, state.hexdigest())])


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["seq", "n", "least", "ends"])


def distinct_sequences(seqs: DataFrame, work: Workspace) -> DataFrame:
    """``(keys, sizes, n, least, ends)``: each sequence once, with its number of conversations, the least of them and
    the SHA-256 of all their ids, ascending and joined by commas."""
    seq = F.md5(F.array_join(F.transform("keys", lambda k: k.cast("string")), ","))
    named = work.keep(seqs.withColumn("seq", seq), "sequences")
    piece = F.floor(F.col("conv_id") / PIECE).alias("piece")
    pieces = named.groupBy("seq", piece).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select(
        "seq",
        "piece",
        F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"),
        F.size("ids").cast("long").alias("n"),
        F.col("ids")[0].alias("least"),
    )
    sorted_pieces = pieces.repartition("seq").sortWithinPartitions("seq", "piece")
    ends = sorted_pieces.select("seq", "ids", "n", "least").mapInArrow(_digests, "seq string, n long, least long, ends string")
    return named.join(ends.drop("seq"), named["conv_id"] == ends["least"]).select("keys", "sizes", "n", "least", "ends")


# --- one shard -------------------------------------------------------------------------------------


@dataclass
class DoubleArray:
    """A packed trie. State 0 is the root; ``slots`` has each node's state, nodes in order of depth."""

    base: np.ndarray
    check: np.ndarray
    slots: np.ndarray

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states after one turn, -1 where there is none."""
        at = self.base[states] + codes
        known = (at > 0) & (at < len(self.check)) & (codes >= 0)
        return np.where(known & (self.check[np.where(known, at, 0)] == states), at, -1)


@dataclass
class Levels:
    """A trie's nodes in order of depth, the root first: parent node, code of the turn, where each depth begins."""

    parent: np.ndarray
    code: np.ndarray
    begins: list[int]

    @property
    def n_children(self) -> np.ndarray:
        return np.bincount(self.parent[1:], minlength=len(self.parent))


def grow_levels(codes: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> Levels:
    """Nodes from sequences in lexicographic order: on each level a run of equal parents and turns is a node."""
    parents, turns, level = [np.zeros(1, np.int64)], [np.full(1, -1, np.int64)], [0, 1]
    active = np.flatnonzero(lengths > 0)
    node = np.zeros(len(active), np.int64)
    depth = 0
    while len(active):
        turn = codes[begins[active] + depth]
        new = np.concatenate(([True], (node[1:] != node[:-1]) | (turn[1:] != turn[:-1])))
        parents.append(node[new])
        turns.append(turn[new])
        node = level[-1] + np.cumsum(new) - 1
        level.append(level[-1] + int(new.sum()))
        depth += 1
        stay = lengths[active] > depth
        active, node = active[stay], node[stay]
    return Levels(np.concatenate(parents), np.concatenate(turns), level[:-1])


def pack(levels: Levels) -> DoubleArray:
    """BASE and CHECK of a trie: nodes with many children first, each where all its children find free slots; children
    without siblings fill the holes that are left."""
    parent, code = levels.parent, levels.code
    n = len(parent)
    n_children, first = levels.n_children, np.zeros(n, np.int64)
    first[parent[1:][::-1]] = np.arange(1, n)[::-1]
    slots = np.zeros(n, np.int64)
    taken = np.zeros(max(2 * n, 16), bool)
    taken[0] = True
    end, low = 1, 1
    several = np.flatnonzero(n_children > 1)
    for node in several[np.argsort(-n_children[several], kind="stable")]:
        children = slice(first[node], first[node] + n_children[node])
        shape = code[children] - code[children].min()
        while taken[low]:
            low += 1
        near = np.arange(low, min(end, low + TRIES))
        tried = np.concatenate((near, np.linspace(low, end, TRIES).astype(np.int64)))
        at = next((f for f in tried if f + shape.max() < len(taken) and not taken[f + shape].any()), end)
        if at + shape.max() >= len(taken) - 1:
            taken = np.concatenate((taken, np.zeros(len(taken) + shape.max() + 1, bool)))
        slots[children] = at + shape
        taken[at + shape] = True
        end = max(end, int(at + shape.max()) + 1)
    single = 1 + np.flatnonzero(n_children[parent[1:]] == 1)
    holes = np.flatnonzero(~taken[:end])[: len(single)]
    slots[single] = np.concatenate((holes, end + np.arange(len(single) - len(holes))))
    size = int(slots.max()) + 1
    base, check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
    base[slots[parent[1:]]] = slots[1:] - code[1:]
    check[slots[1:]] = slots[parent[1:]]
    return DoubleArray(base, check, slots)


def turn_ids(keys: np.ndarray) -> np.ndarray:
    """An id from 0 for each turn, from rows of two numbers."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    ranked = keys[order]
    ids = np.empty(len(keys), np.int64)
    ids[order] = np.cumsum(np.concatenate(([0], (ranked[1:] != ranked[:-1]).any(axis=1).astype(np.int64))))[: len(keys)]
    return ids


def make_dense(levels: Levels, ids: np.ndarray) -> tuple[Levels, np.ndarray]:
    """The same with ids in order of appearance, level by level, so that siblings mostly have neighbouring ids."""
    seen = pd.unique(levels.code[1:])
    dense = np.empty(len(seen), np.int64)
    dense[seen] = np.arange(len(seen))
    return Levels(levels.parent, np.concatenate((levels.code[:1], dense[levels.code[1:]])), levels.begins), dense[ids]


NODE = pa.schema(
    {
        "kind": pa.string(), "part": pa.int32(), "own": pa.string(), "above": pa.string(), "depth": pa.int64(),
        "conv_id": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(),
        "n_leaves": pa.int64(), "saved": pa.int64(), "ends": pa.string(), "n_bytes": pa.int64(),
        "on_first": pa.bool_(), "on_last": pa.bool_(), "last_ends": pa.bool_(),
    }
)
FOUND = (
    "kind string, part int, own string, above string, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved long, ends string, n_bytes long, on_first boolean, on_last boolean, last_ends boolean"
)


def _path_names(keys: np.ndarray) -> list[str]:
    """A name for each beginning of a sequence, the empty one first: the same in every shard."""
    state = hashlib.blake2b(digest_size=16)
    names = [state.hexdigest()]
    for turn in np.ascontiguousarray(keys, dtype="<i8"):
        state.update(turn.tobytes())
        names.append(state.hexdigest())
    return names


def shard_nodes(keys: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, n: np.ndarray, least: np.ndarray, ends: list, part: int) -> pa.RecordBatch:
    """All nodes of a shard's trie. ``keys`` and ``sizes`` hold the turns of all sequences one after another.

    ``kind`` is ``seam`` on the first and the last path, whose nodes other shards may have too, ``child`` for other
    children of such nodes, whose parent's least member is open, and ``done`` elsewhere.
    """
    begins = np.concatenate(([0], np.cumsum(lengths)))[:-1].astype(np.int64)
    ids = turn_ids(keys)
    levels, codes = make_dense(grow_levels(ids, begins, lengths), ids)
    trie = pack(levels)
    size = len(trie.check)
    count, low = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    n_bytes, last = np.zeros(size, np.int64), np.zeros(len(lengths), np.int64)
    np.add.at(count, 0, n.sum())
    low[0] = least.min()
    active, states, depth = np.flatnonzero(lengths > 0), None, 0
    states = np.zeros(len(active), np.int64)
    paths = {0: [0], len(lengths) - 1: [0]}
    while len(active):
        at = begins[active] + depth
        states = trie.step(states, codes[at])
        if (states < 0).any():
            raise AssertionError("a conversation left its trie")
        np.add.at(count, states, n[active])
        np.minimum.at(low, states, least[active])
        n_bytes[states] = sizes[at]
        last[active] = states
        for seq in paths:
            if lengths[seq] > depth:
                paths[seq].append(int(states[np.searchsorted(active, seq)]))
        depth += 1
        stay = lengths[active] > depth
        active, states = active[stay], states[stay]
    n_children = np.zeros(size, np.int64)
    n_children[trie.slots] = levels.n_children
    leaves, saved = (n_children == 0).astype(np.int64), (count - 1) * n_bytes
    depths = np.zeros(size, np.int64)
    for d, (a, b) in reversed(list(enumerate(zip(levels.begins, [*levels.begins[1:], len(levels.parent)])))):
        own = trie.slots[a:b]
        depths[own] = d
        if d:
            np.add.at(leaves, trie.check[own], leaves[own])
            np.add.at(saved, trie.check[own], saved[own])
    own_ends = np.full(size, None, dtype=object)
    own_ends[last] = ends

    first_path, last_path = paths[0], paths[len(lengths) - 1]
    names = np.full(size, None, dtype=object)
    marks = {"on_first": np.zeros(size, bool), "on_last": np.zeros(size, bool), "last_ends": np.zeros(size, bool)}
    for seq, mark, path in ((0, "on_first", first_path), (len(lengths) - 1, "on_last", last_path)):
        names[path] = _path_names(keys[begins[seq] : begins[seq] + lengths[seq]])
        marks[mark][path] = True
    marks["last_ends"][last_path[-1]] = True
    s = trie.slots
    up = trie.check[s]  # the root's is -1
    above = np.where(up >= 0, names[up], None)
    seam = np.array([x is not None for x in names[s]])
    below = np.array([x is not None for x in above])
    columns = {
        "kind": np.where(seam, "seam", np.where(below, "child", "done")), "part": np.full(len(s), part), "own": names[s],
        "above": above, "depth": depths[s], "conv_id": low[s], "n_convs": count[s], "n_children": n_children[s],
        "n_leaves": leaves[s], "saved": saved[s], "ends": own_ends[s], "n_bytes": n_bytes[s],
    } | {mark: of[s] for mark, of in marks.items()}
    columns["parent_conv_id"] = pa.array(np.where(up >= 0, low[up], 0), pa.int64(), mask=up < 0)
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in NODE], schema=NODE)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one range of sequences."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows).combine_chunks()
    column = {c: table.column(c).combine_chunks() for c in table.column_names}
    sizes = column["sizes"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    keys = column["keys"].flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, 2)
    lengths = column["sizes"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    n, least = (column[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "least"))
    whole = shard_nodes(keys, sizes, lengths, n, least, column["ends"].to_pylist(), TaskContext.get().partitionId())
    yield from pa.Table.from_batches([whole]).to_batches(max_chunksize=10_000)


# --- across shards ---------------------------------------------------------------------------------


def merge_seams(seams: DataFrame) -> DataFrame:
    """The nodes that shards may share, each once: sums over shards, less what two shards have counted both.

    Where a shard's last path and the next one's first path agree, their nodes are counted twice: as children, with
    their bytes, and as a leaf where the last conversation ends on the common path and is carried on in the next
    shard. A node is corrected once for each seam it spans.
    """
    parts = seams.select("part").distinct()
    following = parts.withColumn("next", F.lead("part").over(Window.orderBy("part")))  # one row a shard
    lasts = seams.filter("on_last").join(F.broadcast(following), "part")
    lasts = lasts.select("part", "next", "own", "depth", "n_bytes", "last_ends")
    firsts = seams.filter("on_first").select(F.col("part").alias("next"), "own")
    common = lasts.join(firsts, ["next", "own"])
    seam = Window.partitionBy("part")
    deeper = seam.orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    twice = common.select(
        "own",
        F.sum("n_bytes").over(deeper).alias("bytes_twice"),
        (F.col("depth") < F.max("depth").over(seam)).cast("long").alias("child_twice"),
        F.max(F.col("last_ends").cast("long")).over(seam).alias("no_leaf"),
    )
    taken_off = twice.groupBy("own").agg(*[F.sum(c).alias(c) for c in ("bytes_twice", "child_twice", "no_leaf")])
    sums = seams.groupBy("own").agg(
        F.first("above").alias("above"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        F.max("ends").alias("ends"),
    )

    def less(name: str, off: str) -> Column:
        return F.col(name) - F.coalesce(F.col(off), F.lit(0))

    return sums.join(taken_off, "own", "left").select(
        "own",
        "above",
        "depth",
        "conv_id",
        "n_convs",
        less("n_children", "child_twice").alias("n_children"),
        less("n_leaves", "no_leaf").alias("n_leaves"),
        (F.col("saved") + F.coalesce("bytes_twice", F.lit(0))).alias("saved"),
        "ends",
    )


def trie_nodes(seqs: DataFrame, work: Workspace) -> DataFrame:
    """One row per node of the trie of ``(conv_id, keys, sizes)``."""
    paths = work.keep(distinct_sequences(seqs, work), "paths")
    ranges = paths.repartitionByRange("keys").sortWithinPartitions("keys")
    found = work.keep(ranges.mapInArrow(_shard, FOUND), "found")
    seams = found.filter("kind = 'seam'")
    merged = work.keep(merge_seams(seams), "merged")
    n_seams = merged.count()
    parents = merged.select(F.col("own").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    lookup = Lookup(parents, n_seams, n_seams <= MOST_SEAMS)
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    children = attach(found.filter("kind = 'child'").drop("parent_conv_id"), lookup, ["above"], SALTS)
    shared = merged.join(parents, "above", "left")
    whole = found.filter("kind = 'done'").select(shown).unionByName(children.select(shown)).unionByName(shared.select(shown))
    none = F.sha2(F.lit(""), 256)
    return whole.select(
        *shown[:6], F.col("saved").alias("saved_tokens"), F.coalesce("ends", none).alias("ends_sha256")
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    return trie_nodes(sequences(conversations), Workspace(conversations.sparkSession))


def digest(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie_nodes(rebuilt(conversations), Workspace(conversations.sparkSession))
