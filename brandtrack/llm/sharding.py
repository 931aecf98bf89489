"""Sharding by a weighted hash tree.

A tree has regions, regions have racks, racks have shards. Each shard draws a number from the row's id and its own
name, scaled by its weight; a rack's draw is the best of its shards', a region's the best of its racks', so that the
draws of each level follow the weights of its subtrees. A row descends from the root to the child with the best draw.
A shard's draws depend on nothing but the id, its name and its weight, so a changed weight, or one more shard
anywhere, moves rows only into or out of that shard, and the shares follow the weights. Law: ``key``. It holds from any
number of shards to the next: where a row goes does not depend on how the tree came to its shards.

Defined results: a null id draws as the text ``null``; a null text has size 1 and checksum 0; repeated rows follow
their id into the same shard and get slots of their own; an empty table gives an empty result; other columns pass
through, and result columns win over input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FANOUT = 2
#: Slices of a shard's rows that are numbered on their own.
SLICES = 1024


@dataclass(frozen=True)
class Node:
    """A shard if it has no children. An inner node weighs what its children weigh."""

    name: str
    own_weight: float = 1.0
    children: tuple[Node, ...] = ()
    shard: int | None = None

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def even_tree(n_shards: int, fanout: int = FANOUT) -> Node:
    """Shards 0 to ``n_shards - 1`` of weight 1 in racks of ``fanout``, and these in regions of ``fanout``."""
    shards = [Node(f"shard{i}", shard=i) for i in range(n_shards)]
    racks = _bundle(shards, "rack", fanout)
    return Node("root", children=tuple(_bundle(racks, "region", fanout)))


def _bundle(nodes: list[Node], kind: str, fanout: int) -> list[Node]:
    return [
        Node(f"{kind}{i // fanout}", children=tuple(nodes[i : i + fanout]))
        for i in range(0, len(nodes), fanout)
    ]


def shards_of(tree: Node) -> list[int]:
    if not tree.children:
        return [tree.shard]
    return [s for child in tree.children for s in shards_of(child)]


def grow(tree: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region of its own. Rows move into the new shard only."""
    new = max(shards_of(tree)) + 1
    shard = Node(f"shard{new}", own_weight=weight, shard=new)
    return replace(tree, children=(*tree.children, Node(f"region-of-{new}", children=(Node(f"rack-of-{new}", children=(shard,)),))))


def reweigh(tree: Node, weights: dict[int, float]) -> Node:
    """The tree with other weights for some shards."""
    if not tree.children:
        return replace(tree, own_weight=weights.get(tree.shard, tree.own_weight))
    return replace(tree, children=tuple(reweigh(c, weights) for c in tree.children))


def _draw(key: Column, node: Node) -> Column:
    """Minus the logarithm of a uniform draw over the weight: the least among siblings wins."""
    digits = F.substring(F.md5(F.concat_ws(":", key, F.lit(node.name))), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(uniform) / F.lit(float(node.weight))


def best_draw(key: Column, node: Node) -> Column | None:
    """The best draw below a node and the shard that it leads to; nothing where no shard takes rows."""
    if not node.children:
        return F.struct(_draw(key, node).alias("draw"), F.lit(node.shard).alias("shard")) if node.weight > 0 else None
    draws = [d for child in node.children if (d := best_draw(key, child)) is not None]
    return F.least(*draws) if len(draws) > 1 else draws[0] if draws else None


def descend(key: Column, tree: Node) -> Column:
    """The shard of a key, a string column. Shards of weight 0 take no rows."""
    best = best_draw(key, tree)
    return F.lit(None).cast("int") if best is None else best["shard"]


def assign(docs: DataFrame, tree: Node, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with ``size``, ``text_crc32``, ``law``, ``shard`` and ``grown_shard``. Nothing is shuffled."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    return docs.withColumns(
        {
            "size": (F.octet_length(text) + 1).cast("long"),
            "text_crc32": F.crc32(text.cast("binary")),
            "law": F.lit("key"),
            "shard": descend(key, tree).cast("int"),
            "grown_shard": descend(key, grow(tree)).cast("int"),
        }
    )


def _slice(id_col: str) -> Column:
    """A slice by id, checksum and size, so that the rows of one id, however many, do not share one."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    digits = F.substring(F.md5(F.concat_ws(":", F.lit("slot"), key, "text_crc32", "size")), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(SLICES)).cast("int")


def with_slots(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows with ``slot``, numbers from 0 without gaps in each shard.

    A shard may hold any share of all rows, so it is cut into slices by a hash. The slices are counted,
    which takes no text, their first slots follow from the counts, and rows are numbered slice by slice. The
    counts that are broadcast have a row for each shard and slice at most, whatever the input.
    """
    order = [F.col(c).alias(f"_{c}") for c in ("text_crc32", "size")]
    row = F.struct(*[c for c in rows.columns if c != "slot"]).alias("_row")
    sliced = rows.select(row, F.col("shard").alias("_shard"), _slice(id_col).alias("_slice"), F.col(id_col).alias("_id"), *order)
    counts = sliced.groupBy("_shard", "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("_shard", "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_shard", "_slice").orderBy("_id", "_text_crc32", "_size")
    numbered = sliced.withColumn("_place", F.row_number().over(inside))
    placed = numbered.join(F.broadcast(first), ["_shard", "_slice"])
    return placed.select("_row.*", (F.col("_first") + F.col("_place") - 1).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``assign`` and ``with_slots`` over an even tree."""
    return with_slots(assign(docs, even_tree(n_shards), id_col, text_col), id_col)


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard, with rows that are already grouped by slice."""
    placed.write.mode("overwrite").partitionBy("shard").parquet(path)


def digest(docs: DataFrame) -> DataFrame:
    """Where each document goes, without its text."""
    slim = assign(docs.select("doc_id", "text"), even_tree(8)).drop("text")
    columns = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    return with_slots(slim).select(*columns)
