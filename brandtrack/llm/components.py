"""Connected components of a graph given by its edges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Workspace

MOST_ROUNDS = 100


def _mark(edges: DataFrame) -> tuple:
    """A fingerprint of a set of edges."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def _large_star(edges: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Every node's larger neighbours go to the least node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = keep(least.select("a", F.least("a", "m").alias("m")), "large")
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Every node and its smaller neighbours go to the least of them. Edges lead from larger to smaller nodes."""
    least = keep(edges.groupBy("a").agg(F.min("b").alias("m")), "small")
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """``(node, component)``, the least node that is reachable, for each node with edges except that least one.

    ``edges`` has columns ``a`` and ``b``. Both steps need the least neighbour only, which is aggregated before the
    shuffle. The least neighbours are written, so that the join back to the edges is one of two plain shuffles, whose
    hot partitions, those of nodes with many edges, are split at run time. The rounds grow with the logarithm of
    the longest path; each is written, as its predecessor's lineage would be run again otherwise. After ``MOST_ROUNDS``,
    enough for paths longer than any table, there is an error and never part of a result.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    current = edges.filter("a <> b").select(larger.alias("a"), smaller.alias("b")).distinct()
    current = work.keep(current, f"{name}-0")
    mark = _mark(current)
    for k in range(1, MOST_ROUNDS if mark[0] else 0):
        def keep(df: DataFrame, step: str, k: int = k) -> DataFrame:
            return work.keep(df, f"{name}-{k}-{step}")

        current = work.keep(_small_star(_large_star(current, keep), keep), f"{name}-{k}")
        before, mark = mark, _mark(current)
        if mark == before:
            break
    else:
        if mark[0]:
            raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
