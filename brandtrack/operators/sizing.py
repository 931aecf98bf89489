"""Lookups of known size, and joins that depend on it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lookup:
    """A join side that is known to have at most ``rows`` rows.

    ``hot`` has hashes of the keys that many of the rows to be joined hold, where they have been counted.
    """

    frame: DataFrame
    rows: int
    fits: bool
    hot: tuple[int, ...] | None = None


def measure(**frames: tuple[DataFrame, dict[str, Column]]) -> dict[str, Row]:
    """Count each frame and take its aggregates, all in one job that returns one row per frame."""
    parts = [
        df.agg(
            F.lit(name).alias("name"),
            F.count(F.lit(1)).alias("n"),
            *[value.alias(column) for column, value in aggregates.items()],
        )
        for name, (df, aggregates) in frames.items()
    ]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return {row["name"]: row for row in merged.collect()}


def count_rows(limit: int, **frames: DataFrame) -> dict[str, Lookup]:
    """The frames as lookups of known size."""
    sizes = measure(**{name: (df, {}) for name, df in frames.items()})
    rows = {name: sizes[name]["n"] for name in frames}
    return {name: Lookup(df, rows[name], rows[name] <= limit) for name, df in frames.items()}


#: The most hot keys that are looked for, and how many keys a sketch of a column tracks.
MOST_HOT = 1000
TRACKED = 20_000


def hot_keys(salts: int, **columns: tuple[DataFrame, str]) -> dict[str, tuple[int, ...]]:
    """Hashes of each column's hot keys: those with more rows than half a partition's share.

    A sketch of the most frequent keys per column, all in one job. The sketch may name a few keys too many or miss
    one at the limit, which costs time and no row.
    """
    spark = next(iter(columns.values()))[0].sparkSession
    share = 2 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), salts)
    most = min(share, MOST_HOT)
    parts = [
        df.agg(
            F.lit(name).alias("name"),
            F.count(F.lit(1)).alias("n"),
            F.expr(f"approx_top_k(xxhash64(`{column}`), {most}, {TRACKED})").alias("top"),
        )
        for name, (df, column) in columns.items()
    ]
    found = reduce(DataFrame.unionByName, parts).collect()
    return {r["name"]: tuple(k["item"] for k in r["top"] if k["count"] * share > r["n"]) for r in found}


def attach(
    rows: DataFrame, lookup: Lookup, on: list[str], salts: int, how: str = "inner"
) -> DataFrame:
    """Join a lookup to a large table without letting one hot key fill one task.

    A lookup within the bound is broadcast and ``rows`` stays where it is. A larger one is shuffled. Where its hot keys
    are known, rows of these alone are spread over ``salts`` slots, and only these keys are repeated in the
    lookup; where they are not, all are. The salt is a hash of the row's other columns and comes out the same when a
    lost task runs again.
    """
    if lookup.fits:
        return rows.join(F.broadcast(lookup.frame), on, how)
    others = [c for c in rows.columns if c not in on]
    spread = F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int")
    slots = F.sequence(F.lit(0), F.lit(salts - 1))
    same_types = all(rows.schema[c].dataType == lookup.frame.schema[c].dataType for c in on)
    if lookup.hot is not None and same_types:  # else equal keys need not have equal hashes
        if not lookup.hot:
            return rows.join(lookup.frame, on, how)
        is_hot = F.xxhash64(*on).isin(list(lookup.hot))
        spread = F.when(is_hot, spread).otherwise(0)
        slots = F.when(is_hot, slots).otherwise(F.array(F.lit(0)))
    salted = rows.withColumn("salt", spread)
    return salted.join(lookup.frame.withColumn("salt", F.explode(slots)), [*on, "salt"], how).drop("salt")
