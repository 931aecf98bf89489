"""From the conversion list to every product code of its categories."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..params import TWO_LEVEL_PRODUCT, ReportParams
from ..sources.tables import Tables
from .conversion import group_dates
from .sizing import Lookup, attach, count_rows

LEVEL_3 = "level 3"
LEVEL_2 = "level 2"
BOTH_LEVELS = "both levels"
BRANCHES = (LEVEL_3, LEVEL_2, BOTH_LEVELS)


def _category_codes(conv: DataFrame, branches: Iterable[str]) -> DataFrame:
    """The distinct categories the list asks for: hierarchy level, code and whose they are.

    Many codes of a group share a category, so this is taken before any item is joined. A list row may
    ask for two categories; both come out of one pass over the list.
    """
    level, product = F.col("levelflag"), F.col("productname")
    rules = {
        LEVEL_3: ((level == 3) & (product != TWO_LEVEL_PRODUCT), 3),
        LEVEL_2: (level == 2, 2),
        BOTH_LEVELS: (product == TWO_LEVEL_PRODUCT, 3),
    }
    asked = []
    for branch in branches:
        wanted, depth = rules[branch]
        code = F.col(f"hierl{depth}cd")
        place = F.struct(
            code.alias("hier_cd"),
            F.lit(depth).alias("depth"),
            code.cast("string").alias("code"),
        )
        asked.append(F.when(wanted, place))
    return conv.select("grpnum", "levelflag", F.inline(F.array_compact(F.array(*asked)))).distinct()


def list_lookups(
    conv: DataFrame, params: ReportParams, branches: Iterable[str] = BRANCHES
) -> dict[str, Lookup]:
    """The list's distinct category codes and launch dates, as lookups of known size.

    A list row asks for two categories at most, so a short list settles the size; only for a long one
    the distinct rows themselves are counted.
    """
    codes, dates = _category_codes(conv, branches), group_dates(conv)
    at_most = 2 * count_rows(params.broadcast_rows, listed=conv)["listed"].rows
    if at_most <= params.broadcast_rows:
        return {"codes": Lookup(codes, at_most, True), "dates": Lookup(dates, at_most, True)}
    return count_rows(params.broadcast_rows, codes=codes, dates=dates)


def _expand(codes: Lookup, tables: Tables, params: ReportParams) -> DataFrame:
    depths = F.array(
        F.struct(F.lit(3).alias("depth"), F.col("trade_item_hier_l3_cd").alias("code")),
        F.struct(F.lit(2).alias("depth"), F.col("trade_item_hier_l2_cd").alias("code")),
    )
    places = tables.hierarchy.select("trade_item_key", F.inline(depths))
    owned = tables.item.filter(F.col("lgl_entity_nbr") == params.owner)
    return (
        attach(places, codes, ["depth", "code"], params.salts)
        .join(owned, "trade_item_key")
        .select(F.col("trade_item_cd").alias("upc"), "grpnum", "levelflag", "hier_cd")
    )


def category_branch(
    conv: DataFrame, tables: Tables, params: ReportParams, branch: str
) -> DataFrame:
    """Distinct category codes of one branch: level 3, level 2, or the product that takes both."""
    codes = list_lookups(conv, params, [branch])["codes"]
    return _expand(codes, tables, params).distinct()


def listed_codes(conv: DataFrame) -> DataFrame:
    """The listed codes themselves with the category code of their level."""
    by_level = F.when(F.col("levelflag") == 3, F.col("hierl3cd")).otherwise(F.col("hierl2cd"))
    return conv.select("upc", "grpnum", "levelflag", by_level.alias("hier_cd"))


def category_upcs(
    conv: DataFrame, codes: Lookup, tables: Tables, params: ReportParams
) -> DataFrame:
    """Every code of every group's category, plus the listed codes: one pass over the hierarchy."""
    return _expand(codes, tables, params).union(listed_codes(conv)).distinct()


def dated_category(category: DataFrame, dates: Lookup, params: ReportParams) -> DataFrame:
    """Category codes with their group's launch date; a group with several dates repeats its codes."""
    dated = attach(category, dates, ["grpnum"], params.salts, "left")
    return dated.select(*category.columns, "convdate")


def category_groups(category: DataFrame) -> DataFrame:
    return category.select("grpnum").distinct().orderBy("grpnum")


def repeated_codes(category: DataFrame) -> DataFrame:
    """Codes that occur more than once in one group."""
    known = category.filter(F.col("grpnum").isNotNull() & F.col("upc").isNotNull())
    return known.groupBy("grpnum", "upc").agg(F.count("upc").alias("c")).filter(F.col("c") > 1)


class FanOut:
    """Counts of category codes before and after their dates are joined, taken while the dated codes are written.

    Nothing is read again for them: both numbers are observed in the pass that writes.
    """

    def __init__(self) -> None:
        self.before, self.after = Observation("category codes"), Observation("dated codes")

    def watched(self, category: DataFrame) -> DataFrame:
        return category.observe(self.before, F.count(F.lit(1)).alias("n"))

    def counted(self, dated: DataFrame) -> DataFrame:
        """The dated codes, equal ones as one row with their number of ``copies``."""
        copies = dated.groupBy(*dated.columns).agg(F.count(F.lit(1)).alias("copies"))
        rows = F.coalesce(F.sum("copies"), F.lit(0)).alias("n")
        return copies.observe(self.after, rows, F.count(F.lit(1)).alias("distinct"))

    def result(self, spark: SparkSession) -> DataFrame:
        """One row: category codes, the same after the dates were joined, and how many are distinct."""
        counts = {
            "category_rows": self.before.get["n"],
            "dated_rows": self.after.get["n"],
            "distinct_dated_rows": self.after.get["distinct"],
        }
        return spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()])


def fan_out(category: DataFrame, dated: DataFrame) -> DataFrame:
    """One row: category codes, the same after the dates were joined, and how many are distinct."""
    copies = dated.groupBy(*dated.columns).agg(F.count(F.lit(1)).alias("copies"))
    none = F.lit(0).cast("bigint")
    measures = category.select(
        F.lit(1).cast("bigint").alias("a"), none.alias("b"), none.alias("c")
    ).union(copies.select(none, "copies", F.lit(1).cast("bigint")))
    return measures.agg(
        F.coalesce(F.sum("a"), none).alias("category_rows"),
        F.coalesce(F.sum("b"), none).alias("dated_rows"),
        F.coalesce(F.sum("c"), none).alias("distinct_dated_rows"),
    )
