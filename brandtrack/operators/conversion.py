"""The conversion list: clean-up, scopes and the views the report takes of it."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import to_code
from ..params import PRE_LAUNCH_DAYS, YEAR_DAYS, ReportParams


def clean_list(raw: DataFrame, min_group: int) -> DataFrame:
    """Typed list rows without whole-row duplicates, for the groups above ``min_group``.

    Levels other than 2 and 3 are taken over where the list has a column for their codes.
    """
    further = [
        to_code(F.col(name)).alias(f"hierl{found[1]}cd")
        for name in raw.columns
        if name not in CODE_COLUMNS and (found := FURTHER_LEVEL.fullmatch(name))
    ]
    return (
        raw.select(
            F.col("Division").alias("division"),
            F.col("Series").alias("series"),
            to_code(F.col("UPC")).alias("upc"),
            to_code(F.col("Group Number"), "int").alias("grpnum"),
            "brand",
            "productname",
            to_code(F.col("Hierarchy Level 3 Code")).alias("hierl3cd"),
            to_code(F.col("Hierarchy Level 2 Code")).alias("hierl2cd"),
            F.col("Date").cast("date").alias("convdate"),
            to_code(F.col("level_flag"), "int").alias("levelflag"),
            *further,
        )
        .dropDuplicates()
        .filter(F.col("grpnum") > min_group)
    )


#: Columns of the delivered list that hold codes, and what they must fit into.
CODE_COLUMNS = {
    "UPC": "bigint",
    "Group Number": "int",
    "Hierarchy Level 3 Code": "bigint",
    "Hierarchy Level 2 Code": "bigint",
    "level_flag": "int",
}
#: Columns of the delivered list that hold the codes of other levels.
FURTHER_LEVEL = re.compile("Hierarchy Level ([0-9]+) Code")


def bad_codes(raw: DataFrame) -> DataFrame:
    """Per code column, how many delivered cells hold a text that is no whole number and so counts as missing."""
    bad = [
        F.struct(
            F.lit(name).alias("column_name"),
            (F.col(name).isNotNull() & to_code(F.col(name), kind).isNull()).alias("is_bad"),
        )
        for name, kind in CODE_COLUMNS.items()
    ]
    cells = raw.select(F.inline(F.array(*bad)))
    return cells.groupBy("column_name").agg(F.count_if(F.col("is_bad")).alias("n_cells"))


def scope_list(
    conv: DataFrame,
    without_groups: Sequence[int] = (),
    product_contains: str | None = None,
    max_group: int | None = None,
) -> DataFrame:
    """The list without some groups, for products whose name contains a text, or up to a group."""
    if without_groups:
        conv = conv.filter(~F.col("grpnum").isin(list(without_groups)))
    if max_group is not None:
        conv = conv.filter(F.col("grpnum") <= max_group)
    if product_contains is not None:
        conv = conv.filter(F.col("productname").contains(product_contains))
    return conv


def products(conv: DataFrame) -> DataFrame:
    return conv.select("grpnum", "productname").distinct()


def group_dates(conv: DataFrame) -> DataFrame:
    return conv.select("grpnum", "convdate").distinct()


def nonstandard_upcs(conv: DataFrame, params: ReportParams) -> DataFrame:
    """Listed codes outside the own-brand code range."""
    return conv.filter(~F.col("upc").between(*params.own_codes)).select("upc")


def report_groups(conv: DataFrame, brand_flag: str | None) -> DataFrame:
    """The groups to report, one row each with the division they are sorted under."""
    if brand_flag is not None:
        conv = conv.filter(F.col("brand") == brand_flag)
    return conv.groupBy("grpnum").agg(F.min("division").alias("division"))


def report_groups_by_brand(conv: DataFrame) -> DataFrame:
    """The groups of all brands: by brand, division and group, each where it comes first."""
    first = F.min(F.struct(_last_if_null("brand"), _last_if_null("division"))).alias("first")
    places = conv.groupBy("grpnum").agg(first).select("grpnum", "first.*")
    order = [F.col(c).asc_nulls_last() for c in ("brand", "division")]
    shown = [F.col(f"{c}.value").alias(c) for c in ("brand", "division")]
    return places.select("grpnum", *shown).orderBy(*order, "grpnum")


def _last_if_null(name: str) -> Column:
    """A column as a struct that sorts unknown values last."""
    value = F.col(name)
    return F.struct(value.isNull().alias("unknown"), value.alias("value")).alias(name)


def in_report_order(df: DataFrame, *more: str) -> DataFrame:
    """Rows by division (unknown last), then group number."""
    return df.orderBy(F.col("division").asc_nulls_last(), "grpnum", *more)


def group_header(conv: DataFrame, params: ReportParams) -> DataFrame:
    """One row per group: names, launch date, the dates its slices are cut at, and the title.

    Launch date, product and division are those of one list row: the first by date, product and division.
    """
    names = ("convdate", "productname", "division")
    first = F.min(F.struct(*[_last_if_null(name) for name in names])).alias("first")
    per_group = conv.groupBy("grpnum").agg(first)
    dated = per_group.select(
        "grpnum",
        *[F.col(f"first.{name}.value").alias(name) for name in ("division", "productname", "convdate")],
    ).select(
        "*",
        F.date_sub("convdate", YEAR_DAYS).alias("conv_dt_yago"),
        F.date_sub("convdate", PRE_LAUNCH_DAYS).alias("start_date"),
        F.lit(params.stop_date).alias("stop_date"),
        F.lit(params.stop_yago).alias("stop_dt_yago"),
    )
    title = F.concat(
        "productname",
        F.lit(f": {params.source_label} "),
        F.date_format("start_date", "yyyy-MM-dd"),
        F.lit(" to "),
        F.date_format("stop_date", "yyyy-MM-dd"),
    )
    return dated.withColumn("title", title)


def group_attributes(conv: DataFrame) -> DataFrame:
    """How many products, divisions and dates each group carries; more than one is a list error."""
    return conv.groupBy("grpnum").agg(
        F.count_distinct("productname").alias("n_products"),
        F.count_distinct("division").alias("n_divisions"),
        F.count_distinct("convdate").alias("n_dates"),
    )
