"""Shares and weekly means per group and banner, and totals over the banners.

All groups and banners come out of one aggregation over the weekly rows, which are few. Sums are kept as
exact decimals and turned into doubles only where they are divided, so results do not depend on the
order in which tasks finish.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import share, weekly_mean
from ..params import PRE_LAUNCH_DAYS, YEAR_DAYS, ReportParams

BANNERS = ("SR", "PR", "FG")
TOTAL = "Total"
MEASURES = ("sales", "units")

KEY_METRICS = (
    "avg_old_sales",
    "avg_new_sales",
    "avg_cat_sales",
    "new_units_share",
    "old_units_share_yago",
    "new_sales_share",
    "old_sales_share_yago",
)
NEW_OLD_SHARES = ("new_old_sales_share", "new_old_units_share")


def _sum_of(*values: Column) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0)) for v in values])


def _week(banner: str, present: dict[str, str], measures: dict[str, str]) -> str:
    """One banner's week as a struct expression."""
    columns = [f"{flag} AS {name}" for name, flag in present.items()]
    for name, value in measures.items():
        kind = "bigint" if "units" in name else "decimal(38,2)"
        columns.append(f"CAST({value} AS {kind}) AS {name}")
    return f"struct('{banner}' AS banner, {', '.join(columns)})"


def _loyal_week() -> str:
    measures = {}
    for m in MEASURES:
        measures |= {
            f"new_{m}": f"new_{m}_ty",
            f"old_{m}": f"old_{m}_ty",
            f"cat_{m}": f"cat_{m}_ty",
            f"yago_brand_{m}": f"old_{m}_ly",
            f"yago_old_{m}": f"old_{m}_ly",
            f"yago_cat_{m}": f"cat_{m}_ly",
        }
    present = {"has_new": "has_brand", "has_old": "has_brand", "has_cat": "has_cat"}
    return _week("SR", present, measures)


def _inferred_week(banner: str) -> str:
    b = banner.lower()
    measures = {}
    for m in MEASURES:
        measures |= {
            f"new_{m}": f"new_{m}_{b}",
            f"old_{m}": f"old_{m}_{b}",
            f"cat_{m}": f"cat_{m}_{b}",
            f"yago_brand_{m}": f"coalesce(new_{m}_{b}, 0) + coalesce(old_{m}_{b}, 0)",
            f"yago_old_{m}": f"old_{m}_{b}",
            f"yago_cat_{m}": f"cat_{m}_{b}",
        }
    return _week(banner, {"has_new": "has_new", "has_old": "has_old", "has_cat": "true"}, measures)


def banner_weeks(loyal: DataFrame, inferred: DataFrame) -> DataFrame:
    """One row per group, banner and week, with the same columns for every banner.

    ``yago_brand_*`` is what counts as the brand a year ago: the listed old codes, or for the inferred
    banners every own-brand item. ``yago_old_*`` is the old series alone.
    """
    loyal_rows = f"inline(array({_loyal_week()}))"
    inferred_rows = f"inline(array({_inferred_week('PR')}, {_inferred_week('FG')}))"
    return loyal.selectExpr("grpnum", "week_end", loyal_rows).unionByName(
        inferred.selectExpr("grpnum", "week_end", inferred_rows)
    )


def with_banners(groups: DataFrame) -> DataFrame:
    """Each group once per banner."""
    names = F.explode(F.array(*[F.lit(b) for b in BANNERS]))
    return groups.select("*", names.alias("banner"))


def metric_parts(weeks: DataFrame, header: DataFrame, params: ReportParams) -> DataFrame:
    """The sums and means all metrics are made of, per group and banner.

    A group without any sale keeps its rows; its sums are NULL and count as 0 in shares.
    """
    week, launch = F.col("week_end"), F.col("convdate")
    slices = {
        "year_ago": week.between(F.date_sub(launch, YEAR_DAYS), F.lit(params.stop_yago)),
        "since_launch": week.between(launch, F.lit(params.stop_date)),
        "before_launch": (week >= F.date_sub(launch, PRE_LAUNCH_DAYS)) & (week < launch),
        "whole": week.between(F.date_sub(launch, PRE_LAUNCH_DAYS), F.lit(params.stop_date)),
    }
    keys = ["grpnum", "banner"]
    groups = with_banners(header.select("grpnum", "convdate"))
    sliced = groups.join(weeks, keys, "left").withColumns(slices)

    def total(value: str, where: str, name: str) -> Column:
        return F.expr(f"sum(CASE WHEN {where} THEN {value} END)").alias(name)

    def last(value: str, where: str, name: str) -> Column:
        chosen = (f"CASE WHEN {where} THEN {c} END" for c in (value, "week_end"))
        return F.expr(f"max_by({', '.join(chosen)})").alias(name)

    parts = []
    for m in MEASURES:
        parts += [
            total(f"new_{m}", "since_launch", f"new_{m}"),
            total(f"old_{m}", "since_launch", f"old_{m}"),
            total(f"cat_{m}", "since_launch", f"cat_{m}"),
            total(f"yago_brand_{m}", "year_ago", f"yago_brand_{m}"),
            total(f"yago_cat_{m}", "year_ago", f"yago_cat_{m}"),
        ]
    means = {
        "avg_old_sales": ("old_sales", "before_launch AND has_old"),
        "avg_new_sales": ("new_sales", "since_launch AND has_new"),
        "avg_cat_sales": ("cat_sales", "whole AND has_cat"),
    }
    parts += [
        weekly_mean(F.col(value), F.expr(where)).alias(name)
        for name, (value, where) in means.items()
    ]
    parts += [
        last("new_sales", "since_launch AND has_new", "last_new_sales"),
        last("cat_sales", "whole AND has_cat", "last_cat_sales"),
        last("yago_old_sales", "year_ago AND has_old", "last_yago_old_sales"),
        last("yago_cat_sales", "year_ago AND has_cat", "last_yago_cat_sales"),
    ]
    return sliced.groupBy(*keys).agg(*parts)


def rated(parts: DataFrame) -> DataFrame:
    """All metrics per group, for each banner and for their total, in one aggregation.

    Total shares pool the sums of the banners. A total mean is the sum of the three banner means, and
    missing as soon as one of them is.
    """
    pooled = [f"{brand}_{m}" for m in MEASURES for brand in ("new", "old", "cat")]
    pooled += [f"yago_{brand}_{m}" for m in MEASURES for brand in ("brand", "cat")]

    def mean(name: str) -> Column:
        of_banner = [F.max(F.when(F.col("banner") == b, F.col(name))) for b in BANNERS]
        total = reduce(lambda a, b: a + b, of_banner)
        return F.when(F.col("shown") == TOTAL, total).otherwise(F.max(name)).alias(name)

    shown = F.explode(F.array("banner", F.lit(TOTAL))).alias("shown")
    sums = [F.sum(c).alias(c) for c in pooled]
    means = [mean(name) for name in KEY_METRICS if name.startswith("avg_")]
    merged = parts.select("*", shown).groupBy("grpnum", "shown").agg(*sums, *means)
    shares = {}
    for m in MEASURES:
        new, old, whole = F.col(f"new_{m}"), F.col(f"old_{m}"), F.col(f"cat_{m}")
        shares |= {
            f"old_{m}_share_yago": share(F.col(f"yago_brand_{m}"), F.col(f"yago_cat_{m}")),
            f"new_{m}_share": share(new, whole),
            f"new_old_{m}_share": share(_sum_of(new, old), whole),
        }
    return merged.withColumns(shares).select(
        "grpnum", F.col("shown").alias("banner"), *KEY_METRICS, *NEW_OLD_SHARES
    )


def banner_metrics(rated_rows: DataFrame) -> DataFrame:
    """Shares, share change and weekly means: one row per group and banner."""
    change = F.col("new_sales_share") - F.col("old_sales_share_yago")
    return rated_rows.filter(F.col("banner") != TOTAL).select(
        "grpnum", "banner", *KEY_METRICS, change.alias("sales_share_change")
    )


def total_metrics(rated_rows: DataFrame) -> DataFrame:
    """Totals over the banners: one row per group."""
    totals = rated_rows.filter(F.col("banner") == TOTAL)
    return totals.select("grpnum", *KEY_METRICS, *NEW_OLD_SHARES)


def key_metrics(rated_rows: DataFrame) -> DataFrame:
    """The metrics of each banner and their total, as rows of one table."""
    return rated_rows.select("grpnum", "banner", *KEY_METRICS)


def loyal_new_old_share(rated_rows: DataFrame) -> DataFrame:
    """New and old brand together as a share of the category, for the loyal banner."""
    return rated_rows.filter(F.col("banner") == "SR").select("grpnum", "new_old_sales_share")


def latest_week_share(parts: DataFrame) -> DataFrame:
    """Share of the last week with a sale, for the inferred banners.

    Brand and category each take their own last week; the two need not be the same.
    """
    return parts.filter(F.col("banner") != "SR").select(
        "grpnum",
        "banner",
        F.try_divide(
            F.col("last_new_sales").cast("double"), F.col("last_cat_sales").cast("double")
        ).alias("new_share"),
        F.try_divide(
            F.col("last_yago_old_sales").cast("double"),
            F.col("last_yago_cat_sales").cast("double"),
        ).alias("old_share_yago"),
    )
