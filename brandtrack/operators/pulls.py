"""Brand and category sales by group and week, one pass over the order lines per pull."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import ReportParams
from .sizing import attach, count_rows
from .star import Star, in_this_year, in_year_ago

MEASURES = (("sales", "purch_amt"), ("units", "purch_qty"))


def _sum_copies(name: str, counted: str, condition: str, value: str, copies: str) -> Column:
    """Sum over the lines that are ``counted`` at all: the value as often as its copies say where the
    condition holds, else 0. Without any such line, or with unknown values only, it is NULL.

    A line that counts more often than its copies say adds a 0 for each other time, so an unknown value is 0 there.
    Money keeps its cents exactly; units are whole.
    """
    taken = f"CASE WHEN {counted} > {copies} THEN coalesce({value} * {copies}, 0) ELSE {value} * {copies} END"
    met = f"CASE WHEN {condition} AND {copies} > 0 THEN {taken} ELSE 0 END"
    kind = "decimal(38,2)" if value == "purch_amt" else "bigint"
    total = f"CAST(sum(CASE WHEN {counted} > 0 THEN {met} END) AS {kind})"
    return F.expr(total).alias(name)


def _summed(lines: DataFrame, *keys: str) -> DataFrame:
    """Lines summed per slice: two running sums, whatever is computed from them later."""
    return lines.groupBy(*keys).agg(
        F.sum("purch_amt").alias("purch_amt"), F.sum("purch_qty").alias("purch_qty")
    )


# --- the banner whose old brand is listed ---------------------------------------------------------

# Each brand: what makes a line count, its copies, and the windows it is summed over.
LOYAL_BRAND = {"old": ("listed", "old", ("ly", "ty")), "new": ("listed", "new", ("ty",))}
LOYAL_CATEGORY = {"cat": ("category", "category", ("ly", "ty"))}
WINDOWS = {"ly": "year_ago", "ty": "this_year"}
LOYAL_COPIES = ("listed", "old", "new", "category")
DAY_KEYS = ("grpnum", "convdate", "cal_dt", "week_end")


def _loyal_lines(star: Star, per_order: bool = False) -> DataFrame:
    windows = {"year_ago": in_year_ago(star.params), "this_year": in_this_year()}
    return star.lines("loyal", per_order).withColumns(windows)


def _loyal_sums(brands: dict[str, tuple[str, str, tuple[str, ...]]]) -> list[Column]:
    return [
        _sum_copies(f"{brand}_{measure}_{w}", counted, WINDOWS[w], value, copies)
        for measure, value in MEASURES
        for brand, (counted, copies, windows) in brands.items()
        for w in windows
    ]


def loyal_weekly(star: Star) -> DataFrame:
    """Brand and category sums by group and week for the loyal banner.

    ``has_brand`` and ``has_cat`` tell whether the week has a listed or a categorised line at all, even
    if its sums are 0: means divide by the number of such weeks.
    """
    keys = ("grpnum", "week_end", *WINDOWS.values(), *LOYAL_COPIES)
    return _loyal_weeks(_summed(_loyal_lines(star), *keys))


def _loyal_weeks(slices: DataFrame) -> DataFrame:
    return slices.groupBy("grpnum", "week_end").agg(
        F.expr("max(listed) > 0").alias("has_brand"),
        F.expr("max(category) > 0").alias("has_cat"),
        *_loyal_sums(LOYAL_BRAND | LOYAL_CATEGORY),
    )


def loyal_days(star: Star) -> DataFrame:
    """Running sums by group, launch date, day and copies: what the weeks of any stop date are made of."""
    return _summed(star.lines("loyal"), *DAY_KEYS, *LOYAL_COPIES)


def loyal_weeks_of_days(days: DataFrame, params: ReportParams) -> DataFrame:
    """``loyal_weekly`` from ``loyal_days`` of all days up to the stop date."""
    past = days.filter(F.col("cal_dt") <= F.lit(params.stop_date))
    return _loyal_weeks(past.withColumns({"year_ago": in_year_ago(params), "this_year": in_this_year()}))


def loyal_brand_rows(weekly: DataFrame) -> DataFrame:
    rows = weekly.filter("has_brand")
    names = [c for c in weekly.columns if c.startswith(("old_", "new_"))]
    return rows.select("grpnum", "week_end", *names)


def loyal_category_rows(weekly: DataFrame) -> DataFrame:
    names = [c for c in weekly.columns if c.startswith("cat_")]
    return weekly.filter("has_cat").select("grpnum", "week_end", *names)


def loyal_banner_weekly(star: Star) -> tuple[DataFrame, DataFrame]:
    """Category and brand rows of the loyal banner, in this order."""
    weekly = loyal_weekly(star)
    return loyal_category_rows(weekly), loyal_brand_rows(weekly)


def _loyal_orders(star: Star, counted: str, brands: dict) -> DataFrame:
    lines = _loyal_lines(star, per_order=True).filter(f"{counted} > 0")
    keys = ("grpnum", "ord_event_key", "upc", "week_end")
    return lines.groupBy(*keys).agg(*_loyal_sums(brands))


def loyal_brand_orders(star: Star) -> DataFrame:
    """Brand sums by group, order, code and week. As large as the matched lines: a detail table."""
    return _loyal_orders(star, "listed", LOYAL_BRAND)


def loyal_category_orders(star: Star) -> DataFrame:
    """Category sums by group, order, code and week."""
    return _loyal_orders(star, "category", LOYAL_CATEGORY)


# --- the two banners whose old brand is inferred --------------------------------------------------

BANNER_FLAGS = (("pr", "is_inferred"), ("fg", "is_listed"))
INFERRED_COPIES = ("is_inferred", "is_listed", "category", "new", "old")


def _post_sums(copies: str, prefix: str = "post") -> list[Column]:
    """Sums per measure and banner. A store may count for both banners, and for neither."""
    return [
        _sum_copies(f"{prefix}_{measure}_{banner}", copies, flag, value, copies)
        for measure, value in MEASURES
        for banner, flag in BANNER_FLAGS
    ]


def inferred_weekly(star: Star) -> DataFrame:
    """New, old and category sums by group and week for both inferred banners.

    ``has_new`` and ``has_old`` tell whether any store, of whatever banner, sold such an item.
    """
    return _inferred_weeks(_summed(star.lines("inferred"), "grpnum", "week_end", *INFERRED_COPIES))


def _inferred_weeks(slices: DataFrame) -> DataFrame:
    return slices.groupBy("grpnum", "week_end").agg(
        F.expr("max(new) > 0").alias("has_new"),
        F.expr("max(old) > 0").alias("has_old"),
        *_post_sums("(category * new)", "new"),
        *_post_sums("(category * old)", "old"),
        *_post_sums("category", "cat"),
    )


def inferred_days(star: Star) -> DataFrame:
    """Running sums by group, launch date, day, store kind and copies."""
    return _summed(star.lines("inferred"), *DAY_KEYS, *INFERRED_COPIES)


def inferred_weeks_of_days(days: DataFrame, params: ReportParams) -> DataFrame:
    """``inferred_weekly`` from ``inferred_days`` of all days up to the stop date."""
    return _inferred_weeks(days.filter(F.col("cal_dt") <= F.lit(params.stop_date)))


def _post_columns(brand: str) -> str:
    names = [f"{measure}_{banner}" for measure, _ in MEASURES for banner, _ in BANNER_FLAGS]
    return ", ".join(f"{brand}_{name} AS post_{name}" for name in names)


def inferred_brand_rows(weekly: DataFrame) -> DataFrame:
    """Brand rows by group, series (1 new, 0 old) and week."""
    new = f"struct(1 AS upc_series, has_new AS has, {_post_columns('new')})"
    old = f"struct(0 AS upc_series, has_old AS has, {_post_columns('old')})"
    rows = weekly.select("grpnum", "week_end", F.expr(f"inline(array({new}, {old}))"))
    return rows.filter("has").drop("has")


def inferred_category_rows(weekly: DataFrame) -> DataFrame:
    return weekly.selectExpr("grpnum", "week_end", *_post_columns("cat").split(", "))


def inferred_brand_weekly(star: Star) -> tuple[DataFrame, DataFrame]:
    """Category and brand rows of the inferred banners, in this order."""
    weekly = inferred_weekly(star)
    return inferred_category_rows(weekly), inferred_brand_rows(weekly)


def inferred_brand_orders(star: Star) -> DataFrame:
    """Own-brand sums by order, code, week and group, before any series is told apart."""
    lines = star.lines("inferred", per_order=True)
    own = lines.filter(F.col("upc").between(*star.params.own_codes))
    keys = ("ord_event_key", "upc", "week_end", "grpnum")
    return own.groupBy(*keys).agg(*_post_sums("category"))


def tag_series(orders: DataFrame, conv: DataFrame, params: ReportParams) -> DataFrame:
    """Order rows with their series: 1 where the group lists the code as new, else 0.

    A code the group lists several times repeats its order rows.
    """
    new = F.when(F.col("series") == "New", 1).otherwise(0)
    listed = conv.select("upc", "grpnum", new.alias("listed_series"))
    lookup = count_rows(params.broadcast_rows, listed=listed)["listed"]
    tagged = attach(orders, lookup, ["upc", "grpnum"], params.salts, "left")
    return tagged.select(
        *orders.columns, F.coalesce("listed_series", F.lit(0)).alias("upc_series")
    )


def inferred_category_orders(star: Star) -> DataFrame:
    """Category sums by order, week and group."""
    lines = star.lines("inferred", per_order=True)
    return lines.groupBy("ord_event_key", "week_end", "grpnum").agg(*_post_sums("category"))
