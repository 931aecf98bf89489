"""Every operator of the report as a query over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import week_ending
from .operators import category as cat
from .operators import conversion as conv
from .operators import hierarchy, pulls
from .plans import trend
from .report import BrandReport
from .sources.clustered import write_clustered
from .sources.conversion_list import listed_rows, read_conversion_list
from .sources.intake import Intake, take_in
from .sources.publish import shared_folder, write_summary
from .sources.sample_tables import STOP_DATE, sample_list, sample_params, sample_tables
from .sources.versions import VersionedTables
from .weekly_state import WeeklyState

Query = Callable[[SparkSession, str], DataFrame]


def sample_report(
    spark: SparkSession, sf_dir: str, code_on_line: bool = False, state: WeeklyState | None = None, **params
) -> BrandReport:
    """The report over the sample tables, for the groups of all brands unless told otherwise."""
    chosen = sample_params(**{"brand_flag": None, **params})
    tables = sample_tables(spark, sf_dir, code_on_line)
    return BrandReport(tables, sample_list(spark, sf_dir), chosen, state=state)


def _with_doubles(df: DataFrame) -> DataFrame:
    """Money columns as doubles, for readers without wide decimals."""
    money = [f.name for f in df.schema if f.dataType.typeName() == "decimal"]
    return df.withColumns({name: F.col(name).cast("double") for name in money})


def _query(build: Callable[[BrandReport], DataFrame], **params) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _with_doubles(build(sample_report(spark, sf_dir, **params)))

    return run


def _branch(name: str) -> Query:
    return _query(lambda r: cat.category_branch(r.conv, r.tables, r.params, name))


def _upload_counts(report: BrandReport) -> DataFrame:
    """The rows of a written version, as counted while it was written."""
    versions = VersionedTables(report.spark, f"{report.folder}/uploaded")
    rows = versions.rows(report.upload_to(versions))
    counts = [F.struct(F.lit(name).alias("table_name"), F.lit(n).cast("bigint").alias("n_rows")) for name, n in rows.items()]
    return report.spark.range(1).select(F.inline(F.array(*counts)))


def _fan_out(report: BrandReport) -> DataFrame:
    counts = cat.FanOut()
    dated = cat.dated_category(counts.watched(report.category), report.lookups["dates"], report.params)
    report.publish(counts.counted(dated), "counted_codes")
    return counts.result(report.spark)


def _uploaded_list(report: BrandReport) -> DataFrame:
    """A table of a written version, read back after a later version was written."""
    versions = VersionedTables(report.spark, f"{report.folder}/uploaded")
    first = versions.read("conversion_list", report.upload_to(versions))
    versions.write(conversion_list=first.limit(0))
    return first


def _intake(report: BrandReport) -> Intake:
    return take_in(report.raw_list, f"{report.folder}/intake")


def _incremental(build: Callable[[BrandReport], DataFrame], **params) -> Query:
    """A result of the week after the state was brought up to the week before."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        state = WeeklyState(VersionedTables(spark, shared_folder(spark)))
        week_before = sample_report(spark, sf_dir, state=state, stop_date=STOP_DATE - timedelta(days=7), **params)
        week_before.publish_weeks()
        return _with_doubles(build(sample_report(spark, sf_dir, state=state, **params)))

    return run


def _list_file(report: BrandReport) -> DataFrame:
    """The list through a CSV file and back, cleaned."""
    path = f"{report.folder}/list_file"
    report.raw_list.write.option("header", True).csv(path)
    return conv.clean_list(read_conversion_list(report.spark, path), report.params.min_group)


def _summary_file(report: BrandReport) -> DataFrame:
    """The summary as read back from its file."""
    path = f"{report.folder}/summary_file"
    shown = report.summary()
    write_summary(shown, path)
    return report.spark.read.schema(shown.schema).option("header", True).csv(path)


def _week_ends(report: BrandReport) -> DataFrame:
    day = F.col("ord_date_key").cast("date")
    days = report.tables.fact.select(day.alias("cal_dt")).distinct()
    return days.withColumn("week_end", week_ending(F.col("cal_dt")))


def _stores_on_list(report: BrandReport) -> DataFrame:
    """The stores that the list of store numbers names."""
    stores = report.tables.touchpoint.join(report.tables.listed_sites, "site_id_txt")
    return stores.select("touchpoint_key", "site_id_txt", "ntwk_id")


def _tagged(report: BrandReport) -> DataFrame:
    orders = pulls.inferred_brand_orders(report.star)
    return pulls.tag_series(orders, report.conv, report.params)


# Groups of the sample list that name another level than 2 or 3.
SAMPLE_LEVELS = {"31": "1", "32": "0"}
SAMPLE_COLUMNS = {0: "trade_item_hier_l0_cd", 1: "trade_item_hier_l1_cd", 2: "trade_item_hier_l2_cd", 3: "trade_item_hier_l3_cd"}


def any_level_report(spark: SparkSession, sf_dir: str, **params) -> BrandReport:
    """The sample report with four levels: two more above level 2, each named by one group."""
    made = sample_report(spark, sf_dir, **params)
    level_2 = F.col(SAMPLE_COLUMNS[2]).cast("int")
    tree = made.tables.hierarchy.withColumns(
        {SAMPLE_COLUMNS[1]: F.floor((level_2 - 100) / 2 + 10).cast("string"), SAMPLE_COLUMNS[0]: F.lit("1")}
    )
    level = F.col("level_flag")
    for group, named in SAMPLE_LEVELS.items():
        level = F.when(F.col("Group Number") == group, named).otherwise(level)
    raw = made.raw_list.withColumns(
        {
            "level_flag": level,
            "Hierarchy Level 1 Code": F.floor((F.col("Hierarchy Level 2 Code").cast("int") - 100) / 2 + 10).cast("string"),
            "Hierarchy Level 0 Code": F.lit("1"),
        }
    )
    tables = replace(made.tables, hierarchy=tree, levels=SAMPLE_COLUMNS)
    return BrandReport(tables, raw, made.params)


def _any_level(build: Callable[[BrandReport], DataFrame]) -> Query:
    return lambda spark, sf_dir: _with_doubles(build(any_level_report(spark, sf_dir)))


def _closure(report: BrandReport) -> DataFrame:
    """The codes of all places with those of the places above them."""
    tree = hierarchy.from_levels(report.tables.hierarchy, report.tables.levels, report.publish)
    above = hierarchy.places_above(tree, report.publish, report.params)
    tops = tree.places.select(
        F.col("node").alias("above"), F.col("depth").alias("above_depth"), F.col("code").alias("above_code")
    )
    named = above.join(tree.places, "node").join(tops, "above")
    return named.select("depth", "code", "above_depth", "above_code").distinct()


def _orders_of_one(table: str) -> Callable[[BrandReport], DataFrame]:
    """One group's rows of some weeks, from an order-level table that is written for such reads."""

    def build(report: BrandReport) -> DataFrame:
        pull = {"loyal": pulls.loyal_brand_orders, "inferred": pulls.inferred_category_orders}[table]
        written = write_clustered(pull(report.star), f"{report.folder}/{table}_orders")
        weeks = F.col("week_end").between(F.lit("2001-03-03").cast("date"), F.lit("2001-03-31").cast("date"))
        return written.filter((F.col("grpnum") == 29) & weeks)

    return build


def queries() -> dict[str, Query]:
    return {
        # the conversion list
        "conv_row_count": _query(lambda r: listed_rows(r.raw_list)),
        "conv_clean": _query(lambda r: r.conv),
        "conv_scope_filters": _query(lambda r: conv.scope_list(r.conv, [30, 33], "ou", 33)),
        "conv_products": _query(lambda r: conv.products(r.conv)),
        "group_dates": _query(lambda r: conv.group_dates(r.conv)),
        "group_header": _query(lambda r: r.header),
        "report_groups": _query(
            lambda r: conv.in_report_order(conv.report_groups(r.conv, r.params.brand_flag)),
            brand_flag="b",
        ),
        "report_groups_by_brand": _query(lambda r: conv.report_groups_by_brand(r.conv)),
        "nonstandard_upcs": _query(lambda r: conv.nonstandard_upcs(r.conv, r.params)),
        "conv_from_file": _query(_list_file),
        "dq_bad_codes": _query(lambda r: conv.bad_codes(r.raw_list)),
        "list_rejected": _query(lambda r: _intake(r).report()),
        "list_intake": _query(lambda r: _intake(r).counts()),
        "uploaded_list": _query(_uploaded_list),
        "listed_stores": _query(_stores_on_list),
        "dq_group_attributes": _query(lambda r: conv.group_attributes(r.conv)),
        # the categories
        "cat_upc_l3": _branch(cat.LEVEL_3),
        "cat_upc_l2": _branch(cat.LEVEL_2),
        "cat_upc_milk": _branch(cat.BOTH_LEVELS),
        "conv_hier_codes": _query(lambda r: cat.listed_codes(r.conv)),
        "upc_cat_all": _query(lambda r: r.category),
        "upc_cat_dated": _query(lambda r: r.dated_category),
        "hier_closure": _any_level(_closure),
        "cat_upc_any_level": _any_level(lambda r: r.category),
        "upc_cat_dated_any_level": _any_level(lambda r: r.dated_category),
        "cat_groups": _query(lambda r: cat.category_groups(r.category)),
        "dq_dup_upc_in_group": _query(lambda r: cat.repeated_codes(r.category)),
        "dq_fanout": _query(_fan_out),
        "upload_counts": _query(_upload_counts),
        # the sales pulls
        "sr_upc_order_week": _query(lambda r: pulls.loyal_brand_orders(r.star)),
        "sr_cat_order_week": _query(lambda r: pulls.loyal_category_orders(r.star)),
        "sr_upc_week": _query(lambda r: r.loyal_banner_weekly()[1]),
        "sr_upc_week_line_code": _query(lambda r: r.loyal_banner_weekly()[1], code_on_line=True),
        "sr_cat_week": _query(lambda r: r.loyal_banner_weekly()[0]),
        "prfg_upc_order_week": _query(lambda r: pulls.inferred_brand_orders(r.star)),
        "prfg_upc_series": _query(_tagged),
        "prfg_upc_week": _query(lambda r: r.inferred_brand_weekly()[1]),
        "prfg_cat_order_week": _query(lambda r: pulls.inferred_category_orders(r.star)),
        "prfg_cat_week": _query(lambda r: r.inferred_brand_weekly()[0]),
        "sr_orders_of_group": _query(_orders_of_one("loyal")),
        "prfg_orders_of_group": _query(_orders_of_one("inferred")),
        "weekly_incremental": _incremental(lambda r: r.loyal_banner_weekly()[1]),
        "prfg_incremental": _incremental(lambda r: r.inferred_brand_weekly()[1]),
        "metrics_incremental": _incremental(lambda r: r.banner_metrics()),
        # weeks, metrics and the report
        "week_end_dates": _query(_week_ends),
        "week_spine": _query(lambda r: trend.week_spine(r.header)),
        "weekly_trend": _query(lambda r: r.weekly_trend()),
        "banner_metrics": _query(lambda r: r.banner_metrics()),
        "latest_week_share": _query(lambda r: r.latest_week_share()),
        "sr_new_old_share": _query(lambda r: r.loyal_new_old_share()),
        "total_metrics": _query(lambda r: r.total_metrics()),
        "key_metrics": _query(lambda r: r.key_metrics()),
        "key_metrics_table": _query(lambda r: r.key_metrics_table()),
        "headed_table": _query(lambda r: r.headed_table()),
        "summary_file": _query(_summary_file, brand_flag="b"),
        "summary": _query(lambda r: r.summary(), brand_flag="b"),
        "summary_second_brand": _query(lambda r: r.summary(), brand_flag="p"),
    }
