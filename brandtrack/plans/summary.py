"""The report's tables as they are read: the summary and the formatted key metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import money_text, percent_text
from ..operators.conversion import in_report_order
from .metrics import BANNERS, KEY_METRICS, TOTAL

# Headings of the formatted table, in the order of KEY_METRICS.
KEY_METRIC_HEADINGS = (
    "Avg. Wkly Pre-Launch Old Brand Sales",
    "Avg. Wkly New Brand Sales",
    "Avg. Wkly Category Sales",
    "New Brand Units % of Cat. Launch to Date",
    "Old Brand Units %  of Cat. Launch to Date YAGO",
    "New Brand Sales % of Cat. Launch to Date",
    "Old Brand Sales %  of Cat. Launch to Date YAGO",
)

# Column names of the summary and the total each one shows.
SUMMARY_COLUMNS = {
    "avg_brand_share": "new_sales_share",
    "avg_brand_share_newold": "new_old_sales_share",
    "avg_brand_share_yago": "old_sales_share_yago",
    "avg_brand_share_u": "new_units_share",
    "avg_brand_share_newold_u": "new_old_units_share",
    "avg_brand_share_yago_u": "old_units_share_yago",
}


def summary(totals: DataFrame, header: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per group in the order of ``groups``: division, product, group and six shares."""
    names = header.select("grpnum", F.col("division").alias("shown"), "productname")
    rows = in_report_order(names.join(totals, "grpnum").join(groups, "grpnum"))
    return rows.select(
        F.col("shown").alias("division"),
        "productname",
        F.col("grpnum").alias("grp"),
        *[F.col(source).alias(name) for name, source in SUMMARY_COLUMNS.items()],
    )


def key_metrics_table(metrics: DataFrame, groups: DataFrame) -> DataFrame:
    """Key metrics as text, in the order of ``groups`` with the total last; missing values stay NULL."""
    order = F.array_position(F.array(*[F.lit(b) for b in (*BANNERS, TOTAL)]), F.col("banner"))
    texts = [
        (money_text if name.startswith("avg_") else percent_text)(F.col(name)).alias(name)
        for name in KEY_METRICS
    ]
    placed = metrics.join(groups, "grpnum").withColumn("place", order)
    return in_report_order(placed, "place").select("grpnum", "banner", *texts)


def with_headings(table: DataFrame) -> DataFrame:
    """The formatted table under the headings a reader sees."""
    renamed = dict(zip(KEY_METRICS, KEY_METRIC_HEADINGS, strict=True))
    return table.withColumnsRenamed(renamed)
