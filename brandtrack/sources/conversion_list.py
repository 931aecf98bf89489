"""The conversion list as delivered: one row per product code, codes as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LIST_COLUMNS = (
    "Division",
    "Series",
    "UPC",
    "Group Number",
    "brand",
    "productname",
    "Hierarchy Level 3 Code",
    "Hierarchy Level 2 Code",
    "Date",
    "level_flag",
)


def read_conversion_list(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    """Read the list from CSV with a header, or from parquet.

    Columns are matched by name, so the file may hold more of them in any order. Codes stay text until
    the clean-up; the date must be written ``yyyy-mm-dd`` in a CSV.
    """
    if format == "csv":
        rows = spark.read.option("header", True).csv(path)
    else:
        rows = spark.read.format(format).load(path)
    return rows.select(*LIST_COLUMNS).withColumn("Date", F.col("Date").cast("date"))


def listed_rows(raw: DataFrame) -> DataFrame:
    """One row: how many rows the list was delivered with."""
    return raw.agg(F.count(F.lit(1)).alias("n_rows"))
