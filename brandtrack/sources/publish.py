"""Written results: tables that later steps read back, and the summary file."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    That is the folder in ``spark.checkpoint.dir``, or the one the context was given. Only a local session
    without either falls back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="brandtrack-")
    return f"{root.rstrip('/')}/brandtrack-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str) -> tuple:
    """The file system of a path and the path on it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def is_published(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table or a folder of them, wherever it lies."""
    system, place = _place(spark, path)
    system.delete(place, True)


def publish(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet, replacing what is there, and return the written table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def published_rows(**tables: DataFrame) -> DataFrame:
    """Row count of each table: ``(table_name, n_rows)``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


def write_summary(df: DataFrame, path: str) -> None:
    """Write the summary as CSV with a header and without a row-number column."""
    df.write.mode("overwrite").option("header", True).csv(path)
