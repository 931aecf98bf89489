"""Reading the input tables and writing intermediate ones."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..sources.publish import publish, remove, shared_folder


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The table ``name`` below ``sf_dir``, cut to ``columns`` if any are given."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


class Workspace:
    """A folder of one run under the cluster's shared checkpoint folder.

    Lazy results read from it, so it stays until ``close``, or the end of the ``scratch`` block it was made in.
    """

    _made: list[list[Workspace]] = []

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = shared_folder(spark)
        if self._made:
            self._made[-1].append(self)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return it as read back: lineage ends here and lost tasks restart from the files."""
        return publish(df, f"{self.folder}/{name}")

    def close(self) -> None:
        """Remove what was written."""
        remove(self.spark, self.folder)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Hand tasks' Python at most so many rows at a time while a table is written; the session's setting returns."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) < rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def scratch() -> Iterator[None]:
    """Remove the workspaces made inside at the end: write the results that are wanted before, elsewhere."""
    Workspace._made.append([])
    try:
        yield
    finally:
        for work in Workspace._made.pop():
            work.close()
