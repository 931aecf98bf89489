"""Lines and order header stored in buckets of the order key, so that their join moves neither.

The weekly report joins the same lines to the same header again each week. Dealt out once, when they are stored, rows
of one order lie in the same bucket of both tables, and later joins on the order read bucket by bucket.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame

from .tables import Tables

ORDER_KEY = "ord_event_key"


def write_bucketed(df: DataFrame, name: str, path: str, n_buckets: int, key: str = ORDER_KEY) -> DataFrame:
    """Write ``df`` at ``path`` in buckets of ``key``, one sorted file each, as the catalog's table ``name``.

    Buckets are known to the catalog only, so read the table by its name. A hot order makes a large bucket: where one
    holds much of all lines, leave the lines as they are.
    """
    dealt = df.repartition(n_buckets, key)  # one task, and so one file, a bucket
    dealt.write.mode("overwrite").bucketBy(n_buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def store_by_order(tables: Tables, name: str, folder: str, n_buckets: int) -> Tables:
    """The tables with the loyal banner's lines and header stored below ``folder`` as ``name_lines`` and ``name_header``.

    Choose the number of buckets so that one bucket of lines fits a task; a multiple of the cluster's cores is best.
    """
    if tables.order_loyalty is None:
        raise ValueError("only an order header can be joined by bucket: the code is on the lines")
    return dataclasses.replace(
        tables,
        loyal_fact=write_bucketed(tables.loyal_fact, f"{name}_lines", f"{folder}/lines", n_buckets),
        order_loyalty=write_bucketed(tables.order_loyalty, f"{name}_header", f"{folder}/header", n_buckets),
        bucketed_by_order=True,
    )
