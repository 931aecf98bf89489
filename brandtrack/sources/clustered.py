"""Order-level tables laid out so that a reader of one group and week opens few row groups.

These tables are as large as the matched lines, and are read a group or a week at a time. Rows are dealt out by ranges
of the keys and sorted, so that a file's row groups hold narrow ranges, and Parquet's statistics skip the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

#: What readers of the order-level tables filter by, and what cuts a large group and week into several files.
CLUSTER_KEYS = ("grpnum", "week_end")
SPREAD_KEYS = ("ord_event_key",)
ROW_GROUP_ROWS = 1_000_000


def write_clustered(
    df: DataFrame,
    path: str,
    by: Sequence[str] = CLUSTER_KEYS,
    spread: Sequence[str] = SPREAD_KEYS,
    row_group_rows: int = ROW_GROUP_ROWS,
) -> DataFrame:
    """Write ``df`` at ``path`` in ranges of ``by`` and return the written table.

    Ranges are cut by ``by`` and ``spread`` together, so a hot group and week lies in several files, each written by a
    task of its own. Adaptive execution settles the number of ranges by their size. Nulls come first. Ranges are cut from
    a sample of what is dealt out; where that is a shuffled sum, the sample reads the sums and no line a second time.
    """
    keys = [*by, *spread]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = dealt.write.mode("overwrite").option("parquet.block.row.count.limit", row_group_rows)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
