"""Order-level tables whose readers skip most row groups."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from brandtrack.operators import pulls
from brandtrack.sample_queries import sample_report
from brandtrack.sources.clustered import write_clustered
from star_data import plan_of, spark_rows


def row_groups(folder):
    """Of each row group: its rows, and the ranges of group and week from the file's footer."""
    for path in sorted(Path(folder).glob("*.parquet")):
        footer = pq.ParquetFile(path).metadata
        for i in range(footer.num_row_groups):
            group = footer.row_group(i)
            columns = {group.column(c).path_in_schema: group.column(c).statistics for c in range(group.num_columns)}
            yield group.num_rows, *[(columns[c].min, columns[c].max) for c in ("grpnum", "week_end")]


def test_one_group_and_week_opens_few_row_groups(spark, tmp_path):
    made = sample_report(spark, "/root/testdata/sf0.01")
    orders = pulls.inferred_category_orders(made.star)
    written = write_clustered(orders, str(tmp_path / "orders"), row_group_rows=100)
    assert spark_rows(written) == spark_rows(orders)
    groups = list(row_groups(tmp_path / "orders"))
    assert sum(n for n, *_ in groups) == written.count() and len(groups) > 50
    cells = written.groupBy("grpnum", "week_end").count().collect()
    opened = {
        (c["grpnum"], c["week_end"]): sum(g[0] <= c["grpnum"] <= g[1] and w[0] <= c["week_end"] <= w[1] for _, g, w in groups)
        for c in cells
    }
    assert max(opened.values()) < 0.1 * len(groups)
    one = max(cells, key=lambda c: c["count"])
    read = written.filter((F.col("grpnum") == one["grpnum"]) & (F.col("week_end") == one["week_end"]))
    assert read.count() == one["count"]
    pushed = plan_of(read).split("PushedFilters:")[1].split("\n")[0]
    assert "EqualTo(grpnum" in pushed and "EqualTo(week_end" in pushed


def test_a_hot_group_and_week_is_cut_into_several_files(spark, tmp_path):
    rows = spark.range(40_000).selectExpr(
        "if(id % 3 = 0, 30, cast(31 + id % 7 as int)) as grpnum", "date'2001-01-06' as week_end", "id as ord_event_key"
    )
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        written = write_clustered(rows, str(tmp_path / "hot"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    sizes = [r["count"] for r in written.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2 * 40_000 / 12
    assert written.filter("grpnum = 30").select(F.input_file_name()).distinct().count() >= 4


@pytest.mark.parametrize("by", [("grpnum", "week_end"), ("week_end",)])
def test_empty_tables_and_nulls(spark, tmp_path, by):
    rows = spark.createDataFrame([(None, None, 1), (30, None, None), (30, None, None)], "grpnum int, week_end date, ord_event_key bigint")
    assert spark_rows(write_clustered(rows, str(tmp_path / "a"), by)) == spark_rows(rows)
    none = write_clustered(rows.limit(0), str(tmp_path / "b"), by)
    assert none.count() == 0 and none.schema == rows.schema


def test_the_four_tables_of_a_run(spark, tmp_path):
    made = sample_report(spark, "/root/testdata/sf0.001")
    tables = made.write_orders(str(tmp_path))
    assert spark_rows(tables["loyal_brand_orders"]) == spark_rows(pulls.loyal_brand_orders(made.star))
    assert spark_rows(tables["inferred_brand_orders"]) == spark_rows(pulls.inferred_brand_orders(made.star))
    assert sorted(tables) == ["inferred_brand_orders", "inferred_category_orders", "loyal_brand_orders", "loyal_category_orders"]
