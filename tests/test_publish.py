from datetime import date

import pytest

from brandtrack import site_list, tables_from
from brandtrack.sources.publish import publish, published_rows, shared_folder, write_summary
from star_data import SCHEMAS


def test_published_table_reads_back(spark, tmp_path):
    rows = [(1, date(2001, 1, 5), "a"), (2, None, None)]
    df = spark.createDataFrame(rows, "k int, d date, t string")
    path = str(tmp_path / "table")
    assert sorted(publish(df, path).collect()) == sorted(df.collect())
    again = publish(df.filter("k = 1"), path)
    assert [r.k for r in again.collect()] == [1]
    counts = published_rows(first=df, second=again)
    assert sorted(tuple(r) for r in counts.collect()) == [("first", 2), ("second", 1)]


def test_shared_folder_is_below_the_named_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first.startswith(root) and first != second


def test_summary_file_has_a_header_and_no_row_number(spark, tmp_path):
    schema = "division string, productname string, grp int, share double"
    df = spark.createDataFrame([("Dairy", "Milk", 29, 0.5)], schema).repartition(1)
    write_summary(df, str(tmp_path / "summary"))
    (part,) = (tmp_path / "summary").glob("part-*.csv")
    assert part.read_text() == "division,productname,grp,share\nDairy,Milk,29,0.5\n"


def test_tables_by_name(spark):
    frames = {name: spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()}
    names = {"loyal_fact": "fact"}
    tables = tables_from(frames.__getitem__, site_list(spark, [415, "432"]), names)
    assert sorted(r[0] for r in tables.listed_sites.collect()) == ["415", "432"]
    assert tables.order_loyalty is None


def test_missing_columns_are_named(spark):
    frames = {name: spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()}
    frames["item"] = frames["item"].drop("trade_item_cd")
    with pytest.raises(ValueError, match="item lacks the columns trade_item_cd"):
        tables_from(frames.__getitem__, site_list(spark, [1]), {"loyal_fact": "fact"})
    frames["item"] = spark.createDataFrame([], SCHEMAS["item"])
    frames["fact"] = frames["fact"].drop("cnsmr_id_typ_loy_cd")
    with pytest.raises(ValueError, match="cnsmr_id_typ_loy_cd"):
        tables_from(frames.__getitem__, site_list(spark, [1]), {"loyal_fact": "fact"})
