"""Lasting tables change as a whole or not at all."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brandtrack.sample_queries import sample_report
from brandtrack.sources.versions import VersionedTables
from star_data import plan_of


def numbers(df):
    return sorted(r[0] for r in df.collect())


def test_versions_are_read_back_and_pinned(spark, tmp_path):
    tables = VersionedTables(spark, str(tmp_path))
    assert tables.latest() is None and tables.versions() == [] and tables.tables() == []
    assert tables.write(a=spark.range(3), b=spark.range(1)) == 1
    opened = tables.read("a")
    assert tables.write(a=tables.read("a").filter("id > 0")) == 2
    assert (numbers(tables.read("a")), numbers(tables.read("b"))) == ([1, 2], [0])
    assert numbers(opened) == numbers(tables.read("a", 1)) == [0, 1, 2]
    assert tables.rows() == {"a": 2, "b": 1} and tables.rows(1) == {"a": 3, "b": 1}
    assert VersionedTables(spark, str(tmp_path)).versions() == [1, 2]
    tables.write(a=spark.range(0))
    tables.prune(keep=1)
    assert tables.versions() == [3] and numbers(tables.read("a")) == [] and numbers(tables.read("b")) == [0]
    assert len(list((tmp_path / "data").iterdir())) == 2  # of tables a and b


def test_a_write_that_dies_half_way_leaves_the_old_version_whole(spark, tmp_path):
    tables = VersionedTables(spark, str(tmp_path))
    tables.write(a=spark.range(100), b=spark.range(5))
    # the first table is written, the second fails in a task after others have written their files
    dies = spark.range(0, 1000, 1, 8).withColumn("id", F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        tables.write(a=spark.range(7), b=dies.select(F.col("id").cast("long")))
    assert tables.versions() == [1]
    assert tables.read("a").count() == 100 and tables.read("b").count() == 5
    assert len(list((tmp_path / "data").iterdir())) == 2  # what the dead write has left
    tables.prune()
    assert len(list((tmp_path / "data").iterdir())) == 1
    assert tables.write(a=spark.range(7)) == 2 and tables.read("a").count() == 7


def test_a_draft_of_a_manifest_is_no_version(spark, tmp_path):
    tables = VersionedTables(spark, str(tmp_path))
    tables.write(a=spark.range(2))
    manifests = Path(tmp_path, "_versions")
    (manifests / "_draft-1").write_text('{"a": ')
    assert tables.versions() == [1] and tables.read("a").count() == 2


def test_of_two_writers_of_one_number_the_second_fails(spark, tmp_path):
    tables = VersionedTables(spark, str(tmp_path))
    tables.write(a=spark.range(1))
    tables._commit(2, tables._manifest(1), "data/none")
    with pytest.raises(RuntimeError, match="another writer"):
        tables._commit(2, {}, "data/none")
    assert tables.tables() == ["a"]


def test_counts_are_taken_while_tables_are_written(spark, tmp_path, monkeypatch):
    """No job reads a table back to count it."""
    made = sample_report(spark, "/root/testdata/sf0.001")
    tables = VersionedTables(spark, str(tmp_path))
    monkeypatch.setattr(VersionedTables, "read", lambda *_: pytest.fail("read back"))
    rows = tables.rows(made.upload_to(tables))
    assert rows == {"conversion_list": made.conv.count(), "category_upcs": made.dated_category.count()}


def test_codes_are_counted_while_they_are_dated(spark):
    from brandtrack.operators import category as cat
    from brandtrack.sample_queries import queries

    df = queries()["dq_fanout"](spark, "/root/testdata/sf0.001")
    made = sample_report(spark, "/root/testdata/sf0.001")
    assert df.collect() == cat.fan_out(made.category, made.dated_category).collect()
    assert "Scan parquet" not in plan_of(df)
