"""Every registered query against its check SQL on the sample tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from brandtrack.operators import pulls
from brandtrack.sample_queries import queries, sample_report
from star_data import plan_of, sorted_rows, spark_rows

ROOT = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{ROOT}/sf0.001/{name}.parquet'")
    return connection


def test_every_query_has_check_sql():
    known = set(queries())
    assert known <= set(entry_point.queries()) and known <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_check_sql(spark, con, name):
    df = queries()[name](spark, f"{ROOT}/sf0.001")
    expected = con.sql(entry_point.oracle_sql()[name])
    kinds = dict(zip(expected.columns, map(str, expected.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == kinds
    assert spark_rows(df) == sorted_rows(expected.fetchall(), expected.columns)
    plan = plan_of(df)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert word not in plan


def test_entry(spark):
    assert [r.productname for r in entry_point.entry(spark).collect()] == ["Flour", "Milk", "Coffee", "Rice"]


def test_order_rows_add_up_to_weeks(spark):
    made = sample_report(spark, f"{ROOT}/sf0.01")
    orders = pulls.loyal_brand_orders(made.star)
    sums = [c for c in orders.columns if c.startswith(("old_", "new_"))]
    added = orders.groupBy("grpnum", "week_end").agg({c: "sum" for c in sums})
    added = added.select("grpnum", "week_end", *[added[f"sum({c})"].alias(c) for c in sums])
    weekly = pulls.loyal_brand_rows(pulls.loyal_weekly(made.star)).select(added.columns)
    assert spark_rows(added) == spark_rows(weekly)


def test_written_weeks_give_the_same_report(spark, tmp_path):
    fresh = sample_report(spark, f"{ROOT}/sf0.001", brand_flag="b")
    written = sample_report(spark, f"{ROOT}/sf0.001", brand_flag="b").publish_weeks()
    assert fresh.summary().collect() == written.summary().collect()
    assert spark_rows(fresh.weekly_trend()) == spark_rows(written.weekly_trend())
