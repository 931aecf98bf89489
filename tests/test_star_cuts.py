"""What cuts lines and header before they are multiplied or shuffled: windows, filter, buckets."""

import dataclasses
import random
import re

import pytest
from pyspark.sql import functions as F

from brandtrack.operators import key_filter as kf
from brandtrack.operators import pulls
from brandtrack.sample_queries import _with_doubles, sample_report
from brandtrack.sources.bucketed import store_by_order
from star_data import checked, duck, plan_of, report, spark_rows
from test_plans import joins_and_exchanges
from test_random_stars import random_star

LOYAL = ("sr_upc_order_week", "sr_cat_order_week", "sr_upc_week", "sr_cat_week")


def loyal_pulls(star):
    weekly = pulls.loyal_weekly(star)
    found = (pulls.loyal_brand_orders(star), pulls.loyal_category_orders(star), pulls.loyal_brand_rows(weekly), pulls.loyal_category_rows(weekly))
    return dict(zip(LOYAL, found))


def test_a_filter_holds_all_its_keys_and_few_others(spark):
    keys = spark.range(0, 60_000, 3).withColumnRenamed("id", "key")
    words = kf.n_words(20_000, 1 << 20)
    assert words == 5000
    made = kf.key_filter(keys, "key", words)
    size = made.agg(F.sum(F.size("words")) * 8).first()[0]
    assert 8 * words <= size <= 8 * (words + kf.CHUNK)
    passed = kf.may_hold(spark.range(120_000).withColumnRenamed("id", "key"), "key", made, words)
    rows = passed.select((F.col("key") % 3 == 0).alias("known"), (F.col("key") < 60_000).alias("low")).groupBy("known", "low").count()
    counts = {(r["known"], r["low"]): r["count"] for r in rows.collect()}
    assert counts[True, True] == 20_000
    assert sum(n for k, n in counts.items() if k != (True, True)) < 0.02 * 100_000
    assert "Exchange hash" not in plan_of(passed).split("BroadcastExchange")[0]


def test_a_filter_that_would_pass_too_much_is_not_built():
    assert kf.n_words(1000, 1 << 20) == 250
    assert kf.n_words(10_000_000, 8 << 20) == 1 << 20  # 6.7 bits a key
    assert kf.n_words(100_000_000, 8 << 20) is None
    assert kf.n_words(0, 1 << 20) == 1


def test_the_header_is_cut_to_the_matched_orders(spark):
    made = sample_report(spark, "/root/testdata/sf0.1", filter_rows=0)
    matched = made.star.loyal_lines.select("ord_event_key").distinct().count()
    header = made.tables.order_loyalty.count()
    cut = made.star.cut_header()
    assert matched < 0.5 * header
    assert matched <= cut.count() <= 1.2 * matched
    # no exchange of the header below the filter's join: the filter comes to it
    plain = sample_report(spark, "/root/testdata/sf0.1")
    assert spark_rows(pulls.loyal_weekly(made.star)) == spark_rows(pulls.loyal_weekly(plain.star))


@pytest.mark.parametrize("seed, on_order, more", [
    (25, "customer", {"filter_rows": 0}),
    (27, True, {"filter_rows": 0}),
    (23, "customer", {"filter_rows": 0, "filter_bytes": 0}),
    (24, "customer", {"filter_rows": 0, "broadcast_rows": 0, "salts": 3}),
])
def test_pulls_over_a_filtered_header_equal_the_check_sql(spark, tmp_path, seed, on_order, more):
    rows = random_star(seed)
    con = duck(rows)
    made = report(spark, rows, tmp_path, on_order, **more)
    for name, df in loyal_pulls(made.star).items():
        expected = checked(con, name)
        assert len(expected) > 3
        assert spark_rows(_with_doubles(df)) == expected, name


@pytest.mark.parametrize("pull, year", [("loyal", 364), ("inferred", 365)])
def test_lines_outside_every_window_are_gone_before_they_are_multiplied(spark, tmp_path, pull, year):
    """What leaves the join with the items' days is what some group of the item counts, each line once."""
    made = report(spark, random_star(31), tmp_path, salts=3)
    star = made.star
    got = star.matched(pull)
    items = star.items[pull].frame.select("trade_item_key", F.date_sub("convdate", year).alias("start"))
    store = star.stores[pull].frame.select("ord_touchpoint_key")
    stop = made.params.stop_date
    fact = star._fact(pull).join(star.days.frame, "ord_date_key").join(store, "ord_touchpoint_key")
    fact = fact.withColumn("line", F.monotonically_increasing_id())
    in_some = fact.join(items, "trade_item_key").filter((F.col("cal_dt") >= F.col("start")) & (F.col("cal_dt") <= F.lit(stop)))
    assert got.count() == in_some.select("line").distinct().count() < fact.count()
    multiplied = in_some.count()
    assert multiplied > got.count()
    assert star.lines(pull, per_order=True).count() == multiplied


def test_stored_in_buckets_the_orders_are_joined_where_they_lie(spark, tmp_path):
    rows = random_star(41)
    con = duck(rows)
    made = report(spark, rows, tmp_path / "run", "customer")
    name = f"by_order_{random.randrange(10**9)}"
    made.tables = store_by_order(made.tables, name, str(tmp_path / "stored"), 4)
    try:
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = plan_of(pulls.loyal_brand_orders(made.star))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for table in ("stored/lines", "stored/header"):
            above = joins_and_exchanges(plan, table)
            orders = next(i for i, (kind, says) in enumerate(above) if kind.startswith("SortMergeJoin") and "ord_event_key" in says)
            assert not any(kind == "Exchange" for kind, _ in above[:orders]), table
        assert len(re.findall(r"Bucketed: true", plan)) == 2
        for key, df in loyal_pulls(made.star).items():
            assert spark_rows(_with_doubles(df)) == checked(con, key), key
    finally:
        for part in ("lines", "header"):
            spark.sql(f"DROP TABLE IF EXISTS {name}_{part}")


def test_buckets_need_an_order_header(spark, tmp_path):
    made = report(spark, random_star(42), tmp_path)
    with pytest.raises(ValueError, match="on the lines"):
        store_by_order(made.tables, "none", str(tmp_path), 2)
    assert dataclasses.replace(made.tables).bucketed_by_order is False
