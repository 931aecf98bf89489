"""What the plans look like: what reaches the scan, what is broadcast, what is shuffled."""

import dataclasses
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from brandtrack.operators import pulls
from brandtrack.sample_queries import sample_report
from brandtrack.sources.publish import publish
from star_data import plan_of, report, spark_rows
from test_random_stars import random_star

SF = "/root/testdata/sf0.001"


def line_scan(plan: str) -> str:
    return next(block for block in plan.split("\n\n") if "lineitem.parquet" in block)


@contextmanager
def settings(spark, **values):
    """Session settings for a while; underscores stand for dots."""
    names = {f"spark.sql.{key.replace('_', '.')}": value for key, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def small(spark):
    return sample_report(spark, SF)


def test_scan_reads_the_reports_days_and_columns_only(small):
    plan = plan_of(pulls.inferred_weekly(small.star))
    scan = line_scan(plan)
    assert "GreaterThanOrEqual(l_shipdate,2000-01-06T00:00)" in scan
    assert "LessThanOrEqual(l_shipdate,2001-06-30T00:00)" in scan
    read = re.search(r"ReadSchema: (.*)", scan).group(1)
    assert "l_orderkey" not in read and "l_discount" not in read


def test_weekly_pull_shuffles_sums_not_lines(small):
    plan = plan_of(pulls.inferred_weekly(small.star))
    tree = plan.split("\n\n")[0]
    assert "SortMergeJoin" not in tree
    # from the last line join up: a map-side sum, then the two exchanges of summed rows
    above_joins = re.findall(r"(\w+) \(\d+\)", tree[: tree.index("BroadcastHashJoin")])
    assert above_joins[-3:] == ["Exchange", "HashAggregate", "Project"]
    assert above_joins.count("Exchange") == 2


def test_oversized_lookups_are_not_broadcast(spark):
    large = sample_report(spark, SF, broadcast_rows=0)
    star = large.star
    assert not any(lookup.fits for lookup in (*star.items.values(), *star.stores.values(), star.days))
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        plan = plan_of(pulls.inferred_weekly(star))
        salted = plan_of(pulls.inferred_category_orders(star))
    # only the literal and the 25-row side of the sample tables themselves are left
    assert plan.split("\n\n")[0].count("BroadcastHashJoin") <= 1
    # lines are summed per item, day and store kind before they are joined to the items
    assert re.search(r"Keys \[\d+\]: \[trade_item_key#\w+, [^\]]*cal_dt", plan)
    # ten stores are hot each, so their lines are spread; no item is
    assert star.items["inferred"].hot == () and len(star.stores["inferred"].hot) > 3
    spread = [k for k in re.findall(r"Left keys \[\d+\]: \[(.*?)\]", salted) if "salt" in k]
    assert spread and not any("trade_item_key" in keys for keys in spread)


def test_only_hot_keys_are_salted_and_repeated(spark, tmp_path):
    """A third of the lines on one item: its rows are spread, and the lookup grows by its copies alone."""
    made = sample_report(spark, "/root/testdata/sf0.01", broadcast_rows=0)
    plain = spark_rows(pulls.inferred_weekly(made.star))
    item = made.star.items["inferred"].frame.select("trade_item_key").first()[0]
    fact = made.tables.fact
    line = F.pmod(F.xxhash64(*fact.columns), F.lit(3)) == 0
    key = F.when(line, F.lit(item)).otherwise(F.col("trade_item_key"))
    stored = publish(fact.withColumn("trade_item_key", key).repartition(16), str(tmp_path / "lines"))
    large = sample_report(spark, "/root/testdata/sf0.01", broadcast_rows=0)
    large.tables = dataclasses.replace(large.tables, fact=stored)
    fits = sample_report(spark, "/root/testdata/sf0.01")
    fits.tables = dataclasses.replace(fits.tables, fact=stored)
    lookup = large.star.items["inferred"]
    hashed = stored.filter(F.col("trade_item_key") == item).select(F.xxhash64("trade_item_key")).first()[0]
    assert lookup.hot == (hashed,)
    salted = plan_of(pulls.inferred_category_orders(large.star))
    assert "salt" in salted
    repeated = F.when(F.xxhash64("trade_item_key").isin([hashed]), 16).otherwise(1)
    rows = lookup.frame.count()
    assert rows < lookup.frame.agg(F.sum(repeated)).first()[0] < 1.1 * rows
    for pull in (pulls.inferred_weekly, pulls.inferred_category_orders):
        assert spark_rows(pull(large.star)) == spark_rows(pull(fits.star))
    assert spark_rows(pulls.inferred_weekly(large.star)) != plain


def joins_and_exchanges(plan: str, table: str) -> list[tuple[str, str]]:
    """The operators above the scan of a table, nearest first, with what the plan says of each."""
    tree, depth = plan.split("\n\n")[0], {}
    for line in tree.splitlines():
        if found := re.search(r"(\w[\w ]*) \((\d+)\)", line):
            depth[int(found[2])] = (line.index(found[0]), found[1].strip())
    blocks = {int(m[1]): b for b in plan.split("\n\n") if (m := re.match(r"\s*\((\d+)\) ", b))}
    (scan,) = [n for n, b in blocks.items() if table in b]
    above, level = [], depth[scan][0]
    for n in sorted(k for k in depth if k > scan):
        if depth[n][0] < level:
            level = depth[n][0]
            above.append((depth[n][1], blocks[n]))
    return above


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_lines_are_cut_by_item_before_the_orders_and_the_header_moves_once(spark, bound):
    """Below the bound in one plan. Beyond it the matched lines and the loyal orders are written on the way: the header
    moves to the customers, and what then moves to the lines is the written keys of loyal orders."""
    made = sample_report(spark, SF, broadcast_rows=bound)
    plans = {}

    def keep(df, name):
        plans[name] = plan_of(df)
        return made.publish(df, name)

    star = dataclasses.replace(made.star, keep=keep)
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        plans["weeks"] = plan_of(pulls.loyal_weekly(star))
    assert set(plans) == ({"loyal_lines", "loyal_orders", "weeks"} if bound == 0 else {"weeks"})
    (with_header,) = [plan for plan in plans.values() if "orders.parquet" in plan]
    (with_lines,) = [plan for plan in plans.values() if "lineitem.parquet" in plan]
    above = joins_and_exchanges(with_header, "orders.parquet")
    meets_lines = [i for i, (kind, says) in enumerate(above) if "Join" in kind and "order_key" in says]
    below_lines = above[: meets_lines[0]] if meets_lines else above
    assert bool(meets_lines) == (bound > 0)
    moves = [says for kind, says in below_lines if kind == "Exchange"]
    assert len(moves) == 1 and ("cnsmr_key" in moves[0]) == (bound == 0)
    # the join with the items' keys is below the one with the orders
    joins = [says for kind, says in joins_and_exchanges(with_lines, "lineitem.parquet") if "Join" in kind]
    keys = [re.search(r"Left keys \[\d+\]: \[(.*)\]", says)[1] for says in joins]
    items = [i for i, key in enumerate(keys) if "trade_item_key" in key]
    orders = [i for i, key in enumerate(keys) if "ord_event_key" in key]
    assert items and (not orders if bound == 0 else min(items) < min(orders))


def test_partitions_outside_the_reports_days_are_skipped(spark, tmp_path):
    rows = random_star(7)
    made = report(spark, rows, tmp_path / "report")
    path = str(tmp_path / "lines")
    made.tables.fact.write.partitionBy("ord_date_key").parquet(path)
    stored = spark.read.parquet(path)
    made.tables = dataclasses.replace(made.tables, fact=stored, loyal_fact=stored)
    df = pulls.inferred_weekly(made.star)
    scan = next(block for block in plan_of(df).split("\n\n") if path in block)
    pruned = re.search(r"PartitionFilters: \[(.*)\]", scan).group(1)
    assert "ord_date_key" in pruned and ">=" in pruned and "<=" in pruned
    plain = report(spark, rows, tmp_path / "plain")
    assert spark_rows(df) == spark_rows(pulls.inferred_weekly(plain.star))


def test_hot_order_is_split(spark, tmp_path):
    """A third of all lines on one order: its partition is read in pieces, with the same result."""
    made = sample_report(spark, "/root/testdata/sf0.01")
    fact = made.tables.fact
    hot = F.pmod(F.xxhash64(*fact.columns), F.lit(3)) == 0
    key = F.when(hot, F.lit(1)).otherwise(F.col("ord_event_key"))
    path = str(tmp_path / "lines")
    stored = publish(fact.withColumn("ord_event_key", key).repartition(16), path)
    made.tables = dataclasses.replace(made.tables, fact=stored, loyal_fact=stored)
    plain = pulls.loyal_weekly(made.star)
    expected = spark_rows(plain)
    small_pieces = {
        "shuffle_partitions": "16",
        "adaptive_advisoryPartitionSizeInBytes": "4k",
        "adaptive_skewJoin_skewedPartitionThresholdInBytes": "4k",
    }
    with settings(spark, autoBroadcastJoinThreshold="-1", **small_pieces):
        split = pulls.loyal_weekly(made.star)
        assert spark_rows(split) == expected
        assert "skew=true" in plan_of(split)
