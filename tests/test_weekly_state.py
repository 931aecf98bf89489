"""Weekly sums carried on from week to week equal sums pulled anew."""

import dataclasses
import random
import re
from datetime import date, timedelta
from decimal import Decimal

import pytest

from brandtrack.operators import pulls
from brandtrack.sample_queries import _with_doubles, sample_report
from brandtrack.sources.versions import VersionedTables
from brandtrack.weekly_state import WeeklyState
from star_data import STOP, checked, day_key, duck, plan_of, report, spark_rows
from test_random_stars import random_star

WEEK = timedelta(days=7)


def of_week(spark, rows, folder, stop, state=None, corrected=(), on_order=False, **params):
    made = report(spark, rows, folder, on_order, **params)
    made.params = dataclasses.replace(made.params, stop_date=stop)
    made.state, made.corrected = state, corrected
    return made


def weeks(made):
    loyal, inferred = made.loyal_weeks, made.inferred_weeks
    return {
        "sr_upc_week": pulls.loyal_brand_rows(loyal),
        "sr_cat_week": pulls.loyal_category_rows(loyal),
        "prfg_upc_week": pulls.inferred_brand_rows(inferred),
        "prfg_cat_week": pulls.inferred_category_rows(inferred),
    }


def equal(made, con):
    for name, df in weeks(made).items():
        expected = checked(con, name)
        assert len(expected) > 3 and spark_rows(_with_doubles(df)) == expected, name


@pytest.mark.parametrize("seed, on_order, bound", [(3, False, 10_000), (4, "customer", 0)])
def test_a_week_on_the_state_of_the_week_before_equals_a_full_run(spark, tmp_path, seed, on_order, bound):
    more = {"broadcast_rows": bound, "salts": 3}
    rng = random.Random(seed)
    rows = random_star(seed)
    state = WeeklyState(VersionedTables(spark, str(tmp_path / "state")))
    first = of_week(spark, rows, tmp_path / "first", STOP - WEEK, state, on_order=on_order, **more)
    weeks(first)
    assert not state.work.keeps and max(state.work.days) == STOP - WEEK

    # the next week: lines of three days are corrected, one group's list changes, one group goes
    days = [date(2001, 1, 20), date(2000, 7, 15), date(2001, 5, 5)]
    keys = {day_key(d) for d in days}

    def corrected(lines):
        return [(*r[:4], Decimal(rng.randrange(100)), r[5] + 1, r[6]) if r[3] in keys else r for r in lines]

    after = {**rows, "fact": corrected(rows["fact"]), "loyal_fact": corrected(rows["loyal_fact"])}
    groups = sorted({r[3] for r in rows["conv"] if r[8] is not None})
    gone, changed = groups[0], groups[1]
    conv = [r for r in rows["conv"] if r[3] != gone]
    dropped = next(r for r in conv if r[3] == changed and r[2] is not None)
    after["conv"] = [r for r in conv if r != dropped]
    second = of_week(spark, after, tmp_path / "second", STOP, state, days, on_order, **more)
    equal(second, duck(after))
    assert state.work.keeps
    assert set(state.work.days) == {STOP - timedelta(days=i) for i in range(7)} | set(days)
    assert changed in state.work.groups and gone not in state.work.groups
    version = state.versions.latest()

    # once more: nothing is read and nothing written
    equal(of_week(spark, after, tmp_path / "third", STOP, state, on_order=on_order, **more), duck(after))
    assert state.work.is_done and state.versions.latest() == version
    # an earlier week is there as well
    again = of_week(spark, after, tmp_path / "again", STOP - WEEK, state, on_order=on_order, **more)
    plain = of_week(spark, after, tmp_path / "plain", STOP - WEEK, on_order=on_order, **more)
    for name, df in weeks(again).items():
        assert spark_rows(df) == spark_rows(weeks(plain)[name]), name


def test_other_rules_or_stores_read_everything_again(spark, tmp_path):
    rows = random_star(9)
    state = WeeklyState(VersionedTables(spark, str(tmp_path / "state")))
    weeks(of_week(spark, rows, tmp_path / "a", STOP, state))
    weeks(of_week(spark, {**rows, "listed_sites": [("3",), ("4",), ("5",)]}, tmp_path / "b", STOP, state))
    assert not state.work.keeps
    moved = {**rows, "listed_sites": [("3",), ("4",), ("5",)]}
    equal(of_week(spark, moved, tmp_path / "c", STOP, state), duck(moved))
    assert state.work.is_done


def test_a_changed_group_read_for_an_earlier_week_is_read_on_later(spark, tmp_path):
    """The days after the earlier stop date are not taken as read for the group."""
    rows = random_star(6)
    state = WeeklyState(VersionedTables(spark, str(tmp_path / "state")))
    weeks(of_week(spark, rows, tmp_path / "a", STOP, state))
    group = next(r[3] for r in rows["conv"] if r[8] is not None and r[2] is not None)
    dropped = next(r for r in rows["conv"] if r[3] == group and r[2] is not None)
    after = {**rows, "conv": [r for r in rows["conv"] if r != dropped]}
    weeks(of_week(spark, after, tmp_path / "b", STOP - WEEK, state))
    equal(of_week(spark, after, tmp_path / "c", STOP, state), duck(after))


def test_only_new_days_reach_the_scan(spark):
    made = sample_report(spark, "/root/testdata/sf0.001")
    days = [made.params.stop_date - timedelta(days=i) for i in range(7)]
    star = made.star.only(days, None, "days")
    for build in (pulls.loyal_days, pulls.inferred_days):
        plan = plan_of(build(star))
        scan = next(block for block in plan.split("\n\n") if "lineitem.parquet" in block)
        pushed = re.search(r"PushedFilters: \[(.*)\]", scan)[1]
        wanted = re.search(r"In\(l_shipdate, \[([^\]]*)\]\)", pushed)[1]
        assert sorted(wanted.split(",")) == sorted(f"{d}T00:00" for d in days)
    read = pulls.inferred_days(star).agg({"cal_dt": "min"}).first()[0]
    assert read >= min(days)
