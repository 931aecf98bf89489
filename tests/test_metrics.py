"""Metrics and trend from weekly rows written by hand."""

from datetime import date, timedelta

import pytest

from brandtrack import ReportParams
from brandtrack.operators.conversion import group_header
from brandtrack.plans import metrics, summary, trend
from star_data import CONV

PARAMS = ReportParams(stop_date=date(2001, 6, 30))
LAUNCH = date(2001, 6, 1)  # a Friday
W1, W2, W3 = (LAUNCH + timedelta(days=1 + 7 * i) for i in range(3))
BEFORE = LAUNCH - timedelta(days=6)
YAGO = W1 - timedelta(days=364)

LOYAL = (
    "grpnum int, week_end date, has_brand boolean, has_cat boolean, old_sales_ly decimal(38,2), "
    "old_sales_ty decimal(38,2), new_sales_ty decimal(38,2), cat_sales_ly decimal(38,2), "
    "cat_sales_ty decimal(38,2), old_units_ly bigint, old_units_ty bigint, new_units_ty bigint, "
    "cat_units_ly bigint, cat_units_ty bigint"
)
INFERRED = "grpnum int, week_end date, has_new boolean, has_old boolean, " + ", ".join(
    f"{b}_{m}_{s} {'bigint' if m == 'units' else 'decimal(38,2)'}"
    for b in ("new", "old", "cat")
    for m in ("sales", "units")
    for s in ("pr", "fg")
)


def loyal(week, old_ly=0, old=0, new=0, cat_ly=0, cat=0, has_brand=True, has_cat=True, group=30):
    money = [None if v is None else v for v in (old_ly, old, new, cat_ly, cat)]
    return (group, week, has_brand, has_cat, *money, *[int(v) for v in money])


def inferred(week, new=0, old=0, cat=0, has_new=True, has_old=True, group=30):
    sums = []
    for value in (new, old, cat):
        sums += [value, value * 2, value, value * 2]  # PR, FG; sales, then units
    return (group, week, has_new, has_old, *sums)


@pytest.fixture
def made(spark):
    def run(loyal_rows, inferred_rows, groups=((30, LAUNCH),)):
        from decimal import Decimal

        def exact(rows, schema):
            kinds = [c.strip().split(" ")[1] for c in schema.split(", ")]
            return spark.createDataFrame(
                [
                    tuple(Decimal(v) if k.startswith("dec") else v for v, k in zip(row, kinds))
                    for row in rows
                ],
                schema,
            )

        conv = spark.createDataFrame(
            [("Dairy", "New", 1, g, "b", "Milk", 7, 70, day, 3) for g, day in groups], CONV
        )
        header = group_header(conv, PARAMS)
        weeks = metrics.banner_weeks(exact(loyal_rows, LOYAL), exact(inferred_rows, INFERRED))
        return weeks, header, metrics.metric_parts(weeks, header, PARAMS)

    return run


def by_banner(df):
    return {(r.grpnum, r.banner): r for r in df.collect()}


def test_slices_and_means(made):
    rows = [
        loyal(YAGO, old_ly=20, cat_ly=100),
        loyal(YAGO - timedelta(days=7), old_ly=999, cat_ly=999),  # ends before the year-ago slice
        loyal(BEFORE, old=30, cat=60),
        loyal(W1, new=10, old=4, cat=40),
        loyal(W3, new=30, old=0, cat=60),  # no sales in the second week
        loyal(date(2001, 7, 7), new=999, cat=999),  # after the stop date
    ]
    _, _, parts = made(rows, [])
    rated = metrics.rated(parts)
    r = by_banner(metrics.banner_metrics(rated))[30, "SR"]
    assert r.old_sales_share_yago == 0.2
    assert r.new_sales_share == 0.4
    assert r.sales_share_change == pytest.approx(0.2)
    assert r.avg_old_sales == 30.0
    assert r.avg_new_sales == 20.0  # over the two weeks with rows, not over three
    assert r.avg_cat_sales == (60 + 40 + 60) / 3
    assert metrics.loyal_new_old_share(rated).first().new_old_sales_share == 0.44


def test_group_without_sales_keeps_its_rows(made):
    _, _, parts = made([loyal(W1, new=1, cat=2)], [], groups=((30, LAUNCH), (31, LAUNCH)))
    rows = by_banner(metrics.key_metrics(metrics.rated(parts)))
    assert set(rows) == {(g, b) for g in (30, 31) for b in ("SR", "PR", "FG", "Total")}
    assert rows[31, "Total"].new_sales_share is None
    assert rows[30, "PR"].avg_cat_sales is None
    assert rows[30, "Total"].avg_cat_sales is None  # one banner has no mean
    assert rows[30, "Total"].new_sales_share == 0.5  # sums are pooled all the same


def test_year_ago_brand_is_both_series_for_inferred_banners(made):
    rows = [inferred(YAGO, new=5, old=15, cat=100), inferred(W1, new=10, old=30, cat=80)]
    _, _, parts = made([], rows)
    got = by_banner(metrics.banner_metrics(metrics.rated(parts)))
    for banner in ("PR", "FG"):
        assert got[30, banner].old_sales_share_yago == 0.2
        assert got[30, banner].new_sales_share == 0.125
    total = metrics.total_metrics(metrics.rated(parts)).first()
    assert total.new_old_sales_share == 0.5
    assert total.new_old_units_share == 0.5


def test_latest_weeks_of_brand_and_category_may_differ(made):
    rows = [
        inferred(YAGO, new=1, old=5, cat=50),
        inferred(W1, new=10, old=1, cat=40),
        inferred(W2, old=2, cat=80, has_new=False),
    ]
    _, _, parts = made([], rows)
    got = by_banner(metrics.latest_week_share(parts))
    assert set(got) == {(30, "PR"), (30, "FG")}
    assert got[30, "PR"].new_share == 10 / 80
    assert got[30, "PR"].old_share_yago == 5 / 50


def test_latest_week_without_new_sales_is_null(made):
    _, _, parts = made([], [inferred(W1, old=5, cat=10, has_new=False)])
    got = by_banner(metrics.latest_week_share(parts))
    assert got[30, "PR"].new_share is None and got[30, "PR"].old_share_yago is None


def test_total_share_lies_between_the_banner_shares(made):
    rows = [loyal(W1, new=30, cat=40), loyal(W2, new=3, cat=9)]
    _, _, parts = made(rows, [inferred(W1, new=10, cat=80), inferred(W3, new=4, cat=7)])
    got = by_banner(metrics.key_metrics(metrics.rated(parts)))
    shares = [got[30, b].new_sales_share for b in ("SR", "PR", "FG")]
    assert min(shares) <= got[30, "Total"].new_sales_share <= max(shares)


def test_trend_fills_weeks_and_keeps_sums(made):
    rows = [loyal(BEFORE, old=30, cat=60), loyal(W1, new=10, cat=40), loyal(W3, new=30, cat=60)]
    weeks, header, _ = made(rows, [inferred(W2, new=1, old=2, cat=3)])
    series = [r for r in trend.weekly_trend(weeks, header).collect() if r.banner == "SR"]
    assert len(series) == 31
    assert len({r.week_end for r in series}) == 31
    assert {r.week_end: r.new_sales for r in series}[W2] == 0
    assert sum(r.cat_sales for r in series) == 160


def test_trend_is_in_order_of_weeks(made, spark):
    rows = [loyal(BEFORE, old=30, cat=60), loyal(W1, new=10, cat=40)]
    weeks, header, _ = made(rows, [], groups=((31, date(2001, 3, 2)), (30, date(2001, 1, 5))))
    shown = trend.weekly_trend(weeks.repartition(7), header.repartition(5)).collect()
    places = [(r.grpnum, ("SR", "PR", "FG").index(r.banner), r.week_end) for r in shown]
    assert places == sorted(places) and len(places) > 60


def test_group_launched_after_the_stop_date_has_no_trend(made):
    weeks, header, parts = made([], [], groups=((30, date(2002, 2, 2)),))
    assert trend.weekly_trend(weeks, header).count() == 0
    assert metrics.total_metrics(metrics.rated(parts)).count() == 1


def test_summary_and_formatted_table(made):
    rows = [loyal(YAGO, old_ly=1225, cat_ly=10000), loyal(W1, new=1, cat=8)]
    _, header, parts = made(rows, [])
    rated = metrics.rated(parts)
    groups = header.select("grpnum", "division")
    row = summary.summary(metrics.total_metrics(rated), header, groups).first()
    assert (row.division, row.productname, row.grp) == ("Dairy", "Milk", 30)
    assert row.avg_brand_share == 0.125 and row.avg_brand_share_yago == 0.1225
    assert row.avg_brand_share_newold_u == 0.125
    table = summary.key_metrics_table(metrics.key_metrics(rated), groups)
    lines = table.collect()
    assert [r.banner for r in lines] == ["SR", "PR", "FG", "Total"]
    assert lines[0].old_sales_share_yago == "12.2%"
    assert lines[0].avg_new_sales == "$1"
    assert lines[1].avg_new_sales is None
    headed = summary.with_headings(table)
    assert headed.columns[2:] == list(summary.KEY_METRIC_HEADINGS)
