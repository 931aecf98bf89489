"""Whole pulls and metrics on random stars against the check SQL, over both kinds of join.

The stars hold what the sample tables lack: repeated list rows, several launch dates in a group, codes
shared by items, stores without a site, series that are neither old nor new, lines without an amount,
and one store, item and order that hold a third of all lines each.
"""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest

from brandtrack.operators import pulls
from brandtrack.plans import trend
from brandtrack.sample_queries import _with_doubles
from star_data import calendar_rows, checked, day_key, duck, report, spark_rows

OWN = 4119000000


def random_star(seed: int) -> dict:
    rng = random.Random(seed)
    codes = [OWN + i if i % 3 else 5_000_000_000 + i for i in range(40)]
    items = [(k, rng.choice(codes), rng.choice([38, 38, 38, 99, None])) for k in range(60)]
    l3 = [str(rng.randrange(6)) for _ in range(60)]
    hierarchy = [(k, str(100 + int(l3[k]) // 2), l3[k]) for k in range(60)]
    launches = [date(2001, 1, 5) + timedelta(days=rng.randrange(60)) for _ in range(6)]
    launches += [date(2000, 10, 7), None, date(2002, 2, 2)]
    conv = set()
    for group in range(29, 36):
        product = rng.choice(["Milk", "Soup", None])
        level = rng.choice([2, 3, 3, None])
        dates = rng.sample(launches, rng.choice([1, 1, 2]))
        for _ in range(rng.randrange(1, 9)):
            code = rng.randrange(6)
            conv.add(
                (
                    rng.choice(["Dairy", "Bakery", None]),
                    rng.choice(["Old", "New", "New", None, "Other"]),
                    rng.choice([*codes, None]),
                    group,
                    rng.choice("bp"),
                    product,
                    code,
                    100 + code // 2,
                    rng.choice(dates),
                    level,
                )
            )
    stores = [(s, rng.choice([66, 66, 301, 999, None]), rng.choice([str(s), None])) for s in range(12)]
    first, last = date(1999, 9, 1), date(2001, 8, 31)
    span = (last - first).days
    hot_item, hot_store, hot_order = rng.randrange(60), rng.randrange(12), 1
    facts = []
    for _ in range(3000):
        quantity = rng.randrange(-2, 9)
        order = hot_order if rng.random() < 0.33 else rng.randrange(2, 400)
        facts.append(
            (
                order,
                hot_store if rng.random() < 0.33 else rng.randrange(12),
                hot_item if rng.random() < 0.33 else rng.randrange(60),
                day_key(first + timedelta(days=rng.randrange(span + 1))),
                rng.choice([None, *[Decimal(rng.randrange(-500, 100000)) / 100] * 9]),
                quantity,
                ("NONE", "LOYL", "LOYL", None)[order % 4],
            )
        )
    return {
        "conv": sorted(conv, key=repr),
        "fact": facts[:2500],
        "loyal_fact": facts[500:],
        "item": items,
        "hierarchy": hierarchy,
        "touchpoint": stores,
        "calendar": calendar_rows(first, last),
        "listed_sites": [(str(s),) for s in range(3, 8)],
    }


def compared(made):
    star = made.star
    loyal, inferred = pulls.loyal_weekly(star), pulls.inferred_weekly(star)
    orders = pulls.inferred_brand_orders(star)
    return {
        "upc_cat_all": made.category,
        "upc_cat_dated": made.dated_category,
        "sr_upc_order_week": pulls.loyal_brand_orders(star),
        "sr_cat_order_week": pulls.loyal_category_orders(star),
        "sr_upc_week": pulls.loyal_brand_rows(loyal),
        "sr_cat_week": pulls.loyal_category_rows(loyal),
        "prfg_upc_order_week": orders,
        "prfg_upc_series": pulls.tag_series(orders, made.conv, made.params),
        "prfg_upc_week": pulls.inferred_brand_rows(inferred),
        "prfg_cat_order_week": pulls.inferred_category_orders(star),
        "prfg_cat_week": pulls.inferred_category_rows(inferred),
        "banner_metrics": made.banner_metrics(),
        "latest_week_share": made.latest_week_share(),
        "sr_new_old_share": made.loyal_new_old_share(),
        "total_metrics": made.total_metrics(),
        "key_metrics": made.key_metrics(),
        "key_metrics_table": made.key_metrics_table(),
        "week_spine": trend.week_spine(made.header),
        "weekly_trend": made.weekly_trend(),
    }


@pytest.mark.parametrize(
    "seed,broadcast_rows,on_order", [(1, 10_000, "customer"), (2, 0, False), (5, 30, True), (8, 0, "customer")]
)
def test_random_star(spark, tmp_path, seed, broadcast_rows, on_order):
    """Everything broadcast, nothing broadcast, and some of both; loyalty on the line or the order."""
    rows = random_star(seed)
    con = duck(rows)
    made = report(spark, rows, tmp_path, on_order, broadcast_rows=broadcast_rows, salts=3)
    fits = {lookup.fits for lookup in (*made.star.items.values(), *made.star.stores.values())}
    assert fits == {1: {True}, 2: {False}, 5: {True, False}, 8: {False}}[seed]
    for name, df in compared(made).items():
        expected = checked(con, name)
        assert len(expected) > 3, name
        assert spark_rows(_with_doubles(df)) == expected, name
