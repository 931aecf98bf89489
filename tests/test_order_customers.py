"""Orders whose header names several customers, over both kinds of join to the customers."""

import dataclasses

import pytest

from brandtrack.operators import pulls
from brandtrack.sample_queries import _with_doubles
from star_data import checked, duck, report, spark_rows
from test_random_stars import random_star

NOT_LOYAL, LOYAL = (-1, 90), (95, 96)


@pytest.mark.parametrize("broadcast_rows", [10_000, 0])
def test_an_order_is_loyal_if_any_of_its_customers_is(spark, tmp_path, broadcast_rows):
    rows = random_star(11)
    con = duck(rows)
    made = report(spark, rows, tmp_path, "customer", broadcast_rows=broadcast_rows, salts=3)
    orders = {line[0]: line[-1] for line in rows["loyal_fact"]}
    more = [(order, customer) for order in orders for customer in (*NOT_LOYAL, None)]
    more += [(order, customer) for order, code in orders.items() if code == "LOYL" for customer in LOYAL]
    header = made.tables.order_loyalty
    customers = made.tables.customer_loyalty
    coded = [(c, "NONE") for c in NOT_LOYAL] + [(c, "LOYL") for c in LOYAL]
    made.tables = dataclasses.replace(
        made.tables,
        order_loyalty=header.union(spark.createDataFrame(more, header.schema)),
        customer_loyalty=customers.union(spark.createDataFrame(coded, customers.schema)),
    )
    assert made.star.customers.fits == (broadcast_rows > 0)
    loyal = pulls.loyal_weekly(made.star)
    found = {
        "sr_upc_order_week": pulls.loyal_brand_orders(made.star),
        "sr_cat_order_week": pulls.loyal_category_orders(made.star),
        "sr_upc_week": pulls.loyal_brand_rows(loyal),
        "sr_cat_week": pulls.loyal_category_rows(loyal),
        "banner_metrics": made.banner_metrics(),
    }
    for name, df in found.items():
        expected = checked(con, name)
        assert len(expected) > 3, name
        assert spark_rows(_with_doubles(df)) == expected, name
