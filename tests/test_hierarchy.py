"""Groups that name any level of a hierarchy."""

import random
from datetime import date
from types import SimpleNamespace

import duckdb
import pytest

from brandtrack import ReportParams
from brandtrack.operators import category, hierarchy
from brandtrack.operators.hierarchy import Hierarchy
from brandtrack.sources.publish import publish
from star_data import CONV, SCHEMAS, plan_of, sorted_rows, spark_rows

DAY = date(2001, 1, 5)
LEVELS = {2: "trade_item_hier_l2_cd", 3: "trade_item_hier_l3_cd"}


def writer(folder):
    return lambda df, name: publish(df, f"{folder}/{name}")


def params(rows=1000):
    return ReportParams(stop_date=date(2001, 6, 30), broadcast_rows=rows, salts=3)


def tables(spark, places, items):
    return SimpleNamespace(
        hierarchy=spark.createDataFrame(places, SCHEMAS["hierarchy"]), item=spark.createDataFrame(items, SCHEMAS["item"])
    )


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_two_levels_give_the_three_branches(spark, tmp_path, broadcast_rows):
    """A code below two others, a missing product, codes without item and items without code."""
    rows = [
        ("D", "New", 1, 30, "b", "Flour", 7, 70, DAY, 3),
        ("D", "Old", 2, 30, "b", "Flour", 7, 70, DAY, 3),
        ("D", "Old", 3, 31, "b", "Milk", 7, 70, DAY, 2),
        ("D", "Old", 4, 32, "b", None, 8, 70, DAY, 3),
        ("D", "Old", 5, 33, "b", "Milk", 8, 80, DAY, 3),
        ("D", "Old", 6, 34, "b", "Eggs", 8, 80, DAY, 2),
        ("D", "Old", 7, 35, "b", "Tea", 99, None, DAY, 3),
        ("D", "Old", None, 36, "b", "Tea", None, 70, DAY, 2),
    ]
    places = [(10, "70", "7"), (11, "70", "8"), (12, "80", "8"), (13, "70", "7"), (14, "70", None), (15, None, "8"), (16, None, None), (17, "70", "7")]
    items = [(key, 100 + key, 99 if key == 13 else 38) for key in range(10, 17)]
    made, conv, chosen = tables(spark, places, items), spark.createDataFrame(rows, CONV), params(broadcast_rows)
    tree = hierarchy.from_levels(made.hierarchy, LEVELS, writer(tmp_path))
    found = hierarchy.category_of_any_level(conv, tree, {2: "hierl2cd", 3: "hierl3cd"}, made, chosen, writer(tmp_path))
    lookups = category.list_lookups(conv, chosen)
    assert spark_rows(found) == spark_rows(category.category_upcs(conv, lookups["codes"], made, chosen))


def random_tree(seed):
    """Four levels; some nodes have two parents, some none, and some edges come twice."""
    draw = random.Random(seed)
    depth = {0: 0} | {n: draw.randint(1, 3) for n in range(1, 40)}
    edges = []
    for n, d in depth.items():
        above = [m for m, e in depth.items() if e < d]
        edges += [(n, draw.choice(above)) for _ in range(draw.choice((0, 1, 1, 2, 2))) if above]
    homes = [(key, draw.randrange(40)) for key in range(300)]
    items = [(key, 1000 + key, draw.choice((38, 38, 99))) for key in range(300)]
    asked = [(f"D{i}", "Old", i, 30 + i % 6, "b", draw.choice(("Flour", "Milk")), draw.randrange(40), draw.randrange(40), DAY, draw.randint(2, 3)) for i in range(25)]
    return depth, edges + [(None, 1), (1, None)], homes, items, asked


@pytest.mark.parametrize("seed, broadcast_rows", [(0, 1000), (1, 1000), (2, 0), (3, 0)])
def test_random_graphs_match_recursive_sql(spark, tmp_path, seed, broadcast_rows):
    """Any node of the graph may be named; its codes stand at level 2 or 3 of the list."""
    depth, edges, homes, items, asked = random_tree(seed)
    places = [(n, 2 + n % 2, str(n)) for n in depth]
    tree = Hierarchy(
        homes=spark.createDataFrame(homes, "trade_item_key bigint, node int"),
        edges=spark.createDataFrame(edges, "node int, parent int"),
        places=spark.createDataFrame(places, "node int, depth int, code string"),
    )
    conv, chosen = spark.createDataFrame(asked, CONV), params(broadcast_rows)
    made = tables(spark, [(1, "1", "1")], items)
    con = duckdb.connect()
    con.execute("CREATE TABLE edge (node INT, parent INT); CREATE TABLE place (node INT, depth INT, code VARCHAR)")
    con.execute("CREATE TABLE home (trade_item_key BIGINT, node INT); CREATE TABLE item (trade_item_key BIGINT, upc BIGINT, owner INT)")
    con.execute("CREATE TABLE conv (a VARCHAR, s VARCHAR, upc BIGINT, grpnum INT, b VARCHAR, p VARCHAR, l3 BIGINT, l2 BIGINT, d DATE, l INT)")
    for name, rows in (("edge", edges), ("place", places), ("home", homes), ("item", items), ("conv", asked)):
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    recursive = """WITH RECURSIVE up(node, above) AS (
        SELECT node, node FROM place UNION SELECT up.node, parent FROM up JOIN edge ON above = edge.node WHERE parent IS NOT NULL)"""

    above = hierarchy.places_above(tree, writer(tmp_path), chosen)
    assert spark_rows(above) == sorted_rows(con.sql(f"{recursive} SELECT * FROM up").fetchall(), ["node", "above"])

    found = hierarchy.category_of_any_level(conv, tree, {2: "hierl2cd", 3: "hierl3cd"}, made, chosen, writer(tmp_path))
    expected = con.sql(f"""{recursive},
        wish AS (
            SELECT 2 AS depth, l2 AS code, grpnum, l FROM conv WHERE l = 2
            UNION SELECT 3, l3, grpnum, l FROM conv WHERE l = 3 OR p = 'Milk')
        SELECT item.upc, grpnum, l AS levelflag, wish.code AS hier_cd
        FROM wish JOIN place ON place.depth = wish.depth AND place.code = wish.code::VARCHAR
            JOIN up ON above = place.node JOIN home ON home.node = up.node JOIN item USING (trade_item_key) WHERE owner = 38
        UNION SELECT upc, grpnum, l, if(l = 3, l3, l2) FROM conv""")
    assert spark_rows(found) == sorted_rows(expected.fetchall(), expected.columns)
    assert "CartesianProduct" not in plan_of(found) and "NestedLoop" not in plan_of(found)


def test_long_chains_take_few_rounds_and_loops_are_an_error(spark, tmp_path):
    chain = spark.range(200).selectExpr("cast(id as int) as node", "cast(id + 1 as int) as parent")
    written = []

    def write(df, name):
        written.append(name)
        return publish(df, f"{tmp_path}/{name}")

    assert hierarchy.ancestors(chain, write, params()).count() == 200 * 201 // 2
    assert len(written) <= 10
    loop = chain.union(spark.createDataFrame([(200, 150)], chain.schema))
    with pytest.raises(ValueError, match="above themselves"):
        hierarchy.ancestors(loop, write, params())
    assert hierarchy.ancestors(chain.limit(0), write, params()).count() == 0


def test_further_levels_need_their_columns(spark):
    from dataclasses import replace

    from brandtrack.sample_queries import sample_report

    made = sample_report(spark, "/root/testdata/sf0.001")
    with pytest.raises(ValueError, match="hierarchy lacks the columns nowhere"):
        replace(made.tables, levels={1: "nowhere"})
