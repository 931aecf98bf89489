from datetime import date
from types import SimpleNamespace

import pytest

from brandtrack import ReportParams
from brandtrack.operators import category, conversion
from brandtrack.sources.conversion_list import listed_rows, read_conversion_list
from star_data import CONV, SCHEMAS, spark_rows

PARAMS = ReportParams(stop_date=date(2001, 6, 30), own_codes=(100, 199))
RAW = (
    "Division string, Series string, UPC string, `Group Number` string, brand string, "
    "productname string, `Hierarchy Level 3 Code` string, `Hierarchy Level 2 Code` string, "
    "Date date, level_flag string"
)
DAY = date(2001, 1, 5)


def test_clean_list(spark):
    row = ("Dairy", "New", "101", "29", "b", "Milk", "7", "70.0", DAY, "3")
    rows = [
        row,
        row,
        ("Dairy", "New", "n/a", "29", "b", "Milk", "7", "70", DAY, "3"),
        ("Dairy", "New", "102", "28", "b", "Milk", "7", "70", DAY, "3"),
        ("Dairy", "New", "103", "?", "b", "Milk", "7", "70", DAY, "3"),
    ]
    raw = spark.createDataFrame(rows, RAW)
    cleaned = conversion.clean_list(raw, 28)
    assert cleaned.schema.simpleString() == (
        "struct<division:string,series:string,upc:bigint,grpnum:int,brand:string,"
        "productname:string,hierl3cd:bigint,hierl2cd:bigint,convdate:date,levelflag:int>"
    )
    assert sorted((r.upc or 0, r.grpnum, r.hierl2cd) for r in cleaned.collect()) == [
        (0, 29, 70),
        (101, 29, 70),
    ]
    assert listed_rows(raw).first()["n_rows"] == 5


def test_read_list_by_column_name(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text(
        "level_flag,Note,Division,Series,UPC,Group Number,brand,productname,"
        "Hierarchy Level 3 Code,Hierarchy Level 2 Code,Date\n"
        "3,x,Dairy,New,101,29,b,Milk,7,70,2001-01-05\n"
    )
    raw = read_conversion_list(spark, str(path))
    assert conversion.clean_list(raw, 28).first().asDict() == {
        "division": "Dairy",
        "series": "New",
        "upc": 101,
        "grpnum": 29,
        "brand": "b",
        "productname": "Milk",
        "hierl3cd": 7,
        "hierl2cd": 70,
        "convdate": DAY,
        "levelflag": 3,
    }
    raw.write.parquet(str(tmp_path / "list.parquet"))
    again = read_conversion_list(spark, str(tmp_path / "list.parquet"), "parquet")
    assert again.collect() == raw.collect()


@pytest.fixture
def conv(spark):
    rows = [
        ("Grocery", "New", 101, 30, "b", "Flour", 7, 70, DAY, 3),
        ("Dairy", "Old", 999, 31, "b", "Eggs", 8, 80, DAY, 2),
        (None, "Old", None, 29, "b", "Rice", 9, 90, date(2001, 2, 3), 3),
        ("Dairy", "New", 199, 32, "p", "Paper", 9, 90, None, 3),
    ]
    return spark.createDataFrame(rows, CONV)


def test_scopes_and_views(conv):
    def groups(df):
        return sorted(r.grpnum for r in df.collect())

    assert groups(conversion.scope_list(conv, without_groups=[30, 31])) == [29, 32]
    assert groups(conversion.scope_list(conv, product_contains="our")) == [30]
    assert groups(conversion.scope_list(conv, max_group=30)) == [29, 30]
    assert groups(conversion.scope_list(conv)) == [29, 30, 31, 32]
    assert [r.upc for r in conversion.nonstandard_upcs(conv, PARAMS).collect()] == [999]
    ordered = conversion.in_report_order(conversion.report_groups(conv, "b"))
    assert [r.grpnum for r in ordered.collect()] == [31, 30, 29]
    assert conversion.report_groups(conv, None).count() == 4
    by_brand = [tuple(r) for r in conversion.report_groups_by_brand(conv).collect()]
    assert by_brand == [
        (31, "b", "Dairy"),
        (30, "b", "Grocery"),
        (29, "b", None),
        (32, "p", "Dairy"),
    ]


def test_header(conv):
    header = {r.grpnum: r for r in conversion.group_header(conv, PARAMS).collect()}
    assert header[30].conv_dt_yago == date(2000, 1, 7)
    assert header[30].start_date == date(2000, 7, 7)
    assert header[30].stop_dt_yago == date(2000, 7, 1)
    assert header[30].title == "Flour: POS 2000-07-07 to 2001-06-30"
    assert header[32].convdate is None and header[32].title is None


def test_group_attributes(spark, conv):
    more = spark.createDataFrame([("Bakery", "Old", 5, 30, "b", "Flour", 7, 70, DAY, 3)], CONV)
    counts = {r.grpnum: r for r in conversion.group_attributes(conv.union(more)).collect()}
    assert (counts[30].n_products, counts[30].n_divisions, counts[30].n_dates) == (1, 2, 1)
    assert counts[32].n_dates == 0


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_category_branches(spark, broadcast_rows):
    params = ReportParams(stop_date=PARAMS.stop_date, broadcast_rows=broadcast_rows, salts=3)
    rows = [
        ("D", "New", 1, 30, "b", "Flour", 7, 70, DAY, 3),
        ("D", "Old", 2, 30, "b", "Flour", 7, 70, DAY, 3),
        ("D", "Old", 3, 31, "b", "Milk", 7, 70, DAY, 2),
        ("D", "Old", 4, 32, "b", None, 8, 70, DAY, 3),
        ("D", "Old", 5, 33, "b", "Milk", 8, 80, DAY, 3),
    ]
    conv = spark.createDataFrame(rows, CONV)
    hierarchy = [(10, "70", "7"), (11, "70", "8"), (12, "80", "8"), (13, "70", "7")]
    items = [(10, 110, 38), (11, 111, 38), (12, 112, 38), (13, 113, 99)]

    tables = SimpleNamespace(
        hierarchy=spark.createDataFrame(hierarchy, SCHEMAS["hierarchy"]),
        item=spark.createDataFrame(items, SCHEMAS["item"]),
    )

    def branch(name):
        found = category.category_branch(conv, tables, params, name).collect()
        return sorted(tuple(r) for r in found)

    assert branch(category.LEVEL_3) == [(110, 30, 3, 7)]
    assert branch(category.LEVEL_2) == [(110, 31, 2, 70), (111, 31, 2, 70)]
    assert branch(category.BOTH_LEVELS) == [(110, 31, 2, 7), (111, 33, 3, 8), (112, 33, 3, 8)]

    lookups = category.list_lookups(conv, params)
    whole = category.category_upcs(conv, lookups["codes"], tables, params)
    by_hand = branch(category.LEVEL_3) + branch(category.LEVEL_2) + branch(category.BOTH_LEVELS)
    by_hand += [(1, 30, 3, 7), (2, 30, 3, 7), (3, 31, 2, 70), (4, 32, 3, 8), (5, 33, 3, 8)]
    assert sorted(tuple(r) for r in whole.collect()) == sorted(by_hand)

    repeated = category.repeated_codes(whole).collect()
    assert [tuple(r) for r in repeated] == [(31, 110, 2)]
    assert [r.grpnum for r in category.category_groups(whole).collect()] == [30, 31, 32, 33]


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_several_dates_repeat_a_group(spark, broadcast_rows):
    params = ReportParams(stop_date=PARAMS.stop_date, broadcast_rows=broadcast_rows, salts=3)
    rows = [
        ("D", "New", 1, 30, "b", "Flour", 7, 70, DAY, 3),
        ("D", "Old", 2, 30, "b", "Flour", 7, 70, date(2001, 1, 12), 3),
        ("D", "Old", 3, 31, "b", "Eggs", 7, 70, None, 3),
    ]
    conv = spark.createDataFrame(rows, CONV)
    found = category.listed_codes(conv)
    dates = category.list_lookups(conv, params)["dates"]
    dated = category.dated_category(found, dates, params)
    assert spark_rows(dated.select("upc", "convdate")) == sorted(
        repr((d, u))
        for u, d in [
            (1, DAY),
            (1, date(2001, 1, 12)),
            (2, DAY),
            (2, date(2001, 1, 12)),
            (3, None),
        ]
    )
    assert tuple(category.fan_out(found, dated).first()) == (3, 5, 5)
