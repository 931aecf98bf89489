"""Small hand-made stars, and the check SQL over them."""

from __future__ import annotations

import contextlib
import io
from datetime import date, timedelta

import duckdb
import pyarrow as pa

from pyspark.sql import functions as F

import check_sql
from brandtrack import ReportParams, Tables
from brandtrack.report import BrandReport

STOP = date(2001, 6, 30)

CONV = (
    "division string, series string, upc bigint, grpnum int, brand string, productname string, "
    "hierl3cd bigint, hierl2cd bigint, convdate date, levelflag int"
)
SCHEMAS = {
    "hierarchy": "trade_item_key bigint, trade_item_hier_l2_cd string, trade_item_hier_l3_cd string",
    "item": "trade_item_key bigint, trade_item_cd bigint, lgl_entity_nbr int",
    "touchpoint": "touchpoint_key bigint, ntwk_id int, site_id_txt string",
    "calendar": "date_key bigint, cal_dt date, cal_sat_wk_ending_dt date",
    "fact": "ord_event_key bigint, ord_touchpoint_key bigint, trade_item_key bigint, "
    "ord_date_key bigint, purch_amt decimal(18,2), purch_qty bigint, cnsmr_id_typ_loy_cd string",
    "listed_sites": "site_id_txt string",
}


def week_end(day: date) -> date:
    return day + timedelta(days=(5 - day.weekday()) % 7)


def day_key(day: date) -> int:
    """A surrogate key that does not follow the order of the days."""
    return (day.toordinal() * 7919) % 1_000_003


def calendar_rows(first: date, last: date):
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    return [(day_key(d), d, week_end(d)) for d in days]


def as_frames(spark, rows: dict, loyalty_on_order: bool = False):
    frames = {name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()}
    loyal = rows.get("loyal_fact", rows["fact"])
    frames["loyal_fact"] = spark.createDataFrame(loyal, SCHEMAS["fact"])
    if loyalty_on_order:
        code = "cnsmr_id_typ_loy_cd"
        header = frames["loyal_fact"].select("ord_event_key", code)  # orders repeat
        frames["order_loyalty"] = header
        frames["loyal_fact"] = frames["loyal_fact"].drop(code)
    if loyalty_on_order == "customer":
        customer = F.col("ord_event_key") % 40  # codes go by order modulo 4
        frames["order_loyalty"] = header.select("ord_event_key", customer.alias("cnsmr_key")).distinct()
        coded = header.select(customer.alias("cnsmr_key"), code).groupBy("cnsmr_key")
        frames["customer_loyalty"] = coded.agg(F.max_by(code, F.col(code) == "LOYL").alias(code))
    return Tables(**frames)


class ListedReport(BrandReport):
    """A report that starts from cleaned list rows."""

    def __init__(self, tables, conv, params, folder):
        super().__init__(tables, conv, params, folder)
        self.__dict__["conv"] = conv


def report(spark, rows: dict, folder, loyalty_on_order=False, **params) -> BrandReport:
    chosen = ReportParams(stop_date=STOP, **{"brand_flag": None, **params})
    conv = spark.createDataFrame(rows["conv"], CONV)
    tables = as_frames(spark, rows, loyalty_on_order)
    return ListedReport(tables, conv, chosen, str(folder))


def _column(rows, i, kind):
    return pa.array([r[i] for r in rows], kind)


def duck(rows: dict) -> duckdb.DuckDBPyConnection:
    """The same rows under the names the check SQL uses."""
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "date": pa.date32()}
    kinds["decimal(18,2)"] = pa.decimal128(18, 2)
    con = duckdb.connect()
    for name, schema in {**SCHEMAS, "conv": CONV}.items():
        columns = [c.strip().split(" ") for c in schema.split(", ")]
        table = pa.table({c: _column(rows[name], i, kinds[k]) for i, (c, k) in enumerate(columns)})
        con.register(f"{name}_rows", table)
    con.execute("CREATE VIEW conv AS SELECT * FROM conv_rows")
    con.execute("CREATE VIEW item AS SELECT * FROM item_rows")
    con.execute("CREATE VIEW touchpoint AS SELECT * FROM touchpoint_rows")
    con.execute("CREATE VIEW fg_store AS SELECT site_id_txt AS site FROM listed_sites_rows")
    con.execute("""CREATE VIEW hierarchy AS SELECT trade_item_key, trade_item_hier_l3_cd AS l3_cd,
        trade_item_hier_l2_cd AS l2_cd FROM hierarchy_rows""")
    columns = [c.strip().split(" ") for c in SCHEMAS["fact"].split(", ")]
    loyal = rows.get("loyal_fact", rows["fact"])
    con.register("loyal_rows", pa.table({c: _column(loyal, i, kinds[k]) for i, (c, k) in enumerate(columns)}))
    for view, source in (("loyal_view", "loyal_rows"), ("other_view", "fact_rows")):
        con.execute(f"""CREATE VIEW {view} AS SELECT f.*, cnsmr_id_typ_loy_cd AS loyalty, cal_dt,
            cal_sat_wk_ending_dt AS week_end FROM {source} f JOIN calendar_rows ON ord_date_key = date_key""")
    return con


def checked(con, name: str):
    """Run one of the check queries, without the part that builds its tables."""
    text = check_sql.CHECK_SQL[name].replace(f"{check_sql.TABLES},", "")
    text = text.replace(f"WITH {check_sql.TABLES}", "")
    result = con.sql(text)
    return sorted_rows(result.fetchall(), result.columns)


def sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def spark_rows(df):
    return sorted_rows([tuple(r) for r in df.collect()], df.columns)


def plan_of(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return out.getvalue()
