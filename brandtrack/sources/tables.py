"""The star schema the report reads."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACT_COLUMNS = (
    "ord_event_key",
    "ord_touchpoint_key",
    "trade_item_key",
    "ord_date_key",
    "purch_amt",
    "purch_qty",
)
DIMENSION_COLUMNS = {
    "touchpoint": ("touchpoint_key", "ntwk_id", "site_id_txt"),
    "item": ("trade_item_key", "trade_item_cd", "lgl_entity_nbr"),
    "calendar": ("date_key", "cal_dt", "cal_sat_wk_ending_dt"),
    "hierarchy": ("trade_item_key", "trade_item_hier_l2_cd", "trade_item_hier_l3_cd"),
    "listed_sites": ("site_id_txt",),
}


@dataclass(frozen=True)
class Tables:
    """The report's inputs, one lazy DataFrame each.

    ``loyal_fact`` serves the banner whose old brand is listed code by code, ``fact`` the two banners
    whose old brand is inferred. The loyalty code is either a column of ``loyal_fact``
    (``cnsmr_id_typ_loy_cd``) or, where the order header holds it, a table ``order_loyalty`` of
    ``(ord_event_key, cnsmr_id_typ_loy_cd)``; that join then comes last, on the rows that are left. Where the
    customer holds the code, ``order_loyalty`` is ``(ord_event_key, cnsmr_key)`` and ``customer_loyalty``
    ``(cnsmr_key, cnsmr_id_typ_loy_cd)``. An order is a loyalty order if any of its header rows is. Give the
    header ``ord_date_key`` only if it is the date key of all the order's lines: it is then cut to the report's
    days at its scan. ``bucketed_by_order`` tells that ``loyal_fact`` and ``order_loyalty`` are stored in the same
    number of buckets of the order key, as ``sources.bucketed`` writes them: their join then shuffles neither.
    ``levels`` names the hierarchy's column of each level where groups may ask for other levels than 2 and 3; the list
    then needs a column ``Hierarchy Level <n> Code`` for each.
    """

    loyal_fact: DataFrame
    fact: DataFrame
    touchpoint: DataFrame
    item: DataFrame
    calendar: DataFrame
    hierarchy: DataFrame
    listed_sites: DataFrame
    order_loyalty: DataFrame | None = None
    customer_loyalty: DataFrame | None = None
    bucketed_by_order: bool = False
    levels: dict[int, str] | None = None

    def __post_init__(self) -> None:
        wanted = {"loyal_fact": FACT_COLUMNS, "fact": FACT_COLUMNS, **DIMENSION_COLUMNS}
        for name, columns in wanted.items():
            missing = [c for c in columns if c not in getattr(self, name).columns]
            if missing:
                raise ValueError(f"{name} lacks the columns {', '.join(missing)}")
        missing = [c for c in (self.levels or {}).values() if c not in self.hierarchy.columns]
        if missing:
            raise ValueError(f"hierarchy lacks the columns {', '.join(missing)}")
        holder = self.loyal_fact if self.order_loyalty is None else self.order_loyalty
        if self.customer_loyalty is not None:
            holder = self.customer_loyalty
            if self.order_loyalty is None or "cnsmr_key" not in self.order_loyalty.columns:
                raise ValueError("customer_loyalty needs an order_loyalty with cnsmr_key")
        if "cnsmr_id_typ_loy_cd" not in holder.columns:
            raise ValueError("cnsmr_id_typ_loy_cd is in none of the tables that may hold it")


def site_list(spark: SparkSession, stores: Iterable[int | str]) -> DataFrame:
    """A list of store numbers as a table of site texts."""
    texts = F.split(F.lit("\n".join(str(s) for s in stores)), "\n")
    return spark.range(1).select(F.explode(texts).alias("site_id_txt"))


def tables_from(
    read: Callable[[str], DataFrame], listed_sites: DataFrame, names: dict[str, str] | None = None
) -> Tables:
    """Tables read by name, for example ``tables_from(spark.table, site_list(spark, stores))``.

    ``names`` maps the field names of ``Tables`` to the names ``read`` understands; unnamed fields are
    read under their own name. Name ``order_loyalty`` and ``customer_loyalty`` to read them too.
    """
    names = names or {}
    fields = ["loyal_fact", "fact", "touchpoint", "item", "calendar", "hierarchy"]
    fields += [field for field in ("order_loyalty", "customer_loyalty") if field in names]
    frames = {field: read(names.get(field, field)) for field in fields}
    return Tables(listed_sites=listed_sites.select(F.col("site_id_txt").cast("string")), **frames)
