"""The star join: order lines with the groups, stores and weeks they count for.

The order lines are the only large input. They are cut to the report's days at the scan, joined to
lookups that are broadcast while their counted size allows, and summed on the map side, so that what is
shuffled is one row per group, week and slice and not the lines. A code listed or categorised several
times in a group counts that often; instead of repeating its lines, the lookup carries the number of
copies and the sums are multiplied by it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import INFERRED_YEAR_DAYS, PRE_LAUNCH_DAYS, YEAR_DAYS, ReportParams
from ..sources.tables import Tables
from .key_filter import key_filter, may_hold, n_words
from .sizing import Lookup, attach, hot_keys, measure

LINE_FACTS = ("purch_amt", "purch_qty")
PULLS = ("loyal", "inferred")


def classify_stores(tables: Tables, params: ReportParams) -> DataFrame:
    """Per store: does it count for the loyal, the inferred and the listed banner?

    A store without a site text is on no list, and it is not known to be off the list either, so the
    loyal banner leaves it out.
    """
    listed = tables.listed_sites.distinct().withColumn("is_listed", F.lit(True))
    on_list = F.coalesce("is_listed", F.lit(False))
    network, known = F.col("ntwk_id"), F.col("site_id_txt").isNotNull()
    return tables.touchpoint.join(listed, "site_id_txt", "left").select(
        F.col("touchpoint_key").alias("ord_touchpoint_key"),
        F.coalesce((network == params.loyal_network) & known & ~on_list, F.lit(False)).alias(
            "is_loyal"
        ),
        F.coalesce(network == params.inferred_network, F.lit(False)).alias("is_inferred"),
        on_list.alias("is_listed"),
    )


def _copies(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def report_items(
    conv: DataFrame, dated: DataFrame, tables: Tables, params: ReportParams
) -> DataFrame:
    """Every item that counts for a group, per launch date: how often, and as what.

    ``listed``, ``old`` and ``new`` count list rows of that launch date, ``category`` counts category
    rows. ``brand_new`` and ``brand_old`` are for the inferred banners, which look at the own-brand code
    and at the group's list whatever its date: new as often as listed as new, old as often as listed
    otherwise, or once where the group does not list the code.
    """
    series = F.col("series")
    listed = conv.select(
        "upc",
        "grpnum",
        "convdate",
        F.lit(1).alias("listed"),
        _copies(series == "Old").alias("old"),
        _copies(series == "New").alias("new"),
        F.lit(0).alias("category"),
    )
    none = F.lit(0)
    categorised = dated.select("upc", "grpnum", "convdate", none, none, none, F.lit(1))
    counts = [F.sum(c).cast("int").alias(c) for c in ("listed", "old", "new", "category")]
    copies = listed.union(categorised).groupBy("upc", "grpnum", "convdate").agg(*counts)

    any_date = Window.partitionBy("upc", "grpnum")
    all_new, all_listed = F.sum("new").over(any_date), F.sum("listed").over(any_date)
    own = F.col("upc").between(*params.own_codes)
    as_old = F.when(all_listed == 0, 1).otherwise(all_listed - all_new)
    tagged = copies.withColumns(
        {
            "brand_new": F.when(own, all_new).otherwise(0).cast("int"),
            "brand_old": F.when(own, as_old).otherwise(0).cast("int"),
        }
    ).filter("convdate is not null")
    items = tables.item.select(
        "trade_item_key",
        F.col("trade_item_cd").alias("upc"),
        F.coalesce(F.col("lgl_entity_nbr") == params.owner, F.lit(False)).alias("is_owned"),
    )
    return items.join(tagged, "upc")


def _items_of(pull: str, items: DataFrame) -> DataFrame:
    keys = ["trade_item_key", "upc", "grpnum", "convdate", "category"]
    if pull == "loyal":
        return items.select(*keys, "listed", "old", "new")
    own = items.filter("is_owned and category > 0")
    return own.select(*keys, F.col("brand_new").alias("new"), F.col("brand_old").alias("old"))


def _stores_of(pull: str, stores: DataFrame) -> DataFrame:
    if pull == "loyal":
        return stores.filter("is_loyal").select("ord_touchpoint_key")
    return stores.drop("is_loyal")


def _spans_of(pull: str, items: DataFrame) -> DataFrame:
    """The days on which an item counts for any group, one row an item.

    A group's window runs from a year before its launch to the stop date. All windows end together, so their union is
    one interval and its first day says all.
    """
    first = F.min(F.date_sub("convdate", _year(pull))).alias("first_day")
    return items.groupBy("trade_item_key").agg(first)


def _year(pull: str) -> int:
    return YEAR_DAYS if pull == "loyal" else INFERRED_YEAR_DAYS


@dataclass(frozen=True)
class Star:
    """The order lines of the report's days, and the lookups to join to them.

    ``keep`` writes a table of the run, once, and returns the written one.
    """

    tables: Tables
    params: ReportParams
    days: Lookup
    day_keys: Column
    items: dict[str, Lookup]
    spans: dict[str, Lookup]
    stores: dict[str, Lookup]
    keep: Callable[[DataFrame, str], DataFrame]
    customers: Lookup | None = None
    header_rows: int = 0

    def only(self, days: list[date], groups: list[int] | None, tag: str) -> Star:
        """The star of some days, and of some groups if any are named; ``tag`` marks what it writes.

        The days' keys go into the plan one by one, as keys need not follow the days. The driver receives these keys.
        """
        chosen = self.days.frame.filter(F.col("cal_dt").isin(days))
        key_type = chosen.schema["ord_date_key"].dataType
        keys = [r[0] for r in chosen.select(F.col("ord_date_key").cast("string")).collect()]
        literals = [F.lit(key).cast(key_type) for key in keys]
        day_keys = F.col("ord_date_key").isin(literals) if keys else F.lit(False)

        def of_groups(frame: DataFrame) -> DataFrame:
            return frame if groups is None else frame.filter(F.col("grpnum").isin(groups))

        items = {pull: replace(own, frame=of_groups(own.frame)) for pull, own in self.items.items()}
        return replace(
            self,
            days=replace(self.days, frame=chosen),
            day_keys=self.day_keys & day_keys,
            items=items,
            spans={pull: replace(own, frame=_spans_of(pull, items[pull].frame)) for pull, own in self.spans.items()},
            keep=lambda df, name: self.keep(df, f"{name}_{tag}"),
        )

    def matched(self, pull: str) -> DataFrame:
        """The lines that count for some group, each once: of its item's days and of the pull's stores."""
        salts = self.params.salts
        rows = attach(self._fact(pull), self.days, ["ord_date_key"], salts)
        rows = attach(rows, self.stores[pull], ["ord_touchpoint_key"], salts)
        rows = attach(rows, self.spans[pull], ["trade_item_key"], salts)
        return rows.filter(F.col("cal_dt") >= F.col("first_day")).drop("ord_date_key", "ord_touchpoint_key")

    def lines(self, pull: str, per_order: bool = False) -> DataFrame:
        """Order lines of one pull joined to its items, stores and days.

        Lines come to the groups last: each is joined to stores, days and orders once, however many groups it
        counts for. Without ``per_order`` lines may come summed by item, store flags and day. That happens where
        the items exceed the broadcast bound: it leaves a hot item no more rows than there are days and
        flags, so the shuffled join that follows has no hot key.
        """
        salts, items = self.params.salts, self.items[pull]
        rows = self.matched(pull)
        if pull == "loyal" and self.tables.order_loyalty is not None:
            rows = self._of_loyal_orders(rows)
        rows = rows.drop("first_day")
        if items.fits or per_order:
            rows = attach(rows, items, ["trade_item_key"], salts)
        else:
            facts = [F.sum(c).alias(c) for c in LINE_FACTS]
            dropped = {"ord_event_key", *LINE_FACTS}
            rows = rows.groupBy(*[c for c in rows.columns if c not in dropped]).agg(*facts)
            rows = rows.join(items.frame, "trade_item_key")
        return rows.filter(F.col("cal_dt") >= F.date_sub("convdate", _year(pull)))

    def _of_loyal_orders(self, rows: DataFrame) -> DataFrame:
        """The matched lines whose order is a loyalty order, which it is if any of its header rows is.

        Lines and header may both be huge, so neither is repeated or broadcast: a hot order is split at run
        time by the adaptive skew join. A semi join, so that a header with repeated orders repeats no line. Where both
        are stored in buckets of the order, it needs no shuffle. Else a header of more than ``filter_rows`` rows is
        first cut to the orders of the matched lines, which are written for that: what it shuffles grows with
        the matched orders and not with all orders. So it is where customers exceed the broadcast bound: the header's
        rows are then shuffled to the customers, once, and only the loyal orders' keys move on to the lines.
        """
        if self.tables.bucketed_by_order and (self.customers is None or self.customers.fits):
            orders = self._of_loyal_customers(self._header()).select("ord_event_key").distinct()
            return rows.join(orders, "ord_event_key")  # no semi join: that would be moved below the lookups
        if self.header_rows > self.params.filter_rows or (self.customers and not self.customers.fits):
            return self.loyal_lines.join(self.loyal_orders, "ord_event_key", "left_semi")
        # the key is made to depend on the item's days, which every line has by now, because a plain semi join would be
        # moved below the lookup joins and shuffle the lines that they are about to drop
        key = F.when(F.col("cal_dt") >= F.col("first_day"), F.col("ord_event_key"))
        loyal = self._of_loyal_customers(self._header()).select(F.col("ord_event_key").alias("order_key"))
        return rows.join(loyal, key == F.col("order_key"), "left_semi")

    @cached_property
    def loyal_lines(self) -> DataFrame:
        """The loyal pull's matched lines, of all orders, written."""
        return self.keep(self.matched("loyal"), "loyal_lines")

    @cached_property
    def loyal_orders(self) -> DataFrame:
        """The keys of loyalty orders, written; orders without a matched line are mostly left out."""
        orders = self._of_loyal_customers(self.cut_header())
        return self.keep(orders.select("ord_event_key"), "loyal_orders")

    def cut_header(self) -> DataFrame:
        """The header's rows of the report's days that may belong to a matched line.

        The filter takes two bytes an order, ``params.filter_bytes`` at most; where that is too small for so many
        orders, the header stays as it is.
        """
        orders = self.loyal_lines.agg(F.approx_count_distinct("ord_event_key", 0.02)).first()[0]
        words = n_words(int(orders * 1.1) + 1, self.params.filter_bytes)
        if words is None:
            return self._header()
        known = key_filter(self.loyal_lines.select("ord_event_key"), "ord_event_key", words)
        return may_hold(self._header(), "ord_event_key", known, words)

    def _header(self) -> DataFrame:
        header = self.tables.order_loyalty
        return header.filter(self.day_keys) if "ord_date_key" in header.columns else header

    def _of_loyal_customers(self, header: DataFrame) -> DataFrame:
        if self.customers is None:
            return self._loyal(header)
        return attach(header, self.customers, ["cnsmr_key"], self.params.salts, "left_semi")

    def _loyal(self, df: DataFrame) -> DataFrame:
        return df.filter(F.col("cnsmr_id_typ_loy_cd") == self.params.loyalty_code)

    def _fact(self, pull: str) -> DataFrame:
        columns = ["ord_event_key", "ord_touchpoint_key", "trade_item_key", "ord_date_key"]
        if pull == "loyal":
            fact = self.tables.loyal_fact
            if self.tables.order_loyalty is None:
                fact = self._loyal(fact)
        else:
            fact = self.tables.fact.filter(F.col("purch_qty") > 0)
        return fact.filter(self.day_keys).select(*columns, *LINE_FACTS)


def plan_star(
    tables: Tables, items: DataFrame, params: ReportParams, keep: Callable[[DataFrame, str], DataFrame]
) -> Star:
    """Size each pull's lookups and find the report's days, in one job that returns a row for each.

    Only where some lookup is too large to be broadcast, a second job reads its keys in the lines, for the hot ones.

    ``items`` should be a written table: it is read here and again by each pull. The first day and the
    range of date keys go back into the plan as literals, so that they reach the scan of the order
    lines. Keys travel as text: the literal then has the key's own type, whatever that is.
    """
    stores = classify_stores(tables, params)
    earliest = items.agg(F.date_sub(F.min("convdate"), INFERRED_YEAR_DAYS).alias("day"))
    day, key, stop = F.col("cal_dt"), F.col("date_key"), F.lit(params.stop_date)
    span = {
        "first": F.min(day),
        "low": F.min(key).cast("string"),
        "high": F.max(key).cast("string"),
    }
    in_period = tables.calendar.filter(day.between(earliest.scalar(), stop))
    per_pull = {f"items_{pull}": (_items_of(pull, items), {}) for pull in PULLS}
    per_pull |= {f"stores_{pull}": (_stores_of(pull, stores), {}) for pull in PULLS}
    if tables.customer_loyalty is not None:
        coded = F.col("cnsmr_id_typ_loy_cd") == params.loyalty_code
        per_pull["customers"] = (tables.customer_loyalty.filter(coded).select("cnsmr_key").distinct(), {})
    if tables.order_loyalty is not None:
        per_pull["header"] = (tables.order_loyalty, {})
    sizes = measure(days=(in_period, span), **per_pull)

    days = tables.calendar.filter(day.between(F.lit(sizes["days"]["first"]).cast("date"), stop))
    days = days.select(
        key.alias("ord_date_key"), day, F.col("cal_sat_wk_ending_dt").alias("week_end")
    )
    key_type = days.schema["ord_date_key"].dataType
    low, high = (F.lit(sizes["days"][end]).cast(key_type) for end in ("low", "high"))

    def lookup(name: str, frame: DataFrame) -> Lookup:
        rows = sizes[name]["n"]
        return Lookup(frame, rows, rows <= params.broadcast_rows)

    star = Star(
        tables=tables,
        params=params,
        days=lookup("days", days),
        day_keys=F.col("ord_date_key").between(low, high),
        items={pull: lookup(f"items_{pull}", _items_of(pull, items)) for pull in PULLS},
        spans={pull: lookup(f"items_{pull}", _spans_of(pull, _items_of(pull, items))) for pull in PULLS},
        stores={pull: lookup(f"stores_{pull}", _stores_of(pull, stores)) for pull in PULLS},
        keep=keep,
        customers=lookup("customers", per_pull["customers"][0]) if "customers" in per_pull else None,
        header_rows=sizes["header"]["n"] if "header" in sizes else 0,
    )
    return _with_hot_keys(star)


def _with_hot_keys(star: Star) -> Star:
    """The star with the hot keys of lookups that can't be broadcast, as the lines, or the header, have them."""
    wanted, own = {}, {pull: star._fact(pull) for pull in PULLS}
    for pull in PULLS:
        if not star.items[pull].fits:
            wanted[f"items_{pull}"] = (own[pull], "trade_item_key")
        if not star.stores[pull].fits:
            wanted[f"stores_{pull}"] = (own[pull], "ord_touchpoint_key")
    if not star.days.fits:
        wanted["days"] = (own["inferred"], "ord_date_key")
    if star.customers and not star.customers.fits:
        wanted["customers"] = (star._header(), "cnsmr_key")
    if not wanted:
        return star
    hot = hot_keys(star.params.salts, **wanted)

    def known(name: str, lookup: Lookup) -> Lookup:
        return replace(lookup, hot=hot.get(name))

    return replace(
        star,
        days=known("days", star.days),
        customers=star.customers and known("customers", star.customers),
        **{
            field: {pull: known(f"{name}_{pull}", getattr(star, field)[pull]) for pull in PULLS}
            for field, name in (("items", "items"), ("spans", "items"), ("stores", "stores"))
        },
    )


def in_year_ago(params: ReportParams) -> Column:
    """Loyal lines sold in the year-ago window; the line filter has already cut its start."""
    return F.col("cal_dt") <= F.lit(params.stop_yago)


def in_this_year() -> Column:
    """Loyal lines sold since 26 weeks before launch; the day range has already cut the end."""
    return F.col("cal_dt") >= F.date_sub("convdate", PRE_LAUNCH_DAYS)
