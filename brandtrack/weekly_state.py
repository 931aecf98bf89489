"""Weekly sums that are carried on from week to week instead of pulled again.

Sums of a day don't change when the stop date moves, only the windows they fall into do. So the state keeps running sums
by group, launch date, day and copies, for both pulls, with a ledger: which days have been read, what each group's
items were, and under which rules. A run reads the days that are missing or named as corrected for all groups, and all
other days only for groups whose items changed. Its size follows groups and days, not lines.

An order keeps the loyalty it had when its day was read. Name a day as corrected to have it read again, whatever changed
in its lines or orders; a change of stores or of the report's rules reads all days again by itself.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .operators import pulls
from .operators.star import PULLS, Star
from .sources.versions import VersionedTables

DAYS_OF = {"loyal": pulls.loyal_days, "inferred": pulls.inferred_days}


def _fingerprint(rows: DataFrame) -> Column:
    """What a group of rows amounts to, whatever their order, repeated rows included."""
    row = F.xxhash64(*rows.columns)
    return F.concat_ws(":", F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.bit_xor(row))


@dataclass(frozen=True)
class Work:
    """What a run has to read: days for all groups, and groups for all other days."""

    days: list[date]
    groups: list[int]
    other_days: list[date]
    keeps: bool

    @property
    def is_done(self) -> bool:
        return not self.days and not (self.groups and self.other_days)


class WeeklyState:
    """Running sums and their ledger in a folder of versioned tables."""

    def __init__(self, versions: VersionedTables):
        self.versions = versions
        #: What the last ``refresh`` has read.
        self.work: Work | None = None

    def _rules(self, star: Star) -> str:
        """The rules and the stores that sums depend on."""
        p = star.params
        stores = [str(star.stores[pull].frame.agg(_fingerprint(star.stores[pull].frame)).first()[0]) for pull in PULLS]
        holder = (star.tables.order_loyalty is not None, star.tables.customer_loyalty is not None)
        return repr((p.loyal_network, p.inferred_network, p.owner, p.own_codes, p.loyalty_code, holder, stores))

    def plan(self, star: Star, signatures: DataFrame, corrected: Iterable[date]) -> Work:
        """What the state lacks. The driver receives days, and numbers of groups that changed."""
        needed = [r[0] for r in star.days.frame.select("cal_dt").distinct().orderBy("cal_dt").collect()]
        if self.versions.latest() is None or self.versions.read("rules").first()[0] != self._rules(star):
            return Work(needed, [], [], False)
        done = {r[0] for r in self.versions.read("days").collect()}
        days = [day for day in needed if day not in done or day in set(corrected)]
        same = signatures.join(self.versions.read("groups"), ["grpnum", "signature"], "left_anti")
        changed = sorted(r[0] for r in same.select("grpnum").collect())
        chosen = set(days)
        return Work(days, changed, [day for day in needed if day not in chosen], True)

    def refresh(self, star: Star, items: DataFrame, corrected: Iterable[date] = ()) -> tuple[DataFrame, DataFrame]:
        """Bring the state up to the star's days and items; the weekly tables of both pulls at its stop date."""
        groups = items.groupBy("grpnum").agg(_fingerprint(items).alias("signature"))
        work = self.work = self.plan(star, groups, corrected)
        if not work.keeps or not work.is_done or self._groups_left(groups):
            tables = {f"{pull}_days": self._days(pull, star, groups, work) for pull in PULLS}
            read = star.days.frame.select("cal_dt").distinct()
            if work.keeps and not work.groups:  # changed groups are only read up to this stop date
                read = read.union(self.versions.read("days")).distinct()
            rules = star.tables.item.sparkSession.createDataFrame([(self._rules(star),)], "rules string")
            self.versions.write(**tables, days=read, groups=groups, rules=rules)
        version = self.versions.latest()
        return (
            pulls.loyal_weeks_of_days(self.versions.read("loyal_days", version), star.params),
            pulls.inferred_weeks_of_days(self.versions.read("inferred_days", version), star.params),
        )

    def _groups_left(self, groups: DataFrame) -> bool:
        """Does the state hold groups that the list no longer has?"""
        return not self.versions.read("groups").join(groups, "grpnum", "left_anti").isEmpty()

    def _days(self, pull: str, star: Star, groups: DataFrame, work: Work) -> DataFrame:
        """The sums of all days: those kept and those read now."""
        build = DAYS_OF[pull]
        if not work.keeps:
            return build(star)
        kept = self.versions.read(f"{pull}_days")
        kept = kept.join(groups.select("grpnum"), "grpnum", "left_semi").select(kept.columns)
        kept = kept.filter(~F.col("cal_dt").isin(work.days)) if work.days else kept
        if work.groups:
            past = F.col("cal_dt") <= F.lit(star.params.stop_date)
            kept = kept.filter(past & ~F.col("grpnum").isin(work.groups))
        parts = [kept]
        if work.days:
            parts.append(build(star.only(work.days, None, "days")))
        if work.groups and work.other_days:
            parts.append(build(star.only(work.other_days, work.groups, "groups")))
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole
