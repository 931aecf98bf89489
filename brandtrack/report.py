"""One report run: the conversion list in, every table of the report out."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame

from .operators import category, conversion, hierarchy, pulls
from .operators.sizing import Lookup
from .operators.star import Star, plan_star, report_items
from .params import ReportParams
from .plans import metrics, summary, trend
from .sources.clustered import write_clustered
from .sources.publish import is_published, publish, remove, shared_folder
from .sources.tables import Tables
from .sources.versions import VersionedTables
from .weekly_state import WeeklyState


class BrandReport:
    """Lazily built tables of one run.

    Sales pulls first write the cleaned list and the report's items (one row per item, group and launch
    date) under ``folder``, by default a new one below ``spark.checkpoint.dir``, and count the lookups. Each
    of the two pulls reads the order lines once, for its weekly table, which is written too: all weekly
    results come from these. ``close``, or the end of a ``with`` block, removes what the run has written.
    Where ``params.brand_flag`` is set, only the groups of that brand are pulled and reported. With a ``state``, the
    weekly tables come from it: the lines are then read for the days, and groups, that it lacks and for the
    ``corrected`` days.
    """

    #: Names of the tables a run writes.
    WRITTEN = (
        "conversion_list", "items", "loyal_lines", "loyal_orders", "loyal_weeks", "inferred_weeks", "category_upcs",
        "hierarchy_nodes", "named_nodes", "granted_nodes",
    )

    def __init__(
        self,
        tables: Tables,
        raw_list: DataFrame,
        params: ReportParams,
        folder: str | None = None,
        state: WeeklyState | None = None,
        corrected: Sequence[date] = (),
    ) -> None:
        self.tables, self.params = tables, params
        self.raw_list = raw_list
        self.spark = raw_list.sparkSession
        self.state, self.corrected = state, corrected
        self.folder = folder or shared_folder(self.spark)
        taken = [t for t in self.WRITTEN if folder and is_published(self.spark, f"{folder}/{t}")]
        if taken:
            raise ValueError(f"{folder} holds tables of another run: {', '.join(taken)}")
        self._published: dict[str, DataFrame] = {}

    def __enter__(self) -> "BrandReport":
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Remove the tables that this run has written; its results can't be read afterwards."""
        for table in self._published:
            remove(self.spark, f"{self.folder}/{table}")
        self._published.clear()

    def publish(self, df: DataFrame, table: str) -> DataFrame:
        """Write a table of the run, once, and return the written one."""
        if table not in self._published:
            self._published[table] = publish(df, f"{self.folder}/{table}")
        return self._published[table]

    @cached_property
    def conv(self) -> DataFrame:
        """The cleaned list: all rows of the groups to report."""
        listed = conversion.clean_list(self.raw_list, self.params.min_group)
        if self.params.brand_flag is None:
            return listed
        groups = conversion.report_groups(listed, self.params.brand_flag)
        return listed.join(groups.select("grpnum"), "grpnum", "left_semi").select(*listed.columns)

    @cached_property
    def header(self) -> DataFrame:
        return conversion.group_header(self.conv, self.params)

    @cached_property
    def groups(self) -> DataFrame:
        """The groups with the division that orders them."""
        return conversion.report_groups(self.conv, self.params.brand_flag)

    @cached_property
    def lookups(self) -> dict[str, Lookup]:
        return category.list_lookups(self.conv, self.params)

    @cached_property
    def category(self) -> DataFrame:
        if self.tables.levels:
            return self._category_of_any_level()
        return category.category_upcs(self.conv, self.lookups["codes"], self.tables, self.params)

    def _category_of_any_level(self) -> DataFrame:
        tree = hierarchy.from_levels(self.tables.hierarchy, self.tables.levels, self.publish)
        depths = {depth: f"hierl{depth}cd" for depth in self.tables.levels}
        return hierarchy.category_of_any_level(self.conv, tree, depths, self.tables, self.params, self.publish)

    @cached_property
    def dated_category(self) -> DataFrame:
        return category.dated_category(self.category, self.lookups["dates"], self.params)

    def upload_list(self) -> "BrandReport":
        """Write the cleaned list and go on from the written one."""
        self.__dict__["conv"] = self.publish(self.conv, "conversion_list")
        return self

    def upload_category(self) -> DataFrame:
        """Write the dated category codes and return the written table."""
        return self.publish(self.dated_category, "category_upcs")

    def publish_weeks(self) -> "BrandReport":
        """Write both weekly tables now; otherwise each is written when a result first needs it."""
        self.loyal_weeks, self.inferred_weeks  # noqa: B018
        return self

    def upload_to(self, versions: VersionedTables) -> int:
        """Write the cleaned list and the dated category codes as one version of lasting tables, and return its number.

        The rows of both are counted as they are written; ``versions.rows`` has the counts.
        """
        return versions.write(conversion_list=self.conv, category_upcs=self.dated_category)

    @cached_property
    def star(self) -> Star:
        """The order lines ready to be pulled, with the list and the report's items written once."""
        self.upload_list()
        return plan_star(self.tables, self.publish_items(), self.params, self.publish)

    @cached_property
    def _state_weeks(self) -> tuple[DataFrame, DataFrame]:
        return self.state.refresh(self.star, self.publish_items(), self.corrected)

    def publish_items(self) -> DataFrame:
        """The report's items, written once."""
        return self.publish(report_items(self.conv, self.dated_category, self.tables, self.params), "items")

    def write_orders(self, folder: str) -> dict[str, DataFrame]:
        """The four order-level tables, written below ``folder`` to be read a group or a week at a time."""
        made = {
            "loyal_brand_orders": pulls.loyal_brand_orders,
            "loyal_category_orders": pulls.loyal_category_orders,
            "inferred_brand_orders": pulls.inferred_brand_orders,
            "inferred_category_orders": pulls.inferred_category_orders,
        }
        return {name: write_clustered(pull(self.star), f"{folder}/{name}") for name, pull in made.items()}

    @cached_property
    def loyal_weeks(self) -> DataFrame:
        """Sums by group and week of the banner with listed codes."""
        if self.state:
            return self._state_weeks[0]
        return self.publish(pulls.loyal_weekly(self.star), "loyal_weeks")

    @cached_property
    def inferred_weeks(self) -> DataFrame:
        """Sums by group and week of the banners with inferred codes."""
        if self.state:
            return self._state_weeks[1]
        return self.publish(pulls.inferred_weekly(self.star), "inferred_weeks")

    def loyal_banner_weekly(self) -> tuple[DataFrame, DataFrame]:
        """Category and brand sums by group and week for the banner with listed codes."""
        return pulls.loyal_category_rows(self.loyal_weeks), pulls.loyal_brand_rows(self.loyal_weeks)

    def inferred_brand_weekly(self) -> tuple[DataFrame, DataFrame]:
        """Category and brand sums by group and week for the banners with inferred codes."""
        weeks = self.inferred_weeks
        return pulls.inferred_category_rows(weeks), pulls.inferred_brand_rows(weeks)

    @cached_property
    def weeks(self) -> DataFrame:
        """One row per group, banner and week. Everything below is computed from it."""
        return metrics.banner_weeks(self.loyal_weeks, self.inferred_weeks)

    @cached_property
    def parts(self) -> DataFrame:
        return metrics.metric_parts(self.weeks, self.header, self.params)

    @cached_property
    def rated(self) -> DataFrame:
        return metrics.rated(self.parts)

    def banner_metrics(self) -> DataFrame:
        return metrics.banner_metrics(self.rated)

    def latest_week_share(self) -> DataFrame:
        return metrics.latest_week_share(self.parts)

    def loyal_new_old_share(self) -> DataFrame:
        return metrics.loyal_new_old_share(self.rated)

    def total_metrics(self) -> DataFrame:
        return metrics.total_metrics(self.rated)

    def key_metrics(self) -> DataFrame:
        return metrics.key_metrics(self.rated)

    def key_metrics_table(self) -> DataFrame:
        return summary.key_metrics_table(self.key_metrics(), self.groups)

    def headed_table(self) -> DataFrame:
        """The formatted key metrics under the headings a reader sees."""
        return summary.with_headings(self.key_metrics_table())

    def weekly_trend(self) -> DataFrame:
        return trend.weekly_trend(self.weeks, self.header)

    def summary(self) -> DataFrame:
        return summary.summary(self.total_metrics(), self.header, self.groups)
