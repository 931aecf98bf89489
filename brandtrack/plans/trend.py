"""Weekly series without gaps, from 26 weeks before launch to the stop date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import saturdays
from .metrics import BANNERS, with_banners


def week_spine(header: DataFrame) -> DataFrame:
    """Each group's Saturdays; none for a group whose period has not begun at the stop date."""
    weeks = saturdays(F.col("start_date"), F.col("stop_date"))
    return header.select("grpnum", F.explode(weeks).alias("week_end"))


def weekly_trend(weeks: DataFrame, header: DataFrame) -> DataFrame:
    """New, old and category sales per group, banner and week, in this order; 0 in a week without sales."""
    keys = ["grpnum", "banner", "week_end"]
    values = ("new_sales", "old_sales", "cat_sales")
    filled = [F.coalesce(v, F.lit(0).cast("decimal(38,2)")).alias(v) for v in values]
    spine = with_banners(week_spine(header))
    place = F.array_position(F.array(*[F.lit(b) for b in BANNERS]), F.col("banner"))
    rows = spine.join(weeks.select(*keys, *values), keys, "left").select(*keys, *filled)
    return rows.orderBy("grpnum", place, "week_end")
