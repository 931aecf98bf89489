"""Date columns: the week bucket and the weekly spine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_ending(day: Column) -> Column:
    """The Saturday that ends the week of ``day``; a Saturday is its own week end."""
    return F.next_day(F.date_sub(day, 1), "SAT")


def saturdays(start: Column, stop: Column) -> Column:
    """Array of the Saturdays in ``[start, stop]``, empty where there are none."""
    first = week_ending(start)
    weeks = F.sequence(first, stop, F.expr("interval 7 days"))
    return F.when(first <= stop, weeks).otherwise(F.array().cast("array<date>"))
