"""Number columns: code clean-up, shares, means and report text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_code(text: Column, kind: str = "bigint") -> Column:
    """Whole number read from text, digit by digit; NULL where the text is no whole number of that kind.

    ``12.0`` is 12; ``12.7``, ``12d``, hex and what does not fit are NULL, never cut or rounded.
    """
    number = text.try_cast("decimal(38,18)")
    return F.when(number == F.floor(number), number).try_cast(kind)


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` as double. A missing sum counts as 0; NULL where the whole is 0."""
    zero = F.lit(0)
    return F.try_divide(
        F.coalesce(part, zero).cast("double"), F.coalesce(whole, zero).cast("double")
    )


def weekly_mean(value: Column, in_slice: Column) -> Column:
    """Mean of the known values in a slice, NULL where there are none.

    The sum stays an exact decimal and is divided once: averaging a decimal would round it.
    """
    chosen = F.when(in_slice, value)
    return F.try_divide(F.sum(chosen).cast("double"), F.count(chosen))


def money_text(value: Column) -> Column:
    """Whole dollars with thousands separators, ties to even: ``$1,234``."""
    return F.concat(F.lit("$"), F.format_number(F.bround(value, 0).cast("bigint"), 0))


def percent_text(value: Column) -> Column:
    """Percentage with one digit and no separators: ``12.2%``."""
    number = F.format_number(value * F.lit(100.0), 1)
    return F.concat(F.replace(number, F.lit(","), F.lit("")), F.lit("%"))
