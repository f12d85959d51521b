"""Column expressions for date keys, rounding and report labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.constants import CURRENCY_PREFIX, MINIMUM_BAR, MONEY


def date_key(day: Column) -> Column:
    """``yyyymmdd`` as an integer, by arithmetic so that no text is formatted per row."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def whole_units(amount: Column) -> Column:
    """Round half up to whole currency units."""
    return F.round(amount, 0).cast("bigint")


def ticket(total: Column, lines: Column) -> Column:
    """Mean amount per line from an exact sum, so that the digits do not depend on row order."""
    return F.round(total / F.nullif(lines, F.lit(0)), 2).cast(MONEY)


def bar_share(value: Column, largest: Column) -> Column:
    """Width of a bar in percent of the largest, rounded half to even, never below the minimum."""
    scale = F.coalesce(F.nullif(largest, F.lit(0)), F.lit(1))
    percent = F.bround((F.lit(100) * value).cast("double") / scale, 0).cast("bigint")
    return F.greatest(F.lit(MINIMUM_BAR).cast("bigint"), percent)


def grouped_digits(value: Column, decimals: int = 0) -> Column:
    return F.format_number(value, decimals)


def money_label(value: Column, decimals: int = 0) -> Column:
    return F.concat(F.lit(CURRENCY_PREFIX), grouped_digits(value, decimals))
