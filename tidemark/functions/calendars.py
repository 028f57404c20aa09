"""Persian (Jalali) calendar as integer column arithmetic over a 33-year cycle of 12,053 days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("int")


def jalali_parts(date: str | Column) -> tuple[Column, Column, Column]:
    """Year, month and day of the Persian date of a Gregorian date column."""
    n = F.unix_date(F.col(date) if isinstance(date, str) else date) + 1075195
    in_cycle = n % 12053
    y0 = F.lit(-1595) + _div(n, 12053) * 33 + _div(in_cycle, 1461) * 4
    r = in_cycle % 1461
    late = r > 365
    year = F.when(late, y0 + _div(r - 1, 365)).otherwise(y0)
    x = F.when(late, (r - 1) % 365).otherwise(r)
    first_half = x < 186
    month = F.when(first_half, _div(x, 31) + 1).otherwise(_div(x - 186, 30) + 7)
    day = F.when(first_half, x % 31 + 1).otherwise((x - 186) % 30 + 1)
    return year.cast("int"), month.cast("int"), day.cast("int")


def jalali_date(date: str | Column) -> Column:
    y, m, d = jalali_parts(date)
    return F.format_string("%04d-%02d-%02d", y, m, d)


def jalali_year(date: str | Column) -> Column:
    return jalali_parts(date)[0]


def day_of_week(ts: str | Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(ts) - 1
