"""Means that do not depend on the order of addition or on binary rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(total: Column, n: Column, digits: int = 4, scale: int = 2) -> Column:
    """An exact total divided by a count in decimal arithmetic, rounded half up, as a double.

    The widths keep at least 14 decimals of the quotient; totals may have 23 digits before the point.
    """
    exact = total.cast(f"decimal({23 + scale},{scale})") / n.cast("decimal(15,0)")
    return F.round(exact, digits).cast("double")


def mean(column: str | Column, digits: int = 4) -> Column:
    """Mean of an exact column with two decimals."""
    c = F.col(column) if isinstance(column, str) else column
    return ratio(F.sum(c), F.count(c), digits)


def mean_of_doubles(column: str | Column, digits: int = 4) -> Column:
    """Mean of doubles, each taken to 9 decimals so that their sum is exact."""
    c = F.col(column) if isinstance(column, str) else column
    return ratio(F.sum(c.cast("decimal(28,9)")), F.count(c), digits, scale=9)
