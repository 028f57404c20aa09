"""Exact order statistics per key from a distributed value histogram.

``percentile`` keeps every distinct value of a group in one task's memory. Here equal values are
counted first (with map-side combining). Keys with very many values are cut into cells of about equally many
values, wherever the values lie.

``picked`` narrows down: the rows per cell say which cell holds a wanted position, and only those
cells are sorted. ``cumulative_counts`` accumulates over all values, for callers that need them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .segments import _CELL, HOT_ROWS, cut, running_total


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def cumulative_counts(df: DataFrame, keys: list[str], value: str, width: float | None = None,
                      hot_rows: int = HOT_ROWS) -> DataFrame:
    """keys, value, n, cum (rows at or below the value), total.

    ``width`` is a cell size for callers that know one; else the data says where to cut."""
    cell = None if width is None else F.floor(F.col(value) / F.lit(width))
    return running_total(value_counts(df, keys, value), keys, [value], cell, F.col("n"), "cum",
                         "total", hot_rows)


@dataclass(frozen=True)
class Pick:
    """Zero-based sorted positions for a number of rows, and what to make of the values there."""

    low: Callable[[Column], Column]
    high: Callable[[Column], Column] | None = None
    blend: Callable[[Column, Column, Column], Column] | None = None


def interpolated(p: float) -> Pick:
    """Percentile at position (n-1)*p, between its two neighbours."""
    def pos(n):
        return (n - 1) * F.lit(float(p))

    return Pick(lambda n: F.floor(pos(n)), lambda n: F.ceil(pos(n)),
                lambda a, b, n: a + (b - a) * (pos(n) - F.floor(pos(n))))


def ranked(p: float, clamp: bool = False) -> Pick:
    """``sorted[int(n*p)]``, clamped to the last row; a single row is its own percentile."""
    def pos(n):
        at = F.floor(n * F.lit(float(p)))
        return F.when(n > 1, F.least(at, n - 1) if clamp else at).otherwise(F.lit(0))

    return Pick(pos)


#: mean of the two middle values
MEDIAN = Pick(lambda n: F.floor((n - 1) / 2), lambda n: F.floor(n / 2), lambda a, b, n: (a + b) / 2)


def picked(df: DataFrame, keys: list[str], value: str, wanted: Mapping[str, Pick],
           hot_rows: int = HOT_ROWS) -> DataFrame:
    """keys, total (rows with a value) and a column per wanted statistic.

    Values are counted, counts are added up per cell, and of all cells only those that hold a wanted
    position go on to be sorted: the histogram narrows the search to them.
    """
    counts = cut(value_counts(df, keys, value), keys, [value], hot_rows)
    sums = counts.groupBy(*keys, _CELL).agg(F.sum("n").alias("_in"))
    of_key = Window.partitionBy(*keys)
    below = of_key.orderBy(_CELL).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, _CELL, "_in", F.coalesce(F.sum("_in").over(below), F.lit(0)).alias("_below"),
                       F.sum("_in").over(of_key).alias("_total"))
    n = F.col("_total")
    places = {f"{name}:{end}": place(n) for name, pick in wanted.items()
              for end, place in (("low", pick.low), ("high", pick.high)) if place is not None}
    inside = F.filter(F.array(*[
        F.struct(F.lit(name).alias("name"), pos.cast("long").alias("pos"))
        for name, pos in places.items()]),
        lambda x: (x["pos"] >= F.col("_below")) & (x["pos"] < F.col("_below") + F.col("_in")))
    held = sums.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col(_CELL).alias("_of_cell"),
                       "_below", "_total", inside.alias("_places")).filter(F.size("_places") > 0)
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in [*keys]]
    rows = counts.join(held, [*same, F.col(_CELL).eqNullSafe(F.col("_of_cell"))])
    upto = Window.partitionBy(*keys, _CELL).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_upto", F.col("_below") + F.sum("n").over(upto))
    found = rows.select(*keys, F.col(value).alias("_value"), "_total", F.explode(F.filter(
        "_places", lambda x: (x["pos"] >= F.col("_upto") - F.col("n")) & (x["pos"] < F.col("_upto"))))
        .alias("_place"))

    def at(name, end):
        return F.max(F.when(F.col("_place.name") == f"{name}:{end}", F.col("_value")))

    total = F.max("_total")
    return found.groupBy(*keys).agg(total.alias("total"), *[
        (at(name, "low") if pick.blend is None else
         pick.blend(at(name, "low"), at(name, "high"), total)).alias(name)
        for name, pick in wanted.items()])


def at_position(value: str, pos: Column) -> Column:
    """Aggregate over ``cumulative_counts``: the value at the zero-based sorted position."""
    return F.min(F.when(F.col("cum") > pos, F.col(value)))


def linear(value: str, p: float) -> Column:
    """Interpolated percentile at position (n-1)*p, as an aggregate."""
    pos = (F.col("total") - 1) * F.lit(float(p))
    low = at_position(value, F.floor(pos))
    high = at_position(value, F.ceil(pos))
    frac = F.max(pos - F.floor(pos))
    return low + (high - low) * frac


def rank_pick(value: str, p: float, clamp: bool = False) -> Column:
    """``sorted[int(n*p)]``, clamped to the last row; a single row is its own percentile."""
    pos = F.floor(F.col("total") * F.lit(float(p)))
    if clamp:
        pos = F.least(pos, F.col("total") - 1)
    return at_position(value, F.when(F.col("total") > 1, pos).otherwise(F.lit(0)))
