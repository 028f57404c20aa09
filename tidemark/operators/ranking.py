"""Ranks, top-n per group and numbered histories that survive a group holding much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import value_counts
from ..functions.segments import _CELL, HOT_ROWS, cut, running_total


def rank_in_group(df: DataFrame, group: str, value: str, width: float | None = None,
                  out: str = "rank_in_category", hot_rows: int = HOT_ROWS) -> DataFrame:
    """RANK() by value descending inside a group; a row without a value has no rank.

    Rows are counted per group and value first, so equal values are one row whatever their number.
    Groups with very many values are cut into bands of about equally many values (or of ``width``): a
    band starts from the counts of the bands above it and a window runs over the values inside it. The
    rows look their rank up by one join.
    """
    counts = value_counts(df, [group], value).withColumnRenamed("n", "_n")
    if width is None:
        counts = cut(counts, [group], [value], hot_rows).withColumnRenamed(_CELL, "_band")
    else:
        counts = counts.withColumn("_band", F.floor(F.col(value) / F.lit(width)))
    above = Window.partitionBy(group).orderBy(F.desc("_band")).rowsBetween(
        Window.unboundedPreceding, -1)
    cut_ones = counts.filter(F.col("_band").isNotNull())
    bands = cut_ones.groupBy(group, "_band").agg(F.sum("_n").alias("_n")).select(
        F.col(group).alias("_in"), F.col("_band").alias("_at"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above"))
    before = Window.partitionBy(group, "_band").orderBy(F.desc(value)).rowsBetween(
        Window.unboundedPreceding, -1)
    ranks = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(
        bands, F.col(group).eqNullSafe(F.col("_in")) & (F.col("_band") == F.col("_at")),
        "left").select(
        F.col(group).alias("_of"), F.col(value).alias("_value"),
        (F.coalesce("_above", F.lit(0)) + F.col("_before") + 1).alias(out))
    return df.join(ranks, F.col(group).eqNullSafe(F.col("_of")) & (
        F.col(value) == F.col("_value")), "left").select(*df.columns, out)


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                    n: int) -> DataFrame:
    """The first n rows of every group; each input partition keeps at most n before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def key_history(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                cell: Column | None = None, repeated_only: bool = True) -> DataFrame:
    """Stored versions in arrival order with a version number; by default of keys with several."""
    numbered = running_total(df, list(keys), list(order), cell, F.lit(1).cast("long"),
                             "version", "versions")
    return numbered.filter(F.col("versions") > 1) if repeated_only else numbered
