"""Rolling spending profile per user and range-based anomaly labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.means import ratio
from .aggregates import trunc


def daily_spending(df: DataFrame, measure: str, rows: int = 7, ts: str = "ts") -> DataFrame:
    """Daily sum with average and range over the last ``rows`` days that have data.

    The window runs over day totals: a user has at most one row per day there.
    """
    daily = df.groupBy("user_id", trunc(ts, "day").alias("day")).agg(
        F.sum(measure).alias("daily_spending"))
    w = Window.partitionBy("user_id").orderBy("day").rowsBetween(1 - rows, 0)
    s = F.col("daily_spending")
    return daily.withColumns({
        "avg_7day_spending": ratio(F.sum(s).over(w), F.count(s).over(w)),
        "spending_range_7day": F.max(s).over(w) - F.min(s).over(w)})


def flag_spending(profile: DataFrame, factor: float = 0.5) -> DataFrame:
    s = F.col("daily_spending").cast("double")
    avg = F.col("avg_7day_spending")
    reach = F.col("spending_range_7day").cast("double") * factor
    label = (F.when(s > avg + reach, "HIGH_ANOMALY")
             .when(s < F.greatest(F.lit(0.0), avg - reach), "LOW_ANOMALY").otherwise("NORMAL"))
    return profile.select("user_id", "day", "daily_spending", "avg_7day_spending",
                          label.alias("anomaly_type"))
