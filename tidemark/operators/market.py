"""Daily market sheets: Persian dates, symbol filter, backfill ranges and their summary."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendars import jalali_date, jalali_year
from ..functions.text import is_symbol

SYMBOL = "نماد"


def market_days(sheets: DataFrame, symbol: str = SYMBOL, day: str | Column = "en_date",
                limit: int = 20) -> DataFrame:
    """All sheets at once: real symbols only, each row with its date in both calendars.

    A day without rows gives no output, as there is nothing to date.
    """
    d = (F.col(day) if isinstance(day, str) else day).cast("date")
    return (sheets.filter(is_symbol(symbol, limit))
            .withColumns({"fa_date": jalali_date(d), "fa_year": jalali_year(d),
                          "en_date": F.date_format(d, "yyyy-MM-dd")}))


def backfill_bounds(start: str | None = None, end: str | None = None,
                    today: date | None = None, days: int = 30) -> tuple[str, str]:
    """Bounds in order; the last ``days`` days where none are given."""
    today = today or date.today()
    hi = date.fromisoformat(end) if end else today
    lo = date.fromisoformat(start) if start else today - timedelta(days=days)
    lo, hi = min(lo, hi), max(lo, hi)
    return lo.isoformat(), hi.isoformat()


def backfill_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day, both ends included."""
    lo, hi = sorted((start, end))
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(lo).cast("date"), F.lit(hi).cast("date"))).alias("day"))


def day_counts(rows: DataFrame, day: str = "en_date") -> DataFrame:
    return rows.groupBy(F.col(day).cast("date").alias("day")).agg(
        F.count("*").alias("row_count"))


def backfill_days(spine: DataFrame, counts: DataFrame) -> DataFrame:
    """Every day of the range with its row count, 0 where nothing was found."""
    return (spine.join(counts, "day", "left")
            .select("day", F.coalesce("row_count", F.lit(0)).alias("row_count")))


def backfill_summary(days: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """Dates processed, trading and empty days and failures of a backfill."""
    stats = days.agg(
        F.count("*").alias("dates_processed"),
        F.count_if(F.col("row_count") > 0).alias("trading_days"),
        F.count_if(F.col("row_count") == 0).alias("empty_days"),
        F.min("day").alias("start_date"), F.max("day").alias("end_date"))
    if failures is None:
        stats = stats.withColumn("failures", F.lit(0).cast("long"))
    else:
        # both sides are one row
        stats = stats.withColumn("_one", F.lit(1)).join(
            failures.agg(F.count("*").alias("failures")).withColumn("_one", F.lit(1)),
            "_one").drop("_one").withColumn(
                "empty_days", F.col("empty_days") - F.col("failures"))
    return stats.withColumn("status", F.when(F.col("failures") == 0, "completed")
                            .otherwise("completed_with_failures"))


def covered_days(rows: DataFrame, ts: str = "ts") -> DataFrame:
    """Every day from the first to the last row of a table."""
    return rows.agg(F.min(F.to_date(ts)).alias("lo"), F.max(F.to_date(ts)).alias("hi")).select(
        F.explode(F.sequence("lo", "hi")).alias("day"))
