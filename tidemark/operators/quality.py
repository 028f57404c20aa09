"""Data-quality and reconciliation reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .enrich import reconcile


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raw, unique and surplus rows and the inflation ratio, from counts per key."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_count"), F.count("*").alias("unique_count"),
        F.count_if(F.col("n") > 1).alias("repeated_keys")
    ).select(
        "raw_count", "unique_count", "repeated_keys",
        (F.col("raw_count") - F.col("unique_count")).alias("surplus_count"),
        F.round(F.col("raw_count") / F.nullif(F.col("unique_count"), F.lit(0)), 4)
        .alias("inflation"))


def summary_inflation(insert_fed: DataFrame, final: DataFrame, category: str) -> DataFrame:
    """A summary that saw every insert next to one over the final rows, per category."""
    return reconcile(insert_fed, final, [category], ["event_count", "total_value"])


def daily_gaps(df: DataFrame, key: str, start: str | None = None, end: str | None = None,
               ts: str = "ts") -> DataFrame:
    """Days without a row, per key, between two dates (inclusive), by default the table's own."""
    if not (start and end):
        own = df.agg(F.min(F.to_date(ts)).alias("low"), F.max(F.to_date(ts)).alias("high")).first()
        start, end = start or own["low"], end or own["high"]
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    seen = df.select(key, F.to_date(ts).alias("day")).distinct()
    spine = seen.select(key).distinct().select(key, F.explode(days).alias("day"))
    return spine.join(seen, [key, "day"], "left_anti")


def bucket_counts(df: DataFrame, unit: str, ts: str = "ts") -> DataFrame:
    return df.groupBy(F.date_trunc(unit, ts).cast("timestamp_ntz").alias(unit)).agg(
        F.count("*").alias("row_count"))


def enrichment_coverage(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count("*").alias("total_orders"), F.count(column).alias("enriched_orders"),
                  (F.count("*") - F.count(column)).alias("missing_enrichment"))


def rule_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violations per named rule in one pass; a rule that is NULL counts as broken."""
    counts = df.agg(F.count("*").alias("_all"), *[
        F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations"))
                      for n in rules])
    return counts.select(F.inline(pairs), F.col("_all").alias("checked"))


def unique_violations(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows beyond the first of every key, as one row in the shape of ``rule_report``."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"),
                       F.coalesce(F.sum("n"), F.lit(0)).alias("checked")).select(
        F.lit(name).alias("rule"), "violations", "checked")


def category_check(df: DataFrame, category: str) -> DataFrame:
    """Rows per category with NULL and the empty string shown as themselves."""
    shown = (F.when(F.col(category).isNull(), "<null>").when(F.col(category) == "", "<empty>")
             .otherwise(F.col(category)))
    return df.groupBy(shown.alias("category")).agg(F.count("*").alias("record_count"))


def window_multiplicity(df: DataFrame, category: str = "category") -> DataFrame:
    """Windows stored in more than one row, with the distinct categories among them."""
    return (df.groupBy("window_start", "window_end")
            .agg(F.count("*").alias("records"),
                 F.count_distinct(category).alias("unique_categories"))
            .filter(F.col("records") > 1))
