"""Streaming forms of the operators.

Every function takes and returns a streaming DataFrame; the caller picks mode and sink. The state of
every operator is bounded by a watermark. Timestamps are zoned (UTC) inside a stream, because
watermarks need that, and come out without zone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import windows as batch


def with_event_time(stream: DataFrame, delay: str, ts: str = "ts") -> DataFrame:
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def without_zone(df: DataFrame) -> DataFrame:
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def windowed_revenue(orders: DataFrame, size: str, amount: Column | None = None) -> DataFrame:
    """Revenue per item and window. In append mode only closed windows come out; in update mode
    every refreshed window does."""
    value = F.col("amount") if amount is None else amount
    return batch.tumble(orders, size, ["item_id"],
                        {"revenue": F.sum(value), "order_count": F.count("*")})


def revenue_by_category(orders: DataFrame, items: DataFrame, size: str) -> DataFrame:
    """The two-step form: per item and window, then per category. Needs append mode.

    Both windows close on the same watermark. The lookup meets one row per item and window.
    """
    per_item = (orders.groupBy("item_id", F.window("ts", size).alias("w"))
                .agg(F.sum("amount").alias("revenue"), F.count("*").alias("order_count")))
    named = per_item.join(items.select("item_id", "category"), "item_id", "left")
    out = named.groupBy(F.coalesce("category", F.lit("")).alias("category"), "w").agg(
        F.sum("revenue").alias("revenue"), F.sum("order_count").alias("order_count"))
    return out.select("category", F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), "revenue", "order_count")


def dedup_first(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First row per key while the key is within the watermark."""
    return stream.dropDuplicatesWithinWatermark(list(keys))


def cascade(orders: DataFrame, items: DataFrame, size: str,
            keys: Sequence[str] = ("order_id",)) -> DataFrame:
    """Deduplicate, enrich and window in one query."""
    return revenue_by_category(dedup_first(orders, keys), items, size)


def append_passthrough(stream: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """A projection; rows go out as they come in."""
    return stream.select(*[c.alias(n) for n, c in columns.items()])


def sessions(events: DataFrame, gap: str, measure: str = "value") -> DataFrame:
    """Gap sessions per user, closed by the watermark; a session ends at its last event."""
    out = events.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("session_end"),
        F.count("*").alias("events_in_session"), F.sum(measure).alias("session_value"))
    return out.drop("w")


def hop(events: DataFrame, slide: str, size: str, keys: Sequence[str],
        aggs: Mapping[str, Column]) -> DataFrame:
    """Sliding windows; arguments in the order slide, size."""
    out = events.groupBy(*keys, F.window("ts", size, slide).alias("w")).agg(
        *[c.alias(n) for n, c in aggs.items()])
    return out.select(*keys, F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), *aggs)


def fraud_scores(events: DataFrame, slide: str, size: str, item: str, high: Sequence[float],
                 medium: Sequence[float]) -> DataFrame:
    """Scores per sliding window with exact distinct items, in two aggregates on one watermark.

    A first aggregate per (user, item, window) makes items rows, so the second one counts them and
    no set of values is held in a single group's state.
    """
    per_item = events.groupBy("user_id", item, F.window("ts", size, slide).alias("w")).agg(
        F.count("*").alias("n"), F.sum("value").alias("s"))
    out = per_item.groupBy("user_id", "w").agg(
        F.sum("n").alias("order_count"), F.sum("s").alias("total_spent"),
        F.count("*").alias("unique_items"))
    n, s = F.col("order_count"), F.col("total_spent")
    scored = out.withColumns(batch.score_columns(
        n, s, F.col("unique_items"), s.cast("double") / n, high, medium))
    return scored.select("user_id", F.col("w.start").alias("window_start"), "order_count",
                         "total_spent", "unique_items", "risk_score", "risk_category")


def sensor_alerts(readings: DataFrame, size: str, key: str = "sensor_id",
                  alert: Column | None = None) -> DataFrame:
    test = F.col("status") == "ALERT" if alert is None else alert
    return hop(readings.filter(test), size, size, [key], {"alerts": F.count("*")})


def last_interval(trades: DataFrame, slide: str, size: str, key: str, measure: str) -> DataFrame:
    """Running aggregate of the last interval; the newest window of a key is the current value."""
    return hop(trades, slide, size, [key],
               {"trade_count": F.count("*"), "total_value": F.sum(measure)})


def join_within(trades: DataFrame, returns: DataFrame, within: str, delay: str) -> DataFrame:
    """Trades left-joined to returns of the same id that follow within an interval.

    The time bound lets both sides' state expire; a trade without a return comes out once none can
    arrive any more.
    """
    t = with_event_time(trades, delay).alias("t")
    r = with_event_time(returns, delay).withColumnRenamed("ts", "return_ts").alias("r")
    same = F.col("t.trade_id") == F.col("r.order_id")
    soon = (F.col("r.return_ts") >= F.col("t.ts")) & (
        F.col("r.return_ts") <= F.col("t.ts") + F.expr(f"INTERVAL {within}"))
    return t.join(r, same & soon, "left")


def top_k(stream: DataFrame, keys: Sequence[str], measure: str, k: int) -> DataFrame:
    """The k keys with the greatest sum so far; for complete mode."""
    sums = stream.groupBy(*keys).agg(F.sum(measure).alias("total"), F.count("*").alias("row_count"))
    return sums.orderBy(F.desc("total"), *keys).limit(k)
