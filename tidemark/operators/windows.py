"""Tumbling, hopping and session windows over stored tables.

The streaming pipelines use Spark's own event-time windows; the rules are the same: windows start at
multiples of the slide since the epoch, are half-open, and a session ends at its last event.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.means import mean, ratio
from ..functions.segments import lag_in_key
from .aggregates import trunc


def tumble(df: DataFrame, size: str, keys: Sequence[str], aggs: Mapping[str, Column],
           ts: str = "ts") -> DataFrame:
    """Fixed windows. Works on streams too when a watermark is set on ``ts``."""
    grouped = df.groupBy(*keys, F.window(ts, size).alias("_w")).agg(
        *[c.alias(n) for n, c in aggs.items()])
    return grouped.select(*keys, F.col("_w.start").alias("window_start"),
                          F.col("_w.end").alias("window_end"), *aggs)


def revenue_tumble(orders: DataFrame, items: DataFrame, size: str, amount: str = "amount",
                   unknown: str | None = None) -> DataFrame:
    """Revenue per category and window in two steps: per item, then per category.

    The lookup and the second shuffle work on (item, window) totals instead of order lines.
    """
    step1 = tumble(orders, size, ["item_id"],
                   {"revenue": F.sum(amount), "order_count": F.count("*")})
    step2 = step1.join(items.select("item_id", "category"), "item_id", "left")
    if unknown is not None:
        step2 = step2.withColumn("category", F.coalesce("category", F.lit(unknown)))
    return step2.groupBy("category", "window_start", "window_end").agg(
        F.sum("revenue").alias("revenue"), F.sum("order_count").alias("order_count"))


def priced_totals(orders: DataFrame, items: DataFrame, size: str) -> DataFrame:
    """item_id, window_start, window_end, category, order_count, revenue, at list prices.

    A price belongs to the item, so quantities are summed per item and window before the lookup."""
    sums = tumble(orders, size, ["item_id"], {"qty": F.sum("qty"), "order_count": F.count("*")})
    return sums.join(items.select("item_id", "category", "price"), "item_id", "left").withColumn(
        "revenue", F.col("qty").cast("decimal(18,0)") * F.col("price"))


def trade_windows(trades: DataFrame, size: str) -> DataFrame:
    return tumble(trades, size, ["symbol"], {
        "trade_count": F.count("*"), "total_volume": F.sum("volume"),
        "total_value": F.sum("trade_value"), "avg_value": mean("trade_value"),
        "min_value": F.min("trade_value"), "max_value": F.max("trade_value")})


def hop_starts(pane: str | Column, slide: str, panes: int) -> Column:
    """Starts of all windows of ``panes`` slides that contain the pane starting at ``pane``."""
    p = F.col(pane) if isinstance(pane, str) else pane
    return F.array(*[p - F.expr(f"INTERVAL {slide}") * F.lit(i) for i in range(panes)])


def hop(df: DataFrame, keys: Sequence[str], slide: str, panes: int,
        partial: Mapping[str, Column], final: Mapping[str, Column],
        also: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """Sliding windows of ``panes`` slides each, built from panes of one slide.

    A row belongs to many windows. Instead of copying it into each, rows are reduced to one row per
    key and pane, and only those are copied. ``also`` names further columns that a distinct count in
    ``final`` needs kept apart until then.
    """
    by_pane = (df.groupBy(*keys, *also, F.window(ts, slide).start.alias("_pane"))
               .agg(*[c.alias(n) for n, c in partial.items()]))
    spread = by_pane.withColumn("window_start", F.explode(hop_starts("_pane", slide, panes)))
    return spread.groupBy(*keys, "window_start").agg(*[c.alias(n) for n, c in final.items()])


def activity_hop(events: DataFrame, slide: str, panes: int) -> DataFrame:
    return hop(events, ["user_id"], slide, panes,
               {"n": F.count("*"), "s": F.sum("value")},
               {"order_count": F.sum("n"), "total_spent": F.sum("s")})


def fraud_alerts(events: DataFrame, slide: str, panes: int, min_count: int = 5,
                 max_count: int = 10, max_spent: float = 5000) -> DataFrame:
    """Windows with more than ``min_count`` rows, labelled; the first matching label wins."""
    label = (F.when(F.col("order_count") > max_count, "Suspicious: Too many orders")
             .when(F.col("total_spent") > max_spent, "Suspicious: High spending")
             .otherwise("Normal"))
    return (activity_hop(events, slide, panes).filter(F.col("order_count") > min_count)
            .withColumn("risk_level", label))


def score_columns(count: Column, spent: Column, items: Column, avg: Column,
                  high: Sequence[float], medium: Sequence[float]) -> dict[str, Column]:
    """Additive risk score and its class; the class does not look at the average."""
    def points(test, n):
        return F.when(test, n).otherwise(0)
    many, costly, varied, dear = (count > high[0], spent > high[1], items > high[2], avg > high[3])
    return {
        "risk_score": points(many, 30) + points(costly, 40) + points(varied, 20)
        + points(dear, 10),
        "risk_category": F.when(many | costly | varied, "HIGH_RISK")
        .when((count > medium[0]) | (spent > medium[1]), "MEDIUM_RISK").otherwise("LOW_RISK"),
    }


def fraud_score(events: DataFrame, slide: str, panes: int, item: str = "item_id",
                high: Sequence[float] = (10, 5000, 15, 500), medium: Sequence[float] = (5, 2000),
                high_value: float = 500) -> DataFrame:
    """Behaviour of a user per sliding window with distinct items, active hours and a score."""
    hourly = events.withColumn("_hour", trunc("ts", "hour"))
    base = hop(hourly, ["user_id"], slide, panes,
               {"n": F.count("*"), "s": F.sum("value"),
                "h": F.count_if(F.col("value") > high_value)},
               {"order_count": F.sum("n"), "total_spent": F.sum("s"),
                "unique_items": F.count_distinct(item),
                "avg_order_value": ratio(F.sum("s"), F.sum("n")),
                "high_value_orders": F.sum("h"), "active_hours": F.count_distinct("_hour")},
               also=[item, "_hour"])
    return base.withColumns(score_columns(
        F.col("order_count"), F.col("total_spent"), F.col("unique_items"),
        F.col("avg_order_value"), high, medium))


def user_sessions(events: DataFrame, gap_seconds: int, keys: Sequence[str] = ("user_id",),
                  measure: str = "value", ts: str = "ts") -> DataFrame:
    """Gap sessions. Rows exactly ``gap`` apart stay in one session.

    Two rows in the same slot of one gap length are always in the same session, so rows are first
    reduced to one per key and slot. What is left per key is bounded by time span / gap, whatever
    the number of rows.
    """
    keys = list(keys)
    slots = events.groupBy(*keys, F.window(ts, f"{gap_seconds} seconds").start.alias("_slot")).agg(
        F.min(ts).alias("first"), F.max(ts).alias("last"),
        F.count("*").alias("n"), F.sum(measure).alias("s"))
    w = Window.partitionBy(*keys).orderBy("_slot")
    apart = F.col("first") - F.lag("last").over(w) > F.make_dt_interval(secs=F.lit(gap_seconds))
    opens = F.when(F.lag("last").over(w).isNull() | apart, 1).otherwise(0)
    numbered = (slots.withColumn("_opens", opens)
                .withColumn("session_no", F.sum("_opens").over(w)))
    return numbered.groupBy(*keys, "session_no").agg(
        F.min("first").alias("session_start"), F.max("last").alias("session_end"),
        F.sum("n").alias("events_in_session"), F.sum("s").alias("session_value"))


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
                   cell: Column | None = None) -> DataFrame:
    """Value of the key's previous row in order; hot keys are cut where the data says."""
    return lag_in_key(df, list(keys), list(order), cell, value, out)
