"""Grouped summaries and top-k reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.means import mean, ratio
from ..sources.tables import MONEY


def trunc(ts: str | Column, unit: str) -> Column:
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def revenue_by_time(df: DataFrame, unit: str, amount: str = "amount", ts: str = "ts") -> DataFrame:
    return df.groupBy(trunc(ts, unit).alias(unit)).agg(
        F.sum(amount).alias("revenue"), F.count("*").alias("order_count"))


def revenue_by_category(orders: DataFrame, items: DataFrame, amount: str = "amount") -> DataFrame:
    """Sums per item first, so the lookup and the second shuffle see one row per item."""
    per_item = orders.groupBy("item_id").agg(
        F.sum(amount).alias("revenue"), F.count("*").alias("order_count"))
    return (per_item.join(items.select("item_id", "category"), "item_id", "left")
            .groupBy("category")
            .agg(F.sum("revenue").alias("revenue"), F.sum("order_count").alias("order_count")))


def trading_by_category(trades: DataFrame, instruments: DataFrame) -> DataFrame:
    per_symbol = trades.groupBy("symbol").agg(
        F.count("*").alias("n"), F.sum("trade_value").alias("v"),
        F.min("trade_value").alias("lo"), F.max("trade_value").alias("hi"))
    return (per_symbol.join(instruments.select("symbol", "instrument_category"), "symbol", "left")
            .groupBy("instrument_category")
            .agg(F.sum("n").alias("trade_count"), F.sum("v").alias("total_value"),
                 ratio(F.sum("v"), F.sum("n")).alias("avg_trade_value"),
                 F.min("lo").alias("min_trade_value"), F.max("hi").alias("max_trade_value")))


def top_traders(trades: DataFrame, k: int = 100) -> DataFrame:
    per_trader = trades.groupBy("trader_id").agg(
        F.count("*").alias("trade_count"), F.sum("trade_value").alias("total_value"),
        F.count_distinct("symbol").alias("unique_symbols"),
        mean("trade_value").alias("avg_trade_value"), F.max("ts").alias("last_trade"))
    return per_trader.orderBy(F.desc("total_value"), "trader_id").limit(k)


def risk_analysis(banded_trades: DataFrame) -> DataFrame:
    return banded_trades.groupBy("risk_level").agg(
        F.count("*").alias("trade_count"), F.sum("trade_value").alias("total_value"),
        mean("trade_value").alias("avg_trade_value"),
        F.count_distinct("trader_id").alias("unique_traders"))


def user_stats(orders: DataFrame) -> DataFrame:
    return orders.groupBy("user_id").agg(
        F.count("*").alias("order_count"), F.sum("amount").alias("total_spent"),
        F.max("ts").alias("last_order"))


def dashboard_sales(orders: DataFrame, unit: str = "minute") -> DataFrame:
    total = (F.col("qty") * F.col("price")).cast(MONEY)
    return orders.groupBy(trunc("ts", unit).alias(unit)).agg(
        F.count("*").alias("orders"), F.sum(total).alias("revenue"),
        mean(total).alias("avg_order_value"), F.count_distinct("user_id").alias("unique_customers"))


def user_features(orders: DataFrame, high_value: float = 1000) -> DataFrame:
    """Per user; lifetime is the seconds between first and last order.

    Summed per user and day first: the distinct days are then rows, and no distinct aggregate is
    needed.
    """
    total = (F.col("qty") * F.col("price")).cast(MONEY)
    daily = orders.groupBy("user_id", trunc("ts", "day").alias("day")).agg(
        F.count("*").alias("n"), F.sum(total).alias("spent"), F.min("ts").alias("first"),
        F.max("ts").alias("last"), F.count_if(total > high_value).alias("high"))
    return daily.groupBy("user_id").agg(
        F.sum("n").alias("total_orders"), F.sum("spent").alias("total_spent"),
        ratio(F.sum("spent"), F.sum("n")).alias("avg_order_value"),
        F.timestamp_diff("SECOND", F.min("first"), F.max("last")).alias("lifetime_seconds"),
        F.count("day").alias("active_days"), F.sum("high").alias("high_value_orders"))


def product_features(orders: DataFrame, items: DataFrame, price: str = "price") -> DataFrame:
    per_item = orders.groupBy("item_id").agg(
        F.count("*").alias("total_orders"), F.sum("qty").alias("total_quantity_sold"),
        mean(price).alias("avg_price"), F.count_distinct("user_id").alias("unique_customers"),
        (F.max(price) - F.min(price)).alias("price_range"),
        F.round(F.stddev_samp(F.col(price).cast("double")), 4).alias("price_stddev"))
    return per_item.join(items, "item_id", "left")


def salary_stats(emp: DataFrame, by: Mapping[str, Column]) -> DataFrame:
    return emp.groupBy(*[c.alias(n) for n, c in by.items()]).agg(
        F.count("*").alias("employees"), mean("salary", 2).alias("avg_salary"),
        F.min("salary").alias("min_salary"), F.max("salary").alias("max_salary"))


def sensor_stats(events: DataFrame, by: Mapping[str, Column], stddev_above: float) -> DataFrame:
    v = F.col("value")
    return events.groupBy(*[c.alias(n) for n, c in by.items()]).agg(
        F.count("*").alias("readings"), mean(v).alias("avg_value"), F.max(v).alias("max_value"),
        F.round(F.stddev_samp(F.when(v > stddev_above, v.cast("double"))), 4)
        .alias("stddev_high"))


def category_totals(df: DataFrame, category: str, measure: str, more_than: int) -> DataFrame:
    return (df.groupBy(category)
            .agg(F.count("*").alias("row_count"), F.sum(measure).alias("total"))
            .filter(F.col("row_count") > more_than))


def measure_profile(df: DataFrame, measure: str, ts: str, by: str) -> DataFrame:
    """Aggregates that need real column values: per group, and over everything as group ALL.

    The grand total is added up from the group rows, not from a second scan.
    """
    parts = df.groupBy(F.col(by).cast("string").alias("grp")).agg(
        F.count("*").alias("n"), F.sum(measure).alias("s"), F.min(measure).alias("lo"),
        F.max(measure).alias("hi"), F.max(ts).alias("last"))
    keyed = parts.withColumn("grp", F.explode(F.array("grp", F.lit("ALL"))))
    return keyed.groupBy("grp").agg(
        F.sum("n").alias("row_count"), F.sum("s").alias("total"), F.min("lo").alias("min_value"),
        F.max("hi").alias("max_value"),
        ratio(F.sum("s"), F.sum("n")).alias("avg_value"),
        F.max("last").alias("last_ts"))


def category_profile(products: DataFrame, low_stock: int = 500) -> DataFrame:
    return products.groupBy("category").agg(
        F.count("*").alias("products"), mean("price").alias("avg_price"),
        F.sum("stock_quantity").alias("total_stock"), F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.count_if(F.col("stock_quantity") < low_stock).alias("low_stock_products"))


# ---- additive summaries --------------------------------------------------------------------------

def partial_sums(batch: DataFrame, keys: Sequence[str], measure: str, ts: str) -> DataFrame:
    """Additive rows of one inserted batch, to be appended to the summary table."""
    return batch.groupBy(*keys).agg(
        F.count("*").alias("event_count"), F.sum(measure).alias("total_value"),
        F.max(ts).alias("last_updated"))


def merge_sums(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Read a summary table: partial rows with the same key are one row."""
    return partials.groupBy(*keys).agg(
        F.sum("event_count").alias("event_count"), F.sum("total_value").alias("total_value"),
        F.max("last_updated").alias("last_updated"))


def raw_vs_final(raw: DataFrame, final: DataFrame, category: str, measure: str) -> DataFrame:
    def side(df, name):
        return df.groupBy(category).agg(
            F.count("*").alias("row_count"), F.sum(measure).alias("total")
        ).select(F.lit(name).alias("source"), category, "row_count", "total")
    return side(raw, "Raw").unionByName(side(final, "FINAL"))


def tenant_sales(orders: DataFrame, users: DataFrame, tenant: str) -> DataFrame:
    """Sales per tenant and day. Orders are summed per user and day first: the lookup meets one row
    per user and day, and counting distinct users is counting those rows."""
    per_user = orders.groupBy("user_id", trunc("ts", "day").alias("day")).agg(
        F.count("*").alias("n"), F.sum("total_amount").alias("s"))
    named = per_user.join(users.select("user_id", F.col(tenant).alias("tenant_id")), "user_id", "left")
    return named.groupBy("tenant_id", "day").agg(
        F.sum("n").alias("orders"), F.sum("s").alias("revenue"),
        F.count("user_id").alias("unique_users"))


def tenant_usage(orders: DataFrame, users: DataFrame, tenant: str, bytes_per_row: int = 100
                 ) -> DataFrame:
    per_user = orders.groupBy("user_id").agg(
        F.count("*").alias("n"), F.sum("total_amount").alias("s"))
    named = per_user.join(users.select("user_id", F.col(tenant).alias("tenant_id")), "user_id", "left")
    return named.groupBy("tenant_id").agg(
        F.sum("n").alias("order_count"), F.sum("s").alias("revenue"),
        F.count("user_id").alias("user_count"),
        (F.sum("n") * bytes_per_row).alias("estimated_storage_bytes"))


def totals_by(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("*").alias("order_count"), F.sum(measure).alias("revenue"))


def totals_per_dimension(totals: DataFrame, lookup: DataFrame | None, key: str,
                         dims: Sequence[str]) -> DataFrame:
    """(dimension, key, order_count, revenue) for each of several columns that depend on ``key``.

    ``totals`` holds order_count and revenue per key already, so what is looked up and laid out once per
    dimension are totals, not rows."""
    named = totals if lookup is None else totals.join(lookup, key, "left")
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("key"))
                      for d in dims])
    return (named.select(F.inline(pairs), "order_count", "revenue").groupBy("dimension", "key")
            .agg(F.sum("order_count").alias("order_count"), F.sum("revenue").alias("revenue")))


def top(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first k rows of a total order: a per-partition heap, then one merge of k rows each."""
    return df.orderBy(*order).limit(k)


def top_products(orders: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    per_item = orders.groupBy("item_id").agg(
        F.count("*").alias("n"), F.sum("total_amount").alias("r"))
    named = (per_item.join(items, "item_id", "left").groupBy("item_name", "category")
             .agg(F.sum("n").alias("order_count"), F.sum("r").alias("total_revenue")))
    return top(named, k, F.desc("total_revenue"), "item_name", "category")


def top_duplicates(df: DataFrame, keys: Sequence[str], k: int = 10) -> DataFrame:
    counts = (df.groupBy(*keys).agg(F.count("*").alias("occurrences"))
              .filter(F.col("occurrences") > 1))
    return top(counts, k, F.desc("occurrences"), *keys)


def labelled_counts(parts: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in parts.items():
        row = df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("component"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out
