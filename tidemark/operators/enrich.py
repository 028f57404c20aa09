"""Lookups and joins.

No join here carries a broadcast hint on a table that grows: the optimizer broadcasts a side whose
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a shuffle join,
split where a key is skewed, beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import MONEY
from .clean import with_total


def enrich_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with item name and category; an unknown item keeps its order with NULLs."""
    return orders.join(items, "item_id", "left")


def enrich_fully(orders: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    return with_total(orders.join(items, "item_id", "left").join(users, "user_id", "left"))


def enrich_trades(trades: DataFrame, instruments: DataFrame) -> DataFrame:
    return trades.join(instruments, "symbol", "left")


def enrich_from_state(orders: DataFrame, state: DataFrame, key: str, price: str) -> DataFrame:
    """Orders priced by the current state of a change-captured dimension."""
    joined = orders.join(state, key, "left")
    return joined.withColumn("total_amount", (F.col("qty") * F.col(price)).cast(MONEY))


def _volume_report(trades: Column, returns: Column, gross: Column, refund: Column) -> list[Column]:
    refund = F.coalesce(refund, F.lit(0).cast(MONEY))
    return [trades.alias("total_trades"), returns.alias("total_returns"),
            (trades - returns).alias("net_trades"), gross.alias("gross_volume"),
            refund.alias("refund_volume"), (gross - refund).alias("net_volume")]


def net_trading_volume(trades: DataFrame, returns: DataFrame, instruments: DataFrame) -> DataFrame:
    """Trades left-joined to returns per instrument category, with the fan-out of that join.

    A trade with r returns appears max(r, 1) times in the join. The pairs are never made: both sides
    are reduced to one row per id (and category) and the repeats become a factor.
    """
    per_trade = (trades.groupBy("trade_id", "symbol")
                 .agg(F.count("*").alias("n"), F.sum("trade_value").alias("value"))
                 .join(instruments.select("symbol", "instrument_category"), "symbol", "left"))
    per_return = returns.groupBy(F.col("order_id").alias("trade_id")).agg(
        F.count("*").alias("r"), F.sum("refund_amount").alias("refund"))
    joined = per_trade.join(per_return, "trade_id", "left")
    repeats = F.coalesce(F.col("r"), F.lit(1))
    sums = joined.groupBy("instrument_category").agg(
        F.sum(F.col("n") * repeats).alias("t"),
        F.coalesce(F.sum(F.col("n") * F.col("r")), F.lit(0)).alias("q"),
        F.sum((F.col("value") * repeats).cast("decimal(28,2)")).alias("g"),
        F.sum((F.col("refund") * F.col("n")).cast("decimal(28,2)")).alias("f"))
    return sums.select("instrument_category", *_volume_report(*map(F.col, "tqgf")))


def net_trading_volume_exact(trades: DataFrame, returns: DataFrame,
                             instruments: DataFrame) -> DataFrame:
    """Every trade and every refund counted once.

    The refunds of an id belong to the category of its first trade by (ts, line, symbol).
    """
    known = instruments.select("symbol", "instrument_category")
    traded = (trades.groupBy("symbol")
              .agg(F.count("*").alias("t"), F.sum("trade_value").alias("g"))
              .join(known, "symbol", "left"))
    first = (trades.groupBy("trade_id")
             .agg(F.min(F.struct("ts", "line", "symbol")).alias("first"))
             .select("trade_id", F.col("first.symbol").alias("symbol")))
    refunded = (returns.groupBy(F.col("order_id").alias("trade_id"))
                .agg(F.count("*").alias("q"), F.sum("refund_amount").alias("f"))
                .join(first, "trade_id").join(known, "symbol", "left"))
    both = (traded.select("instrument_category", "t", "g")
            .unionByName(refunded.select("instrument_category", "q", "f"),
                         allowMissingColumns=True))
    sums = both.groupBy("instrument_category").agg(
        F.sum("t").alias("t"), F.coalesce(F.sum("q"), F.lit(0)).alias("q"),
        F.sum("g").alias("g"), F.sum("f").alias("f"))
    return sums.select("instrument_category", *_volume_report(*map(F.col, "tqgf")))


def return_rate(volume: DataFrame) -> DataFrame:
    """Refunds as a percentage of gross volume; NULL where nothing was traded."""
    rate = (F.col("refund_volume").cast("double") * 100.0
            / F.nullif(F.col("gross_volume").cast("double"), F.lit(0.0)))
    return volume.select(
        "instrument_category", "net_trades", "gross_volume", "refund_volume", "net_volume",
        F.round(rate, 2).alias("return_rate_percent"))


def magnitude(value: Column) -> Column:
    """A whole number that never falls as the value rises; at most some hundred different ones."""
    v = value.cast("double")
    return (F.signum(v) * F.floor(F.log2(F.abs(v) + 1))).cast("int")


def join_bands(df: DataFrame, value: str, bands: DataFrame, out: str = "risk_level") -> DataFrame:
    """Labels of the bands [threshold_min, threshold_max] that hold the value; NULL outside all.

    A value in two bands gives two rows, as a range join does. Each band stands under every
    magnitude it reaches, so values meet bands by an equi-join and the bounds are tested after it.
    """
    spread = bands.select(
        F.col("threshold_min").alias("_low"), F.col("threshold_max").alias("_high"), out).filter(
        "_low <= _high").withColumn("_size", F.explode(F.sequence(
            magnitude(F.col("_low")), magnitude(F.col("_high")))))
    return df.join(spread, (magnitude(F.col(value)) == F.col("_size"))
                   & F.col(value).between(F.col("_low"), F.col("_high")), "left").drop(
        "_size", "_low", "_high")


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent. A NULL key is an orphan too.

    Whole numbers are compared 64 keys at a time, as bits of one row that is made before the shuffle; only
    the missing keys are joined with the children.
    """
    types = {df.schema[k].dataType.typeName() for df, k in ((children, child_key), (parents, parent_key))}
    if not types <= {"integer", "long"}:
        keys = parents.select(F.col(parent_key).alias(child_key)).distinct()
        return children.join(keys, child_key, "left_anti")

    def bits(df: DataFrame, key: str, mine: str, other: str) -> DataFrame:
        at = F.col(key).cast("long")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
        return df.filter(at.isNotNull()).select(
            F.shiftright(at, 6).alias("_block"), bit.alias(mine), F.lit(0).cast("long").alias(other))

    both = bits(children, child_key, "_child", "_parent").unionByName(
        bits(parents, parent_key, "_parent", "_child"))
    missing = both.groupBy("_block").agg(
        F.bit_or("_child").alias("_child"), F.bit_or("_parent").alias("_parent")).select(
        "_block", F.col("_child").bitwiseAND(F.bitwise_not("_parent")).alias("_missing")).filter(
        "_missing <> 0")
    keys = missing.select(
        "_missing", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("_bit"),
        F.shiftleft("_block", 6).alias("_first")).filter(
        F.expr("(shiftrightunsigned(_missing, _bit) & 1) = 1")).select(
        (F.col("_first") + F.col("_bit")).cast(children.schema[child_key].dataType).alias(child_key))
    return children.join(keys, child_key, "left_semi").unionByName(
        children.filter(F.col(child_key).isNull()).select(
            child_key, *[c for c in children.columns if c != child_key]))


def semi_by_ids(df: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Rows whose id stands in a ledger table.

    Ids are made distinct first, with map-side combining: a semi join cannot split a hot right side.
    """
    return df.join(ledger.select(key).distinct(), key, "left_semi")


def catalog_join(objects: DataFrame, namespaces: DataFrame, left: str, right: str) -> DataFrame:
    return objects.join(namespaces, F.col(left) == F.col(right))


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str],
              measures: Sequence[str]) -> DataFrame:
    """The same aggregate from two stores side by side, with differences; a side may be missing."""
    a = left.select(*keys, *[F.col(m).alias(f"left_{m}") for m in measures])
    b = right.select(*keys, *[F.col(m).alias(f"right_{m}") for m in measures])
    diffs = [(F.coalesce(F.col(f"left_{m}"), F.lit(0))
              - F.coalesce(F.col(f"right_{m}"), F.lit(0))).alias(f"diff_{m}") for m in measures]
    both = a.join(b, list(keys), "full_outer")
    return both.select(*keys, *[f"left_{m}" for m in measures],
                       *[f"right_{m}" for m in measures], *diffs)


