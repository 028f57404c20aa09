"""Change logs, current state, change feeds between two states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.segments import HOT_ROWS, lag_in_key

FEED_OPS = ("Insert", "Delete", "UpdateDelete", "UpdateInsert")


def current_state(log: DataFrame, keys: Sequence[str], seq: Sequence[str],
                  op: str = "op") -> DataFrame:
    """Fold a change log: the last change of a key wins and a D removes the key."""
    rest = [c for c in log.columns if c not in set(keys) | set(seq) | {op}]
    last = log.groupBy(*keys).agg(F.max(F.struct(*seq, op, *rest)).alias("_last"))
    return (last.filter(F.col(f"_last.{op}") != "D")
            .select(*keys, *[F.col(f"_last.{c}").alias(c) for c in (*seq, *rest)]))


def state_as_of(df: DataFrame, key: str, value: str, seq: Sequence[str], as_of: str,
                ts: str = "ts") -> DataFrame:
    """Last value per key up to a moment, with the time it was set."""
    upto = df.filter(F.col(ts) <= F.lit(as_of).cast("timestamp_ntz"))
    last = upto.groupBy(key).agg(F.max(F.struct(*seq, value)).alias("_last"))
    return last.select(key, F.col(f"_last.{value}").alias(value),
                       F.col(f"_last.{ts}").alias("changed_at"))


def apply_changes(base: DataFrame, changes: DataFrame, keys: Sequence[str],
                  seq: Sequence[str], op: str = "op") -> DataFrame:
    """Base table plus a batch of changes: upserts replace, deletes remove, others stay.

    Several changes of one key in a batch are folded first. Columns are matched by name.
    """
    touched = changes.select(*keys).distinct()
    kept = base.join(touched, list(keys), "left_anti")
    fresh = current_state(changes, keys, seq, op).select(*base.columns)
    return kept.unionByName(fresh)


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str],
                at: Column) -> DataFrame:
    """Rows that turn one state into the next; a changed key gives its old row, then its new one.

    ``at`` stamps the changes; it may use ``_old`` and ``_new``. Unchanged rows give nothing.
    """
    keys, values = list(keys), list(values)
    a = old.select(*keys, F.struct(*values).alias("_old"))
    b = new.select(*keys, F.struct(*values).alias("_new"))
    both = a.join(b, keys, "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new")))

    def row(op, side):
        return F.struct(F.lit(op).alias("op"), F.col(side).alias("_row"))

    changes = (F.when(F.col("_old").isNull(), F.array(row("Insert", "_new")))
               .when(F.col("_new").isNull(), F.array(row("Delete", "_old")))
               .otherwise(F.array(row("UpdateDelete", "_old"), row("UpdateInsert", "_new"))))
    feed = both.select(*keys, at.alias("changed_at"), F.inline(changes))
    return feed.select(*keys, *[F.col(f"_row.{v}").alias(v) for v in values], "op", "changed_at")


def snapshot_rows(state: DataFrame, at: Column) -> DataFrame:
    """A full state as Insert rows, the start of a subscription."""
    return state.withColumn("op", F.lit("Insert")).withColumn("changed_at", at)


def feed_with_snapshot(snapshot: DataFrame, feed: DataFrame, as_of: str, retention: str,
                       where: Column | None = None) -> DataFrame:
    """Snapshot first, then changes not older than the retention; optionally filtered.

    ``phase`` orders the two parts: 0 snapshot, 1 change.
    """
    oldest = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {retention}")
    out = (snapshot.withColumn("phase", F.lit(0))
           .unionByName(feed.filter(F.col("changed_at") >= oldest)
                        .withColumn("phase", F.lit(1))))
    return out if where is None else out.filter(where)


def new_status_notifications(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col("op") == "UpdateInsert").drop("op")


def feed_stats(feed: DataFrame) -> DataFrame:
    return feed.groupBy("op").agg(
        F.count("*").alias("event_count"), F.max("changed_at").alias("last_event"))


def feed_from_log(log: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                  cell: Column | None = None, known: str | None = None,
                  hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Change feed of a whole log: an Insert per key, then old and new row at every change.

    Rows whose ``known`` flag is set only say what the key's value was before: they emit nothing.
    """
    marked = log.withColumn("_seen", F.struct(value))
    prev = lag_in_key(marked, list(keys), list(order), cell, "_seen", "_prev", hot_rows)
    if known:
        prev = prev.filter(~F.coalesce(F.col(known), F.lit(False)))
    now, before = F.col("_seen"), F.col("_prev")

    def row(op, value_col):
        return F.struct(F.lit(op).alias("op"), value_col.alias(value))

    changes = (F.when(before.isNull(), F.array(row("Insert", now[value])))
               .when(~before.eqNullSafe(now), F.array(row("UpdateDelete", before[value]),
                                                      row("UpdateInsert", now[value]))))
    return prev.select(*keys, *order, F.inline(changes))
