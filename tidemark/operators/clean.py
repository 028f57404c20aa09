"""Making an at-least-once feed usable: newest version, validation, derived columns, predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendars import day_of_week
from ..functions.text import parse_event_time
from ..sources.tables import MONEY


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, which should end in a tie-breaker.

    A max over a struct combines on the map side, so a key with very many versions costs each
    input partition one row. Columns outside keys and order ride along behind the order columns.
    """
    rest = [c for c in df.columns if c not in set(keys) | set(order)]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_newest"))
    return newest.select(*keys, "_newest.*")


def with_total(df: DataFrame, qty: str = "qty", price: str = "price") -> DataFrame:
    return df.withColumn("total_amount", (F.col(qty) * F.col(price)).cast(MONEY))


def banded(value: str | Column, bounds: Sequence[tuple[float, str]], above: str,
           inclusive: bool = False) -> Column:
    """Label of the first band whose upper bound exceeds (or with ``inclusive`` reaches) the value."""
    c = F.col(value) if isinstance(value, str) else value
    out = None
    for bound, label in bounds:
        test = c <= bound if inclusive else c < bound
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.when(c.isNotNull(), above)


def transform_orders(orders: DataFrame, small: float = 50, medium: float = 200) -> DataFrame:
    return with_total(orders).select(
        "order_id", "user_id", "qty", "price", "total_amount",
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("order_date"),
        day_of_week("ts").alias("day_of_week"),
        banded("total_amount", [(small, "Small"), (medium, "Medium")], "Large").alias("order_size"),
        "ts")


def order_rules(as_of: str) -> dict[str, Column]:
    """Named rules of a valid order; a row is valid when every rule is true."""
    return {
        "qty_positive": F.col("qty") > 0,
        "price_positive": F.col("price") > 0,
        "not_in_future": F.col("ts") <= F.lit(as_of).cast("timestamp_ntz"),
        "user_present": F.col("user_id").isNotNull(),
    }


def validate(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    for rule in rules.values():
        df = df.filter(rule)
    return df


def with_reject_reason(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """All rows, with the first rule a row breaks (a NULL comparison breaks it) or NULL."""
    reason = F.coalesce(*[
        F.when(~F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items()])
    return df.withColumn("reject_reason", reason)


def risk_banded(trades: DataFrame, low: float = 10000, medium: float = 50000) -> DataFrame:
    band = banded("trade_value", [(low, "Low"), (medium, "Medium")], "High", inclusive=True)
    return trades.withColumn("risk_level", band)


# Status by remainder of the order id.
STATUSES = ("pending", "processing", "shipped", "delivered", "cancelled")


def assign_status(df: DataFrame, key: str = "order_id") -> DataFrame:
    names = F.array(*map(F.lit, STATUSES))
    pos = (F.pmod(F.col(key), F.lit(len(STATUSES))) + 1).cast("int")
    return df.withColumn("status", F.element_at(names, pos))


def match_predicates(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Rows under every predicate they satisfy, all predicates in one scan."""
    hits = F.array_compact(F.array(*[F.when(p, F.lit(n)) for n, p in predicates.items()]))
    any_hit = None
    for p in predicates.values():
        any_hit = p if any_hit is None else any_hit | p
    return df.filter(any_hit).select(F.explode(hits).alias("predicate"), "*")


def recent(df: DataFrame, as_of: str, interval: str, ts: str = "ts") -> DataFrame:
    """Rows of the interval that ends at ``as_of``; literals only, so the scan can prune."""
    end = F.lit(as_of).cast("timestamp_ntz")
    return df.filter((F.col(ts) >= end - F.expr(f"INTERVAL {interval}")) & (F.col(ts) <= end))


def recent_view(df: DataFrame, name: str, as_of: str, interval: str, ts: str = "ts") -> DataFrame:
    """The same rows registered as a temporary view, recomputed by every reader."""
    recent(df, as_of, interval, ts).createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def null_safe(df: DataFrame, defaults: Mapping[str, object],
              types: Mapping[str, str] | None = None) -> DataFrame:
    """Replace NULLs and align types with a destination that accepts neither."""
    cols = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}
    for c, t in (types or {}).items():
        cols[c] = cols.get(c, F.col(c)).cast(t)
    return df.withColumns(cols)


def decode(code: str, labels: Mapping[str, str], other: str) -> Column:
    """Label of a code from a fixed mapping."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col(code)), F.lit(other))


def parse_times(df: DataFrame, text: str, out: str = "ts") -> DataFrame:
    """Event time from text, and ``rejected`` = 1 where a text is present but is not a time."""
    return (df.withColumn(out, parse_event_time(text))
            .withColumn("rejected", F.when(F.col(text).isNotNull() & F.col(out).isNull(), 1)
                        .otherwise(0)))


def flatten_event(df: DataFrame, json_column: str, schema: str | T.StructType) -> DataFrame:
    """JSON text to flat columns; a nested field a.b becomes a_b, an absent field is NULL."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)

    def paths(struct: T.StructType, prefix: tuple[str, ...] = ()):
        for f in struct.fields:
            here = (*prefix, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from paths(f.dataType, here)
            else:
                yield here

    parsed = df.withColumn("_event", F.from_json(json_column, schema)).drop(json_column)
    flat = [F.col(".".join(("_event", *p))).alias("_".join(p)) for p in paths(schema)]
    kept = [c for c in parsed.columns if c != "_event"]
    return parsed.select(*kept, *flat)
