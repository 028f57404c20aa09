"""Collects the query definitions and gives every result the same portable column types."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import tune
from ..sources.tables import Tables

Plan = Callable[[Tables], DataFrame]
_PLANS: dict[str, Plan] = {}
_SQL: dict[str, str] = {}


def plan(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a query, with the SQL that gives the same rows."""
    def register(fn: Plan) -> Plan:
        if name in _PLANS:
            raise ValueError(f"{name} is registered twice")
        _PLANS[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return register


def portable(df: DataFrame) -> DataFrame:
    """Exact decimals become doubles and dates text at the very end, as other tools show them."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _load() -> None:
    from . import changes, events, orders, quality, stats, stores, streams  # noqa: F401


def plans() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(fn: Plan):
        return lambda spark, path: portable(fn(Tables(tune(spark), path)))
    return {name: bind(fn) for name, fn in _PLANS.items()}


def oracles() -> dict[str, str]:
    _load()
    return dict(_SQL)
