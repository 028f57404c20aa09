"""Feeds a stored table to a stream in event-time order and compares with the batch form."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def feed_folder(df: DataFrame, path: str, slices: int = 4, ts: str = "ts") -> DataFrame:
    """Write the rows as files in time order with increasing modification times; return the stream."""
    rows = df.orderBy(ts, *[c for c in df.columns if c != ts]).toPandas()
    os.makedirs(path, exist_ok=True)
    step = max(1, -(-len(rows) // slices))
    for i in range(0, max(len(rows), 1), step):
        add_file(df, rows.iloc[i:i + step], path, i // step)
    return open_stream(df, path)


def add_file(df: DataFrame, pdf, path: str, number: int) -> None:
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import to_arrow_schema

    table = pa.Table.from_pandas(pdf, schema=to_arrow_schema(df.schema), preserve_index=False)
    name = f"{path}/part-{number:05d}.parquet"
    pq.write_table(table, name, coerce_timestamps="us")
    os.utime(name, (1_700_000_000 + number, 1_700_000_000 + number))


def open_stream(df: DataFrame, path: str) -> DataFrame:
    return (df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", "1")
            .parquet(path))


def same_rows(a: DataFrame, b: DataFrame) -> None:
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)

    def rows(df):
        return sorted(tuple(str(v) for v in r) for r in df.select(*cols).collect())
    left, right = rows(a), rows(b)
    assert left == right, (len(left), len(right), left[:2], right[:2])
    assert left


def sentinel(df: DataFrame, like: DataFrame | None = None, **values) -> DataFrame:
    """The table and one row far in the future, which closes all windows before it."""
    last = df.limit(1)
    last = last.withColumns({k: F.lit(v).cast(df.schema[k].dataType) for k, v in values.items()})
    return df.unionByName(last)
