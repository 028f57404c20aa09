"""Helpers shared by the operators: stored intermediate tables and batches of rows in tasks."""

from __future__ import annotations

from collections.abc import Iterator
from contextvars import ContextVar

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


#: Spark's setting to remove an execution's shuffle files when it has ended
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """The intermediate tables that one run makes, so that it can delete those and no others.

    Tables stored inside its ``with`` block belong to it; blocks may be nested, and results that are
    to outlast it are stored outside or with ``temporary=False``, which leaves them to the block around.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        self.outer = _scratch.set((*_scratch.get(), self))
        return self

    def __exit__(self, *error) -> None:
        _scratch.reset(self.outer)

    def clear(self) -> None:
        """Delete the tables; nothing that is still to be read may need them."""
        while self.paths:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


_scratch: ContextVar[tuple[Scratch, ...]] = ContextVar("scratch", default=())


def stored(df: DataFrame, name: str, temporary: bool = True) -> DataFrame:
    """Write a table into the cluster's shared folder and read it back.

    Cuts the lineage like a checkpoint (a lost executor costs no recomputation of what came before)
    and fixes row ids that were made while writing; columns are pruned when it is read.

    The shuffle files of the write are removed at its end: nothing else reads them, and without that
    they stay on the executors' disks until the driver's JVM happens to collect the plan.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    owners = _scratch.get()[:None if temporary else -1]
    if owners:
        owners[-1].paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def numbered(df: DataFrame, column: str = "row_id") -> DataFrame:
    """A number for every row, so that null and repeated ids stay separate rows.

    Only stable once the table is stored; use it right before `stored`.
    """
    return df.withColumn(column, F.monotonically_increasing_id())


def rows_of_files(df: DataFrame) -> DataFrame | None:
    """Each row as row, with the number row_id of its place in the files that `df` reads, which is the
    same each time it is read, so no copy of the rows is needed.

    None where `df` is not read from files, or has a row of a file more than once.
    """
    try:
        placed = df.select(F.struct("*").alias("row"), F.col("_metadata.file_path").alias("file"),
                           F.col("_metadata.row_index").alias("at"))
    except AnalysisException:
        return None
    files = stored(numbered(placed.select("file").distinct().coalesce(1), "file_no"), "files")
    rows = placed.join(files, "file").select(
        "row", (F.col("file_no") * (1 << 40) + F.col("at")).alias("row_id"))
    twice = rows.groupBy("row_id").count().filter("count > 1")
    return rows if twice.isEmpty() else None


def rows_in(batches: Iterator[pa.RecordBatch], size: int, limit_bytes: int,
            text: str = "text") -> Iterator[pa.Table]:
    """Regroup Arrow batches into tables of at most `size` rows and about `limit_bytes` of text.

    One text above the limit makes a table of its own; nothing is cut.
    """
    held: list[pa.RecordBatch] = []
    n = weight = 0

    def out():
        return pa.Table.from_batches(held)

    for batch in batches:
        start = 0
        at = batch.schema.get_field_index(text)
        lengths = batch.column(at).cast(pa.large_string()) if at >= 0 else None
        ends = None
        if lengths is not None:
            ends = memoryview(lengths.buffers()[1]).cast("q")
        base = lengths.offset if lengths is not None else 0
        for i in range(batch.num_rows):
            w = ends[base + i + 1] - ends[base + i] if ends is not None else 0
            if n and (n >= size or weight + w > limit_bytes):
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield out()
                held, n, weight, start = [], 0, 0, i
            n, weight = n + 1, weight + w
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if n:
        yield out()
