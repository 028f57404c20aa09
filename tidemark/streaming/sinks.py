"""Sinks. Every batch writer puts a batch in a folder named after it, so a repeated batch replaces
its first attempt and readers see each batch once."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..operators.aggregates import partial_sums
from ..operators.clean import latest_by_key
from ..operators.windows import hop_starts
from ..sources import paths
from .keyed import KeyedRuns
from .pipelines import without_zone


def run(stream: DataFrame, checkpoint: str, mode: str = "append", *,
        each: Callable[[DataFrame, int], None] | None = None, path: str | None = None,
        format: str = "parquet", partition_by: Sequence[str] = (), wait: bool = True,
        drop_late: bool = False, **options: str) -> StreamingQuery:
    """Start a query over everything available now, into a batch function or a file sink.

    Rows that come after the watermark in any batch stop the query and raise, so that none is lost
    unseen, unless `drop_late` says that they may be.
    """
    late = LateRows.of(stream.sparkSession)
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.options(**options).trigger(availableNow=True)
    if each is not None:
        query = writer.foreachBatch(each).start()
    else:
        writer = writer.format(format)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        query = writer.start(path)
    if wait:
        late.watch(query, drop_late)
    return query


class LateRows(StreamingQueryListener):
    """Counts the rows that watermarks excluded, in every batch of every query of a session.

    A query's own list of reports keeps the last hundred batches only."""

    _by_session: dict[str, LateRows] = {}

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.ended: set[str] = set()

    @classmethod
    def of(cls, spark: SparkSession) -> LateRows:
        """The session's listener, added the first time."""
        app = spark.sparkContext.applicationId
        if app not in cls._by_session:
            cls._by_session[app] = cls()
            spark.streams.addListener(cls._by_session[app])
        return cls._by_session[app]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run, p = str(event.progress.runId), event.progress
        self.batches[run] = self.batches.get(run, 0) + 1
        self.dropped[run] = self.dropped.get(run, 0) + sum(
            int(s.numRowsDroppedByWatermark) for s in p.stateOperators)

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def watch(self, query: StreamingQuery, drop_late: bool, patience: float = 30.0) -> None:
        """Wait for the query to end; stop it as soon as it has dropped a row that must not be."""
        run = str(query.runId)
        while not query.awaitTermination(1):
            if self.dropped.get(run, 0) and not drop_late:
                query.stop()
                break
        # reports come a little after the batch they are about
        until = time.monotonic() + patience
        while run not in self.ended and time.monotonic() < until:
            time.sleep(0.01)
        if self.dropped.get(run, 0) and not drop_late:
            raise RuntimeError(
                f"{self.dropped[run]} rows came after the watermark and were dropped")


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark excluded in all batches of the query so far."""
    return LateRows.of(SparkSession.active()).dropped.get(str(query.runId), 0)


def parquet_by_day(stream: DataFrame, path: str, checkpoint: str, ts: str) -> StreamingQuery:
    """Exactly-once Parquet folder partitioned by day."""
    dated = without_zone(stream.withColumn("dt", F.date_format(ts, "yyyy-MM-dd")))
    return run(dated, checkpoint, path=path, partition_by=["dt"])


def topic_rows(df: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    """Rows as (key, JSON value) for a topic, optionally filtered."""
    kept = df if where is None else df.filter(where)
    return kept.select(F.col(key).cast("string").alias("key"),
                       F.to_json(F.struct(*df.columns)).alias("value"))


def topic(stream: DataFrame, key: str, checkpoint: str, where: Column | None = None,
          format: str = "kafka", path: str | None = None, **options: str) -> StreamingQuery:
    return run(topic_rows(stream, key, where), checkpoint, format=format, path=path, **options)


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def append_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Every emitted row becomes a stored row: in update mode a log of a window's values."""
    def write(df: DataFrame, batch_id: int) -> None:
        without_zone(df).write.mode("overwrite").parquet(batch_path(path, batch_id))
    return write


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def pane_sums(path: str, keys: Sequence[str], pane: str, measure: str, ts: str = "ts",
              rows: Callable[[DataFrame, int], DataFrame] | None = None
              ) -> Callable[[DataFrame, int], None]:
    """Every batch is reduced to one row per key and pane of time before anything is kept: ``n`` and
    ``s``. Sums of a pane from several batches add up, so a window is the sum of its panes in all
    batches, and rows may come in any order. ``rows`` is applied to a batch first."""
    def write(df: DataFrame, batch_id: int) -> None:
        batch = without_zone(df)
        batch = batch if rows is None else rows(batch, batch_id)
        batch.groupBy(*keys, F.window(ts, pane).start.alias("pane")).agg(
            F.count("*").alias("n"), F.sum(measure).alias("s")).write.mode("overwrite").parquet(
            batch_path(path, batch_id))
    return write


def spread_panes(panes: DataFrame, keys: Sequence[str], slide: str, count: int) -> DataFrame:
    """Stored panes copied into the ``count`` windows that they belong to, dealt out by key and window.

    Panes are dense files: to aggregate where they are read, or in partitions merged by their packed
    size, would hold many millions of windows in a task. The number of partitions follows the rows.
    """
    tasks = max(int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                panes.count() * count // ROWS_PER_TASK)
    return panes.withColumn("window_start", F.explode(hop_starts("pane", slide, count))).repartition(
        tasks, *keys, "window_start")


#: rows of windows that a task aggregates
ROWS_PER_TASK = 1_000_000


def new_rows(path: str, delay: str, ts: str = "ts") -> Callable[[DataFrame, int], DataFrame]:
    """The distinct rows of a batch that were not in an earlier one.

    Rows come at most ``delay`` after later ones, so only the rows of the last ``delay`` are kept for
    the next batch; a row that is later than that is refused. Writes ``recent/`` and ``ends/``.
    """
    def pick(df: DataFrame, batch_id: int) -> DataFrame:
        spark, late = df.sparkSession, F.expr(f"INTERVAL {delay}")
        rows = df.withColumn("_time", F.col(ts).cast("timestamp_ntz")).dropDuplicates()
        seen = rows.agg(F.min("_time").alias("first"), F.max("_time").alias("last"))
        recent = None
        if batch_id:
            before = spark.read.parquet(batch_path(f"{path}/ends", batch_id - 1))
            recent = spark.read.schema(rows.schema).parquet(batch_path(f"{path}/recent", batch_id - 1))
            if seen.crossJoin(before.select(F.col("last").alias("mark"))).filter(
                    F.col("first") < F.col("mark") - late).count():
                raise RuntimeError("rows came after the watermark")
            rows = rows.alias("a").join(recent.alias("b"), [
                F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in rows.columns], "left_anti")
            seen = seen.select("first", "last").unionByName(before).agg(
                F.min("first").alias("first"), F.max("last").alias("last"))
        seen.write.mode("overwrite").parquet(batch_path(f"{path}/ends", batch_id))
        last = spark.read.parquet(batch_path(f"{path}/ends", batch_id)).first()["last"]
        border = F.lit(None if last is None else str(last)).cast("timestamp_ntz") - late
        # rows without a time are in no window, but may come again at any time
        kept = rows if recent is None else rows.unionByName(recent)
        kept.filter((F.col("_time") >= border) | F.col("_time").isNull()).write.mode(
            "overwrite").parquet(batch_path(f"{path}/recent", batch_id))
        return rows.drop("_time")
    return pick


def collapse_log(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Final values from an append-only log: the row of the greatest batch per key."""
    rest = [c for c in log.columns if c not in set(keys) | {"batch_id"}]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_last"))
    return last.select(*keys, "_last.*")


def fan_out(writers: Sequence[Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """One batch to several destinations; it is computed once."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            for w in writers:
                w(df, batch_id)
        finally:
            df.unpersist()
    return write


class UpsertTable:
    """A keyed table that takes a batch of changes at a time.

    A batch is folded to one change per key and stored as a run; runs are merged level by level (see
    ``keyed``), so a batch does not rewrite the table and readers fold few runs. ``order`` sorts the
    changes of a key and must continue across batches (an event time and an id). Deleted keys are
    forgotten once no older run is left below, so a change older than that must not arrive later.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str],
                 op: str = "op", **sizes: int):
        self.spark, self.path = spark, path
        self.keys, self.order, self.op = list(keys), list(order), op
        self.runs = KeyedRuns(spark, path, keys, self._last, lambda df: df.filter(
            F.col(op) != "D"), **sizes)

    def _last(self, log: DataFrame) -> DataFrame:
        return latest_by_key(log, self.keys, [*self.order, self.op])

    def write(self, df: DataFrame, batch_id: int) -> None:
        self.runs.put(self._last(without_zone(df)), batch_id)

    def read(self, before: int | None = None, of: DataFrame | None = None) -> DataFrame | None:
        """Current rows, of all keys or at least of those in ``of``; a batch that may be repeated asks
        for the state before itself. None while there was no batch."""
        last = self.runs.read(before, of)
        return None if last is None else last.filter(F.col(self.op) != "D").drop(self.op)

    def compact(self) -> int:
        """Merge everything into one run; returns the last batch it includes."""
        return self.runs.compact()


def key_ledger(spark: SparkSession, path: str, keys: Sequence[str], **sizes: int) -> KeyedRuns:
    """Keys that were dealt with, with a Bloom filter per run."""
    return KeyedRuns(spark, path, keys, bloom=True, **sizes)


def exactly_once(handle: Callable[[DataFrame], DataFrame], ledger: str, key: str = "id"
                 ) -> Callable[[DataFrame, int], None]:
    """Work through a stream of ids, each once, resuming after a crash.

    ``handle`` returns the rows it worked on; their ids go to the ledger under the batch. Bloom filters
    tell new ids from those that must be looked up, so the ledger is read in few places or none. A batch
    that is repeated leaves out its own earlier entry and replaces it.
    """
    def work(df: DataFrame, batch_id: int) -> None:
        done = key_ledger(df.sparkSession, ledger, [key])
        asked = df.select(key).distinct()
        todo = df.dropDuplicates([key]).join(done.known(asked, batch_id), key, "left_anti")
        done.put(handle(todo).select(key), batch_id)
    return work


def first_seen(path: str, keys: Sequence[str], order: Sequence[str], **sizes: int
               ) -> Callable[[DataFrame, int], None]:
    """Keeps the first row per key over a stream of any length, without a horizon.

    A batch is reduced to its first row per key before anything moves, and keys in the ledger are left
    out. Batches must come in order. Writes ``rows/`` and ``keys/``.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        spark, rows = df.sparkSession, without_zone(df)
        rest = [c for c in rows.columns if c not in {*keys, *order}]
        first = rows.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first")).select(
            *keys, "_first.*").select(*rows.columns)
        ledger = key_ledger(spark, f"{path}/keys", keys, **sizes)
        fresh = first.join(ledger.known(first.select(*keys), batch_id).withColumnsRenamed(
            {k: f"_{k}" for k in keys}), [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys],
            "left_anti")
        target = batch_path(f"{path}/rows", batch_id)
        fresh.write.mode("overwrite").parquet(target)
        ledger.put(spark.read.schema(rows.schema).parquet(target).select(*keys), batch_id)
    return write


class CommittedBatches:
    """Several tables that a batch writes together: readers see a batch in all of them or in none.

    Each table has a folder per batch; a marker named after the batch is written when all are complete,
    and readers only open folders with a marker. A batch that died half-way is written again and
    replaces both halves.
    """

    def __init__(self, spark: SparkSession, path: str, tables: Mapping[str, Callable[[DataFrame], DataFrame]]):
        self.spark, self.path, self.tables = spark, path, dict(tables)

    def write(self, df: DataFrame, batch_id: int) -> None:
        rows = without_zone(df).persist()
        try:
            for name, make in self.tables.items():
                make(rows).write.mode("overwrite").parquet(batch_path(f"{self.path}/{name}", batch_id))
            paths.write_text(self.spark, f"{self.path}/_committed/{batch_id}", "")
        finally:
            rows.unpersist()

    def committed(self) -> list[int]:
        return sorted(int(n) for n in paths.names(self.spark, f"{self.path}/_committed") if n.isdigit())

    def read(self, name: str) -> DataFrame | None:
        """Rows of the committed batches with their batch_id; None before the first."""
        folders = [batch_path(f"{self.path}/{name}", b) for b in self.committed()]
        if not folders:
            return None
        return self.spark.read.option("basePath", f"{self.path}/{name}").parquet(*folders)


def summary_and_rows(spark: SparkSession, path: str, keys: Sequence[str], measure: str, ts: str
                     ) -> CommittedBatches:
    """Raw rows and their partial sums per key, fed by the same inserts; ``merge_sums`` over the
    ``sums`` of all batches is the summary of the rows that readers of ``rows`` see."""
    return CommittedBatches(spark, path, {
        "rows": lambda df: df, "sums": lambda df: partial_sums(df, keys, measure, ts)})


# ---- batch file sinks ----------------------------------------------------------------------------

def export_json(claims: DataFrame, path: str, run_id: str) -> str:
    """Claimed rows as JSON lines in a folder per run; decimals and times become text."""
    safe = {f.name: F.col(f.name).cast("string") for f in claims.schema.fields
            if f.dataType.typeName() in ("decimal", "timestamp", "timestamp_ntz", "date")}
    target = f"{path}/run={run_id}"
    claims.withColumns(safe).write.mode("overwrite").json(target)
    return target


def csv_by_day(df: DataFrame, path: str, day: str = "en_date") -> None:
    """A CSV folder per day with header; only the days in ``df`` are replaced."""
    # rebalance gathers a day into few files and splits a day that is too large for one task
    (df.hint("rebalance", day).write.partitionBy(day).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("header", "true")
     .option("encoding", "UTF-8").csv(path))


def rewrite_files(spark: SparkSession, source: str, target: str, files: int,
                  row_group_bytes: int = 128 << 20, max_rows: int = 0) -> None:
    """Copy a Parquet folder into a chosen number of files (compaction of small ones)."""
    (spark.read.parquet(source).repartition(files).write.mode("overwrite")
     .option("parquet.block.size", str(row_group_bytes))
     .option("maxRecordsPerFile", str(max_rows)).parquet(target))
