"""Per-key state: change feeds, newest values, dimensions that change while a stream runs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import feed_from_log
from ..operators.clean import latest_by_key
from ..sources.paths import delete, names
from .keyed import KeyedRuns
from .pipelines import without_zone
from .sinks import UpsertTable, append_batches, batch_path

def change_feed_batches(spark: SparkSession, path: str, key: str, order: Sequence[str], value: str,
                        ) -> Callable[[DataFrame, int], None]:
    """The change feed by batch.

    The last value of every key is kept as an upsert table. A batch is the stored values of its keys'
    buckets plus its own rows, compared row by row; keys that hold much of the batch are cut into
    cells. Files must arrive in time order. Writes ``feed/`` and ``state/``.
    """
    table = UpsertTable(spark, f"{path}/state", [key], list(order))
    emit = append_batches(f"{path}/feed")

    def write(df: DataFrame, batch_id: int) -> None:
        # read for its keys, for its hot keys and for the feed
        rows = without_zone(df).select(key, *order, value).persist()
        try:
            log = rows.withColumn("known", F.lit(False))
            stored = table.read(batch_id, rows)
            if stored is not None:
                mine = stored.join(rows.select(key).distinct(), key, "left_semi")
                log = log.unionByName(mine.withColumn("known", F.lit(True)))
            emit(feed_from_log(log, [key], order, value, known="known"), batch_id)
            table.write(latest_by_key(rows, [key], order).withColumn("op", F.lit("U")), batch_id)
        finally:
            rows.unpersist()
    return write


def latest_rows(path: str, keys: Sequence[str], order: Sequence[str]
                ) -> Callable[[DataFrame, int], None]:
    """Newest row per key over a stream, skew-safe: each batch stores one row per key it touched.

    The batch is reduced by a max over a struct before anything is stored; readers reduce once more.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        latest_by_key(without_zone(df), keys, order).write.mode("overwrite").parquet(
            batch_path(path, batch_id))
    return write


def read_latest(spark: SparkSession, path: str, keys: Sequence[str],
                order: Sequence[str]) -> DataFrame:
    return latest_by_key(spark.read.parquet(path).drop("batch_id"), keys, order)


def enrich_with_current(read_dimension: Callable[[], DataFrame], key: str,
                        sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Join each batch with the dimension as it is then; later batches see later updates."""
    def write(df: DataFrame, batch_id: int) -> None:
        sink(df.join(read_dimension(), key, "left"), batch_id)
    return write


class LeftJoin:
    """Left rows with the right rows of their key, kept up to date batch by batch, without a time bound.

    A batch emits what it changes: rows that appear, and a retraction of the unmatched form of a left row
    when its first right row arrives. Both sides are stored by bucket of the key, and a batch reads the
    buckets of its own keys. The joins are ordinary ones of a batch with what it touches, so partitions
    of a hot key are split like those of any other skewed join. Writes ``left/``, ``right/`` and
    ``changes/`` (with ``sign`` 1 or -1).
    """

    def __init__(self, spark: SparkSession, path: str, key: str,
                 left: Callable[[DataFrame], DataFrame], right: Callable[[DataFrame], DataFrame],
                 **sizes: int):
        self.spark, self.path, self.key = spark, path, key
        self.sides = left, right
        self.left, self.right = (KeyedRuns(spark, f"{path}/{side}", [key], **sizes)
                                 for side in ("left", "right"))

    def write(self, df: DataFrame, batch_id: int) -> None:
        rows = without_zone(df).persist()
        try:
            left, right = (side(rows) for side in self.sides)
            ids = right.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
            old_left, old_right = self.left.read(batch_id, ids), self.right.read(batch_id, rows)
            every = right if old_right is None else old_right.unionByName(right)
            out = left.join(every, self.key, "left").withColumn("sign", F.lit(1))
            if old_left is not None:
                met = old_left.join(ids, self.key, "left_semi")
                out = out.unionByName(met.join(right, self.key).withColumn("sign", F.lit(1)))
                if old_right is not None:
                    met = met.join(old_right.select(self.key).distinct(), self.key, "left_anti")
                gone = met.withColumn("sign", F.lit(-1))
                out = out.unionByName(gone, allowMissingColumns=True)
            out.write.mode("overwrite").parquet(batch_path(f"{self.path}/changes", batch_id))
            self.left.put(left, batch_id)
            self.right.put(right, batch_id)
        finally:
            rows.unpersist()

    def changes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/changes")

    def read(self) -> DataFrame:
        """The join as it is now: rows that appeared less those taken back, equal rows as often as
        they are there. Only rows without anything from the right are ever taken back, so only those
        are counted; the others are as they were emitted."""
        log = self.changes().drop("batch_id")
        columns = [c for c in log.columns if c != "sign"]
        alone = F.lit(True)
        for c in self.right.columns():
            if c != self.key:
                alone &= F.col(c).isNull()
        net = log.filter(alone).groupBy(*columns).agg(F.sum("sign").alias("_n")).filter("_n > 0")
        net = net.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select(
            *columns)
        return log.filter(~alone).select(*columns).unionByName(net)


class JoinWithin:
    """Left rows with the right rows of their key that follow within an interval, batch by batch.

    The batches bring both sides in event-time order. What is kept between them is what can still meet:
    left rows whose interval has not passed, with a mark whether they met, and right rows of the last
    ``delay``. A batch joins its rows with these, emits the pairs and, alone, the left rows whose
    interval has passed unmet; ``finish`` emits the unmet rest. All joins are ordinary ones, so
    partitions of a hot key are split. A row earlier than the watermark is refused. Writes ``open/``,
    ``recent/``, ``ends/`` and ``out/``.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, within: str, delay: str,
                 left: Callable[[DataFrame], DataFrame], right: Callable[[DataFrame], DataFrame],
                 ts: str = "ts"):
        self.spark, self.path, self.key, self.ts = spark, path, key, ts
        self.within, self.delay = F.expr(f"INTERVAL {within}"), F.expr(f"INTERVAL {delay}")
        self.sides = left, right

    def _time(self, value) -> Column:
        return F.lit(None if value is None else str(value)).cast("timestamp_ntz")

    def _kept(self, name: str, batch_id: int) -> DataFrame:
        return self.spark.read.parquet(batch_path(f"{self.path}/{name}", batch_id))

    def _store(self, rows: DataFrame, name: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(batch_path(f"{self.path}/{name}", batch_id))

    def write(self, df: DataFrame, batch_id: int) -> None:
        rows = without_zone(df).withColumn(self.ts, F.col(self.ts).cast("timestamp_ntz"))
        mark = None
        left, right = (side(rows) for side in self.sides)
        right = right.withColumnRenamed(self.ts, "_right_ts")
        left = left.withColumns({"_met": F.lit(False), "_old": F.lit(False)})
        seen = rows.agg(F.min(self.ts).alias("first"), F.max(self.ts).alias("last"))
        if batch_id:
            mark = self._time(self._kept("ends", batch_id - 1).first()["last"])
            seen = seen.select("first", F.greatest("last", mark).alias("last"))
            left = left.unionByName(self._kept("open", batch_id - 1).withColumn("_old", F.lit(True)))
        self._store(seen.coalesce(1), "ends", batch_id)
        ends = self._kept("ends", batch_id)
        if mark is not None and ends.filter(F.col("first") < mark - self.delay).count():
            raise RuntimeError(f"rows of {ends.first()['first']} came after the watermark")
        fresh = right.withColumn("_new", F.lit(True))
        if batch_id:
            # an old pair was emitted before: new left rows meet kept right rows, all meet new ones
            fresh = fresh.unionByName(self._kept("recent", batch_id - 1).withColumn(
                "_new", F.lit(False)))
        numbered = left.withColumn("_row", F.monotonically_increasing_id())
        self._store(numbered, "left", batch_id)  # fixes the numbers
        numbered = self._kept("left", batch_id)
        pairs = numbered.join(fresh, self.key).filter(
            (F.col("_right_ts") >= F.col(self.ts))
            & (F.col("_right_ts") <= F.col(self.ts) + self.within)
            & (F.col("_new") | ~F.col("_old"))).drop("_old", "_new", self.ts, "_met", "_right_ts")
        self._store(pairs, "pairs", batch_id)
        pairs = self._kept("pairs", batch_id)
        after = numbered.join(pairs.select("_row").distinct().withColumn("_now", F.lit(True)), "_row",
                              "left").withColumn("_met", F.col("_met") | F.col("_now").isNotNull())
        closes = self._time(ends.first()["last"]) - self.delay
        passed = F.coalesce(F.col(self.ts) + self.within < closes, F.lit(True))
        alone = after.filter(passed & ~F.col("_met")).select(*[
            F.col(c) if c in after.columns else F.lit(None).cast(pairs.schema[c].dataType).alias(c)
            for c in pairs.columns])
        self._store(pairs.unionByName(alone).drop("_row"), "out", batch_id)
        self._store(after.filter(~passed).drop("_row", "_now", "_old"), "open", batch_id)
        self._store(fresh.filter(F.col("_right_ts") >= closes).drop("_new"), "recent", batch_id)
        for name in ("left", "pairs"):
            delete(self.spark, batch_path(f"{self.path}/{name}", batch_id))
        for name in ("open", "recent"):  # a repeated batch needs those of the one before
            delete(self.spark, batch_path(f"{self.path}/{name}", batch_id - 2))

    def finish(self) -> None:
        """The input has ended: left rows that are still open and unmet come out alone."""
        last = max(int(n.split("=")[1]) for n in names(self.spark, f"{self.path}/ends")
                   if n.startswith("batch_id="))
        out = self._kept("out", last)
        rest = self._kept("open", last).filter(~F.col("_met"))
        self._store(rest.select(*[
            F.col(c) if c in rest.columns else F.lit(None).cast(out.schema[c].dataType).alias(c)
            for c in out.columns]), "out", last + 1)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/out").drop("batch_id")
