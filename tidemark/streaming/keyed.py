"""Rows by key that grow batch by batch, in runs that are merged level by level.

A batch writes one run, a folder with a part per bucket of the key's hash. Whenever ``FAN`` runs of one
level have gathered, they are merged into one of the next level, so a row is rewritten once per level: the
work of a batch grows with the batch and with the logarithm of the number of batches, not with the table.
Readers fold the few runs that are left, and read only the buckets that their keys fall into.

Which runs make up the table after a batch is one small file named after the batch, written last. A batch
that is repeated starts from the file of the batch before it, and the runs that one names are kept until
the next batch has been written.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.paths import delete, names, read_text, write_text

BUCKETS, FAN = 64, 4
#: bits of a Bloom filter per key, probes per key, bits of one of its blocks
BITS, PROBES, BLOCK_BITS = 10, 4, 32_768


@dataclass(frozen=True)
class Run:
    level: int
    first: int
    last: int
    blocks: int = 0

    @property
    def name(self) -> str:
        return f"run={self.first}-{self.last}"


class KeyedRuns:
    """``fold`` turns the rows of several runs into what they mean together (by default all of them);
    ``settle`` is applied when nothing older is left below, and may drop markers of deleted keys."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str],
                 fold: Callable[[DataFrame], DataFrame] | None = None,
                 settle: Callable[[DataFrame], DataFrame] | None = None,
                 bloom: bool = False, buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.fold, self.settle, self.bloom = fold or (lambda df: df), settle, bloom
        self.buckets, self.fan = buckets, fan

    # ---- what there is -------------------------------------------------------------------------------

    def _manifests(self) -> list[int]:
        return sorted(int(n[:-5]) for n in names(self.spark, f"{self.path}/_manifest")
                      if n.endswith(".json") and n[:-5].isdigit())

    def _state(self, before: int | None) -> tuple[list[Run], T.StructType | None]:
        known = [b for b in self._manifests() if before is None or b < before]
        if not known:
            return [], None
        state = json.loads(read_text(self.spark, f"{self.path}/_manifest/{known[-1]}.json"))
        return [Run(**r) for r in state["runs"]], T.StructType.fromJson(state["schema"])

    def runs(self, before: int | None = None) -> list[Run]:
        return self._state(before)[0]

    def columns(self) -> list[str]:
        schema = self._state(None)[1]
        return schema.fieldNames() if schema is not None else []

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of some rows' keys: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def _read(self, runs: Sequence[Run], schema: T.StructType,
              buckets: Sequence[int] | None = None) -> DataFrame:
        if not runs or (buckets is not None and not buckets):
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        df = self.spark.read.schema(full).option("basePath", self.path).parquet(
            *[f"{self.path}/{r.name}" for r in runs])
        if buckets is not None and len(buckets) < self.buckets:
            df = df.filter(F.col("bucket").isin(list(buckets)))
        return df.select(*schema.fieldNames())

    def read(self, before: int | None = None, of: DataFrame | None = None) -> DataFrame | None:
        """The folded rows, of all keys or of the buckets that the keys of ``of`` fall into; a batch
        that may be repeated asks for those before itself. None while nothing was ever written."""
        runs, schema = self._state(before)
        if schema is None:
            return None
        return self.fold(self._read(runs, schema, None if of is None else self.touched(of)))

    # ---- writing -------------------------------------------------------------------------------------

    def _write(self, df: DataFrame, run: Run) -> Run:
        seen = Observation()
        rows = df.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy("bucket").mode(
            "overwrite").parquet(f"{self.path}/{run.name}")
        if not self.bloom:
            return run
        run = Run(run.level, run.first, run.last, max(1, -(-seen.get["n"] * BITS // BLOCK_BITS)))
        written = self._read([run], df.schema).select(*self.keys)
        bits = written.select(self._block(run), F.explode(F.array(*self._bits())).alias("bit"))
        bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")).write.mode(
            "overwrite").parquet(f"{self.path}/_bloom/{run.name}")
        return run

    def put(self, rows: DataFrame, batch: int) -> None:
        """Add a batch; repeating it replaces what it wrote."""
        runs, schema = self._state(batch)
        before, schema = list(runs), rows.schema
        runs.append(self._write(rows, Run(0, batch, batch)))
        while len(runs) >= self.fan and len({r.level for r in runs[-self.fan:]}) == 1:
            tail = runs[-self.fan:]
            runs = [*runs[:-self.fan], self._merge(tail, schema, bottom=len(runs) == self.fan)]
        self._publish(runs, schema, batch, before)

    def _merge(self, tail: Sequence[Run], schema: T.StructType, bottom: bool) -> Run:
        both = self.fold(self._read(tail, schema)).select(*schema.fieldNames())
        if bottom and self.settle is not None:
            both = self.settle(both)
        return self._write(both, Run(max(r.level for r in tail) + 1, tail[0].first, tail[-1].last))

    def _publish(self, runs: list[Run], schema: T.StructType, batch: int, before: list[Run]) -> None:
        write_text(self.spark, f"{self.path}/_manifest/{batch}.json", json.dumps(
            {"runs": [asdict(r) for r in runs], "schema": json.loads(schema.json())}))
        kept = {r.name for r in (*runs, *before)}
        for name in names(self.spark, self.path):
            if name.startswith("run=") and name not in kept and int(name.split("-")[1]) <= batch:
                delete(self.spark, f"{self.path}/{name}")
                delete(self.spark, f"{self.path}/_bloom/{name}")
        for old in [b for b in self._manifests() if b < batch][:-1]:
            delete(self.spark, f"{self.path}/_manifest/{old}.json")

    def compact(self) -> int:
        """Merge all runs into one; returns the last batch it includes."""
        runs, schema = self._state(None)
        last = self._manifests()[-1]
        if len(runs) > 1:
            self._publish([self._merge(runs, schema, bottom=True)], schema, last, runs)
        return last

    # ---- membership ----------------------------------------------------------------------------------

    def _block(self, run: Run) -> Column:
        return F.pmod(F.xxhash64(F.lit(0), *self.keys), F.lit(run.blocks)).alias("block")

    def _bits(self) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(i + 1), *self.keys), F.lit(BLOCK_BITS)).cast("long")
                for i in range(PROBES)]

    def maybe(self, asked: DataFrame, run: Run) -> DataFrame:
        """The keys that a run's Bloom filter does not rule out."""
        filters = self.spark.read.schema("block long, bits binary").parquet(
            f"{self.path}/_bloom/{run.name}")
        hit = F.lit(True)
        for bit in self._bits():
            byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(bit / 8).cast("int") + 1,
                                            F.lit(1))), 16, 10).cast("int")
            mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]),
                                (bit % 8).cast("int") + 1)
            hit &= byte.bitwiseAND(mask) != 0
        return asked.withColumn("block", self._block(run)).join(filters, "block").filter(hit).select(
            *self.keys)

    def known(self, asked: DataFrame, before: int | None = None) -> DataFrame:
        """Which of some distinct keys are in the table. A run is only read in the buckets of the keys
        that its filter lets through; mostly that is none."""
        runs, schema = self._state(before)
        out = self.spark.createDataFrame([], asked.schema)
        for run in runs:
            maybe = self.maybe(asked, run)
            buckets = self.touched(maybe)
            if buckets:
                inside = self._read([run], schema, buckets).select(*self.keys)
                inside = inside.withColumnsRenamed({k: f"_{k}" for k in self.keys})
                same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
                out = out.unionByName(maybe.join(inside, same, "left_semi"))
        return out
