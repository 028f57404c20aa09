"""Versions of a table as sets of files: changes rewrite only the files they touch, and two versions
are compared only in the files they do not share.

A version is a small file that names its data files with their row counts and least and greatest keys.
Data files are never changed. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import paths
from . import versions




class FileVersions:
    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path, key

    # ---- reading -------------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in paths.names(self.spark, f"{self.path}/_versions")
                      if n.endswith(".json") and n[:-5].isdigit())

    def _state(self, version: int | None = None) -> dict:
        version = self.versions()[-1] if version is None else version
        return json.loads(paths.read_text(self.spark, f"{self.path}/_versions/{version}.json"))

    def files(self, version: int | None = None) -> list[dict]:
        """path, rows, low, high of every data file: no data is read."""
        return self._state(version)["files"]

    def _open(self, files: Sequence[dict], schema: T.StructType) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f["path"] for f in files])

    def read(self, version: int | None = None) -> DataFrame:
        state = self._state(version)
        return self._open(state["files"], T.StructType.fromJson(state["schema"]))

    # ---- writing -------------------------------------------------------------------------------------

    def _written(self, df: DataFrame) -> list[dict]:
        """Write rows as new files; one row per file comes back, from the key column alone."""
        target = f"{self.path}/data/{uuid.uuid4().hex}"
        df.write.parquet(target)
        found = self.spark.read.schema(df.schema).parquet(target).groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(self.key).cast("string").alias("low"),
            F.max(self.key).cast("string").alias("high"))
        return [r.asDict() for r in found.collect()]

    def _commit(self, files: list[dict], schema: T.StructType) -> int:
        version = max(self.versions(), default=0) + 1
        paths.write_text(self.spark, f"{self.path}/_versions/{version}.json", json.dumps(
            {"files": files, "schema": json.loads(schema.json())}))
        return version

    def create(self, df: DataFrame, files: int | None = None) -> int:
        """The first version, in ranges of the key, so that a change of some keys touches few files."""
        ranged = df.repartitionByRange(files, self.key) if files else df.repartitionByRange(self.key)
        return self._commit(self._written(ranged), df.schema)

    def append(self, df: DataFrame) -> int:
        return self._commit([*self.files(), *self._written(df)], df.schema)

    def _rewrite(self, where: Column, change) -> int:
        """A new version in which only the files that hold such rows are replaced."""
        state = self._state()
        schema = T.StructType.fromJson(state["schema"])
        hit = {r["path"] for r in self._open(state["files"], schema).filter(where).select(
            F.col("_metadata.file_path").alias("path")).distinct().collect()}
        touched = [f for f in state["files"] if f["path"] in hit]
        kept = [f for f in state["files"] if f["path"] not in hit]
        if touched:
            kept += self._written(change(self._open(touched, schema)))
        return self._commit(kept, schema)

    def update(self, where: Column, assignments: Mapping[str, Column]) -> int:
        return self._rewrite(where, lambda df: versions.update_rows(df, where, assignments))

    def delete(self, where: Column) -> int:
        return self._rewrite(where, lambda df: versions.delete_rows(df, where))

    # ---- comparing -----------------------------------------------------------------------------------

    def unshared(self, old: int, new: int) -> tuple[list[dict], list[dict]]:
        """The files that only one of two versions has."""
        a, b = self.files(old), self.files(new)
        both = {f["path"] for f in a} & {f["path"] for f in b}
        return ([f for f in a if f["path"] not in both], [f for f in b if f["path"] not in both])

    def diff(self, old: int, new: int, values: Sequence[str]) -> DataFrame:
        """Keys inserted, deleted or updated between two versions; shared files are not opened."""
        schema = T.StructType.fromJson(self._state(new)["schema"])
        a, b = (self._open(files, schema) for files in self.unshared(old, new))
        return versions.snapshot_diff(a, b, [self.key], values)
