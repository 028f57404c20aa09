"""Versioned Parquet datasets: append-only version folders, as-of reads, diffs.

A dataset is a folder with ``data/v=N/`` and one small JSON file per version below ``manifest/``, which
also holds the schema. One writer at a time; a version exists once its manifest file does, so a writer
that dies leaves a folder nobody reads. Manifests are read through the file system, so a reader starts
no Spark job before the query itself.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST_SCHEMA = "v int, files long, bytes long, row_count long, committed_at timestamp_ntz"


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path as that file system's object."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _manifests(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Version number and file of every committed version, from one listing."""
    fs, at = _folder(spark, f"{path}/manifest")
    if not fs.exists(at):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    return sorted((int(n[2:-5]), f"{path}/manifest/{n}") for n in names
                  if n.startswith("v=") and n.endswith(".json"))


def list_versions(spark: SparkSession, path: str) -> DataFrame:
    """Committed versions with row counts, from the manifests only."""
    found = [f for _, f in _manifests(spark, path)]
    if not found:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).json(found)


def last_version(spark: SparkSession, path: str) -> int:
    """Newest committed version, 0 when there is none."""
    return max((v for v, _ in _manifests(spark, path)), default=0)


def write_version(df: DataFrame, path: str) -> int:
    """Append the rows as the next version and return its number.

    Rows are counted while they are written; the files are only listed afterwards. The manifest gets
    its name when it is complete.
    """
    spark = df.sparkSession
    v = last_version(spark, path) + 1
    target = f"{path}/data/v={v}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(target)
    fs, at = _folder(spark, target)
    sizes = [f.getLen() for f in fs.listStatus(at) if f.getPath().getName().endswith(".parquet")]
    line = json.dumps({
        "v": v, "files": len(sizes), "bytes": sum(sizes), "row_count": seen.get["rows"],
        "committed_at": datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%S.%f"),
        "schema": df.schema.json()})
    _, draft = _folder(spark, f"{path}/manifest/_v={v}")
    out = fs.create(draft, True)
    out.write(bytearray(line.encode()))
    out.close()
    fs.rename(draft, _folder(spark, f"{path}/manifest/v={v}.json")[1])
    return v


def read_versions(spark: SparkSession, path: str, after: int = 0, upto: int | None = None
                  ) -> DataFrame:
    """Rows of the committed versions in (after, upto], with their version v.

    Only their folders are listed and read, with the schema of the newest of them.
    """
    asked = [(v, f) for v, f in _manifests(spark, path) if v > after and (upto is None or v <= upto)]
    if not asked:
        every = _manifests(spark, path)
        schema = _schema(spark, every[-1][1]) if every else T.StructType()
        return spark.createDataFrame([], schema.add("v", T.IntegerType()))
    schema = _schema(spark, asked[-1][1]).add("v", T.IntegerType())
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(
        *[f"{path}/data/v={v}" for v, _ in asked])


def _schema(spark: SparkSession, manifest: str) -> T.StructType:
    fs, at = _folder(spark, manifest)
    stream = fs.open(at)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return T.StructType.fromJson(json.loads(json.loads(text)["schema"]))


def read_as_of(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of all versions up to the given one."""
    return read_versions(spark, path, 0, version)


def added_since(spark: SparkSession, path: str, old: int, new: int | None = None) -> DataFrame:
    """Rows that came after one version up to another, reading nothing else."""
    return read_versions(spark, path, old, new)


def visible_at(versions: DataFrame, version: int) -> DataFrame:
    return versions.filter(F.col("v") <= version)


def added_between(versions: DataFrame, old: int, new: int) -> DataFrame:
    """Rows that came after one version up to another. Versions only append, so the folders between
    the two are the whole change and nothing else is read."""
    return versions.filter((F.col("v") > old) & (F.col("v") <= new))


def version_counts(versions: DataFrame, at: Sequence[int]) -> DataFrame:
    """Rows visible at each of some versions, from one scan: counts per version are added up."""
    per = versions.groupBy("v").agg(F.count("*").alias("n"), F.sum("value").alias("s"))
    ats = F.array(*[F.lit(int(v)) for v in at])
    visible = per.select(F.explode(F.filter(ats, lambda a: a >= F.col("v"))).alias("version"),
                         "n", "s")
    return visible.groupBy("version").agg(
        F.sum("n").alias("row_count"), F.sum("s").alias("total_value"))


def version_sizes(versions: DataFrame) -> DataFrame:
    return versions.groupBy("v").agg(F.count("*").alias("row_count"))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str],
                  values: Sequence[str]) -> DataFrame:
    """Keys that were inserted, deleted or updated between two states.

    Each side is reduced to its key and one hash before the join. Equal hashes are compared
    column by column nowhere, so two independent 64-bit hashes guard against a collision. The hash
    function skips NULLs, so each value goes in with a flag that says whether it is one.
    """
    def side(df, name):
        seen = [x for v in values for x in (F.col(v).isNull(), F.col(v))]
        digest = F.struct(F.xxhash64(*seen), F.xxhash64(F.lit("salt"), *seen))
        return df.select(*keys, digest.alias(name))

    both = side(old, "_old").join(side(new, "_new"), list(keys), "full_outer")
    kind = (F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete")
            .when(F.col("_old") != F.col("_new"), "update"))
    return both.select(*keys, kind.alias("change")).filter(F.col("change").isNotNull())


def diff_counts(diff: DataFrame) -> DataFrame:
    return diff.groupBy("change").agg(F.count("*").alias("row_count"))


def update_rows(df: DataFrame, where: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """UPDATE as a projection; a column keeps its type."""
    return df.withColumns({
        c: F.when(where, v).otherwise(F.col(c)).cast(df.schema[c].dataType)
        for c, v in assignments.items()})


def delete_rows(df: DataFrame, where: Column) -> DataFrame:
    """DELETE as a filter; rows for which the condition is NULL stay."""
    return df.filter(~F.coalesce(where, F.lit(False)))
