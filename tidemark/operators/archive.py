"""A table split by year over several places, read and maintained as one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Partition:
    """One partition: rows with ``start <= time < end`` in some store."""
    name: str
    start: str
    end: str
    storage: str = "local"

    def holds(self, time: str | Column = "time") -> Column:
        t = F.col(time) if isinstance(time, str) else time
        return (t >= F.lit(self.start).cast("timestamp_ntz")) & (
            t < F.lit(self.end).cast("timestamp_ntz"))


#: rows that no other partition takes, those without a time among them
DEFAULT = "default"


def yearly(prefix: str, years: Sequence[int], hot_from: int) -> list[Partition]:
    """One partition per year; years before ``hot_from`` live in the archive."""
    return [Partition(f"{prefix}_{y}", f"{y}-01-01", f"{y + 1}-01-01",
                      "local" if y >= hot_from else "archive") for y in years]


def archive_union(branches: Mapping[Partition, DataFrame], time: str = "time") -> DataFrame:
    """One logical table over partition readers.

    Every branch carries its bound as a filter. A query on ``time`` is pushed into each branch,
    next to the bound; the two contradict each other in branches outside, which then read no rows.
    """
    out = None
    for part, df in branches.items():
        branch = df.filter(part.holds(time)).withColumns(
            {"partition": F.lit(part.name), "storage": F.lit(part.storage)})
        out = branch if out is None else out.unionByName(branch)
    return out


def years_of(df: DataFrame, time: str = "time") -> range:
    """The years from the first to the last row; empty for a table without times."""
    row = df.agg(F.min(F.year(time)).alias("low"), F.max(F.year(time)).alias("high")).first()
    return range(0) if row["low"] is None else range(row["low"], row["high"] + 1)


def rest_of(df: DataFrame, partitions: Sequence[Partition], time: str = "time") -> DataFrame:
    """Rows of the default partition: no partition holds their time, or they have none."""
    return rows_out_of_bounds(df, partitions, time).withColumns(
        {"partition": F.lit(DEFAULT), "storage": F.lit(DEFAULT)})


def label_partitions(df: DataFrame, partitions: Sequence[Partition],
                     time: str = "time") -> DataFrame:
    """Partition and storage of each row of a single store, in one scan; DEFAULT outside all."""
    name, storage = F.lit(DEFAULT), F.lit(DEFAULT)
    for p in reversed(partitions):
        name = F.when(p.holds(time), p.name).otherwise(name)
        storage = F.when(p.holds(time), p.storage).otherwise(storage)
    return df.withColumns({"partition": name, "storage": storage})


def label_years(df: DataFrame, prefix: str, hot_from: int, time: str = "time") -> DataFrame:
    """Partition and storage where every year has a partition, from the row's own time.

    Needs no list of years, so no job runs before the query; a row without a time is in DEFAULT."""
    year = F.year(time)
    return df.withColumns({
        "partition": F.coalesce(F.concat(F.lit(f"{prefix}_"), year.cast("string")), F.lit(DEFAULT)),
        "storage": F.when(year.isNull(), DEFAULT).when(year >= hot_from, "local").otherwise("archive")})


def archive_health(union: DataFrame, time: str = "time") -> DataFrame:
    return union.groupBy("partition", "storage").agg(
        F.count("*").alias("row_count"), F.min(time).alias("earliest"),
        F.max(time).alias("latest"))


def route_by_time(df: DataFrame, path: str, time: str = "time") -> None:
    """Append rows to the folder of their year; a large year is written by several tasks."""
    with_year = df.withColumn("year", F.year(time)).hint("rebalance", "year")
    with_year.write.partitionBy("year").mode("append").parquet(path)


def content_check(df: DataFrame, columns: Sequence[str]) -> tuple[int, int]:
    """Row count and an order-independent checksum of the rows, NULLs included."""
    seen = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    row = df.agg(F.count("*").alias("n"),
                 F.coalesce(F.sum(F.xxhash64(*seen).cast("decimal(38,0)")), F.lit(0))
                 .alias("c")).first()
    return row["n"], int(row["c"])


def migrate_partitions(spark: SparkSession, hot: str, cold: str, years: Column) -> DataFrame:
    """Copy all years that the condition on ``year`` names to the archive and compare; gives year and
    row_count of what was moved.

    One job copies every year and one compares them, grouped by year, however many there are. The hot
    copies are not deleted here: the caller takes them out of its registry and retires them. A second
    run replaces the copies, so a failed run can be repeated.
    """
    source = spark.read.parquet(hot).filter(years)
    (source.hint("rebalance", "year").write.partitionBy("year").mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(cold))
    copied = spark.read.schema(source.schema).parquet(cold).filter(years)

    def contents(df, name):
        seen = [x for c in df.columns for x in (F.col(c).isNull(), F.col(c))]
        return df.groupBy("year").agg(F.struct(
            F.count("*").alias("n"), F.sum(F.xxhash64(*seen).cast("decimal(38,0)")).alias("c")
        ).alias(name))

    both = contents(source, "before").join(contents(copied, "after"), "year", "full_outer")
    # one row per year
    compared = both.select("year", "before.n", F.col("before").eqNullSafe(F.col("after")).alias("same")
                           ).collect()
    differ = sorted(r["year"] for r in compared if not r["same"])
    if differ:
        raise RuntimeError(f"copies of {differ} differ")
    return spark.createDataFrame([(r["year"], r["n"]) for r in compared], "year int, row_count long")


def migrate_partition(spark: SparkSession, hot: str, cold: str, year: int) -> int:
    """Copy one year; returns the rows moved."""
    moved = migrate_partitions(spark, hot, cold, F.col("year") == year).first()
    return moved["row_count"] if moved else 0


def retire_partition(partitions: Sequence[Partition], name: str) -> list[Partition]:
    """The registry without a partition; removing its files is left to the caller."""
    left = [p for p in partitions if p.name != name]
    if len(left) == len(partitions):
        raise KeyError(name)
    return left


def bound_problems(partitions: Sequence[Partition]) -> list[tuple[str, str]]:
    """Empty ranges, gaps and overlaps in a registry of bounds, as (partition, problem)."""
    problems, reach = [], None
    for p in sorted(partitions, key=lambda p: (p.start, p.end, p.name)):
        if p.start >= p.end:
            problems.append((p.name, "empty range"))
            continue
        if reach is not None and p.start != reach:
            problems.append((p.name, "gap before" if p.start > reach else "overlap"))
        reach = p.end if reach is None else max(reach, p.end)
    return problems


def rows_out_of_bounds(df: DataFrame, partitions: Sequence[Partition],
                       time: str = "time") -> DataFrame:
    """Rows that no partition would accept."""
    inside = F.lit(False)
    for p in partitions:
        inside = inside | p.holds(time)
    return df.filter(~F.coalesce(inside, F.lit(False)))


def missing_periods(df: DataFrame, unit: str, start: str | None = None, end: str | None = None,
                    time: str = "time") -> DataFrame:
    """Periods without any row between two times, by default the table's first and last."""
    def edge(given, found):
        return F.lit(given).cast("timestamp_ntz") if given else F.date_trunc(
            unit, found(time)).cast("timestamp_ntz")

    spine = df.agg(edge(start, F.min).alias("low"), edge(end, F.max).alias("high")).filter(
        "low is not null").select(F.explode(F.sequence(
            "low", "high", F.expr(f"INTERVAL 1 {unit.upper()}"))).alias("period"))
    seen = df.select(F.date_trunc(unit, time).cast("timestamp_ntz").alias("period")).distinct()
    return spine.join(seen, "period", "left_anti")
