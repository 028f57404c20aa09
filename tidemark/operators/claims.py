"""Work claiming without locks: a ledger of handled ids and disjoint hash buckets."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import paths


def pending(df: DataFrame, ledger: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Unprocessed rows that are in no earlier claim."""
    open_rows = df.filter(~F.col("processed"))
    if ledger is None:
        return open_rows
    return open_rows.join(ledger.select(key).distinct(), key, "left_anti")


def work_ready(df: DataFrame, threshold: int = 100) -> bool:
    """True when more than ``threshold`` rows wait; stops counting one row after that."""
    return pending(df).limit(threshold + 1).count() > threshold


def work_ready_report(df: DataFrame, threshold: int = 100) -> DataFrame:
    return pending(df).agg(F.count("*").alias("waiting")).select(
        "waiting", F.when(F.col("waiting") > threshold, 1).otherwise(0).alias("ready"))


def hash_bucket(key: str, workers: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(workers)).cast("int")


def claim_batch(waiting: DataFrame, workers: int, per_worker: int, key: str = "id",
                order: tuple[str, ...] = ("ts",), bucket: Column | None = None) -> DataFrame:
    """Up to ``per_worker`` oldest waiting rows for each worker; no row goes to two workers.

    A row belongs to the bucket of its id. Input partitions keep at most ``per_worker`` rows of a
    bucket before the shuffle.
    """
    rows = waiting.withColumn("worker", hash_bucket(key, workers) if bucket is None else bucket)
    w = Window.partitionBy("worker").orderBy(*order, key)
    return (rows.withColumn("position", F.row_number().over(w))
            .filter(F.col("position") <= per_worker))


def mark_processed(df: DataFrame, claims: DataFrame, key: str = "id") -> DataFrame:
    """The table with exactly the claimed rows flagged; applying it again changes nothing."""
    done = claims.select(key).distinct().withColumn("_claimed", F.lit(True))
    flag = F.col("processed") | F.coalesce(F.col("_claimed"), F.lit(False))
    return df.join(done, key, "left").withColumn("processed", flag).drop("_claimed")


def double_processing(ledger: DataFrame, key: str = "id", run: str = "run") -> DataFrame:
    """Ids that more than one run handled."""
    return (ledger.groupBy(key).agg(F.count_distinct(run).alias("runs"),
                                    F.count("*").alias("entries"))
            .filter(F.col("runs") > 1))


class ClaimLog:
    """Claims of several claimers who share nothing but a folder.

    A claim is written under a name of its own and becomes claim number n by creating the file ``n`` of
    the log, which the file system lets only one claimer do. Whoever is second reads the winner's claim,
    picks again from what is left and tries the next number; so claims never share an id.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "id"):
        self.spark, self.path, self.key = spark, path, key

    def _log(self) -> list[int]:
        return sorted(int(n) for n in paths.names(self.spark, f"{self.path}/_log") if n.isdigit())

    def read(self, upto: int | None = None) -> DataFrame | None:
        """Rows of all claims (up to a number); None while there is none."""
        numbers = [n for n in self._log() if upto is None or n <= upto]
        if not numbers:
            return None
        return self.spark.read.parquet(*[
            f"{self.path}/{json.loads(paths.read_text(self.spark, f'{self.path}/_log/{n}'))['claim']}"
            for n in numbers])

    def claim(self, waiting: DataFrame, pick: Callable[[DataFrame], DataFrame],
              seen: int | None = None) -> tuple[int, DataFrame]:
        """Claim what ``pick`` takes of the rows that no claim has; gives the claim's number and rows.

        ``seen`` is the number of the last claim that the claimer knows of (by default it looks)."""
        last = max(self._log(), default=0) if seen is None else seen
        while True:
            name = f"claim-{uuid.uuid4().hex}"
            pick(pending(waiting, self.read(last) if last else None, self.key)).write.parquet(
                f"{self.path}/{name}")
            if paths.create_once(self.spark, f"{self.path}/_log/{last + 1}",
                                 json.dumps({"claim": name})):
                return last + 1, self.spark.read.parquet(f"{self.path}/{name}")
            paths.delete(self.spark, f"{self.path}/{name}")
            last += 1
