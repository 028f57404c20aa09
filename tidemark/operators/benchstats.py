"""Statistics of benchmark runs: latency summaries, run aggregation, comparisons, scorecards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.means import mean_of_doubles
from ..functions.quantiles import MEDIAN, at_position, picked, ranked


def _median(value: str) -> Column:
    """Mean of the two middle values, over cumulative counts."""
    low = at_position(value, F.floor((F.col("total") - 1) / 2))
    high = at_position(value, F.floor(F.col("total") / 2))
    return (low + high) / 2


def span_seconds(ts: str = "ts") -> Column:
    """Wall time of a run from the times of its operations, as an aggregate."""
    return F.timestamp_diff("SECOND", F.min(ts), F.max(ts)).cast("double")


def latency_summary(results: DataFrame, keys: Sequence[str],
                    wall: Column | None = None) -> DataFrame:
    """Mean, percentiles by rank, extremes, deviation and MB/s of the successful operations.

    ``results`` has success, time_sec and size_mb. ``wall`` is the wall time of a run as an
    aggregate; by default the greatest ``wall_time_sec`` of its rows.
    """
    wall = F.max("wall_time_sec") if wall is None else wall
    keys = list(keys)
    ok = F.col("success")
    good = lambda c: F.when(ok, F.col(c))
    base = results.groupBy(*keys).agg(
        F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum(good("size_mb")), F.lit(0)).alias("total_data_mb"),
        wall.alias("wall_time_sec"),
        mean_of_doubles(good("time_sec")).alias("latency_mean"),
        F.min(good("time_sec")).alias("latency_min"),
        F.max(good("time_sec")).alias("latency_max"),
        F.round(F.coalesce(F.stddev_samp(good("time_sec")),
                           F.when(F.count_if(ok) == 1, F.lit(0.0))), 4).alias("latency_stdev"))
    ranks = picked(results.filter(ok), keys, "time_sec", {
        "latency_p50": MEDIAN, "latency_p95": ranked(0.95),
        "latency_p99": ranked(0.99, clamp=True)}).drop("total").withColumn(
        "latency_p50", F.round("latency_p50", 4))
    rate = F.when(F.col("wall_time_sec") > 0, F.col("total_data_mb") / F.col("wall_time_sec"))
    return base.join(ranks, keys, "left").withColumn(
        "throughput_mbps", F.round(F.coalesce(rate, F.lit(0.0)), 4))


def unpivot(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                      for m in metrics])
    return df.select(*keys, F.inline(pairs))


def aggregate_runs(runs: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Mean and deviation of every metric over the runs of a key; one run has deviation 0."""
    long = unpivot(runs, keys, metrics).filter(F.col("value").isNotNull())
    return long.groupBy(*keys, "metric").agg(
        F.count("*").alias("num_runs"), mean_of_doubles("value").alias("mean"),
        F.round(F.coalesce(F.stddev_samp("value"), F.lit(0.0)), 4).alias("stdev"))


def heavy_mix(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Concurrent reads and writes of a run: counts, success rates, p50 and p99 per kind."""
    keys = list(keys)
    ok, w = F.col("success"), F.col("op") == "write"

    def rate(kind):
        return F.round(F.coalesce(F.count_if(kind & ok) / F.nullif(F.count_if(kind), F.lit(0)),
                                  F.lit(0.0)), 4)

    base = results.groupBy(*keys).agg(
        F.count_if(w).alias("num_writes"), F.count_if(~w).alias("num_reads"),
        F.coalesce(F.sum(F.when(ok, F.col("size_mb"))), F.lit(0)).alias("total_data_mb"),
        rate(w).alias("write_success_rate"), rate(~w).alias("read_success_rate"))
    per_op = picked(results.filter(ok), [*keys, "op"], "time_sec",
                    {"p50": MEDIAN, "p99": ranked(0.99, clamp=True)})

    def pick(op, c):
        return F.round(F.coalesce(F.max(F.when(F.col("op") == op, F.col(c))), F.lit(0.0)), 4)

    ranks = per_op.groupBy(*keys).agg(
        pick("write", "p50").alias("write_latency_p50"),
        pick("read", "p50").alias("read_latency_p50"),
        pick("write", "p99").alias("write_latency_p99"),
        pick("read", "p99").alias("read_latency_p99"))
    return base.join(ranks, keys, "left").na.fill(0.0, [
        "write_latency_p50", "read_latency_p50", "write_latency_p99", "read_latency_p99"])


def driver_compare(runs: DataFrame, by: Sequence[str], first: str, second: str,
                   driver: str = "driver", value: str = "avg") -> DataFrame:
    """Mean of averages of two drivers, the faster one, and its lead as a share of the slower."""
    def avg_of(name):
        return mean_of_doubles(F.when(F.lower(driver) == name, F.col(value)))

    pair = runs.groupBy(*by).agg(avg_of(first).alias("first_mean"),
                                 avg_of(second).alias("second_mean"))
    a, b = F.col("first_mean"), F.col("second_mean")
    return pair.filter(a.isNotNull() & b.isNotNull()).withColumns({
        "winner": F.when(b < a, second).otherwise(first),
        "lead_pct": F.round(F.abs(a - b) / F.greatest(a, b) * 100, 1)})


def fetch_rates(fetches: DataFrame, first: str, second: str) -> DataFrame:
    """Rows per second per fetch size for two drivers and their ratio."""
    def secs(name):
        return mean_of_doubles(F.when(F.col("driver") == name, F.col("secs")), digits=9)

    per = fetches.groupBy("rows").agg(secs(first).alias("s1"), secs(second).alias("s2"))

    def rate(c):
        return F.when(c > 0, F.col("rows") / c)

    r1, r2 = rate(F.col("s1")), rate(F.col("s2"))
    return per.filter(F.col("s1").isNotNull() & F.col("s2").isNotNull()).select(
        "rows", F.round("s1", 4).alias("first_secs"), F.round("s2", 4).alias("second_secs"),
        F.round(r1, 2).alias("first_rate"), F.round(r2, 2).alias("second_rate"),
        F.round(r2 / r1, 4).alias("ratio"))


def scorecard(summary: DataFrame, target: str, categories: Mapping[str, tuple[str, bool]],
              by: Sequence[str] = ()) -> DataFrame:
    """Wins per target. A category is a metric and whether the smaller value wins.

    Ties go to the target that sorts first. Targets without a win are listed with 0.
    """
    long = unpivot(summary, [*by, target], [m for m, _ in categories.values()])
    smaller = F.lit(False)
    for metric, small in categories.values():
        if small:
            smaller = smaller | (F.col("metric") == metric)
    rank = F.when(smaller, F.col("value")).otherwise(-F.col("value"))
    best = (long.filter(F.col("value").isNotNull()).groupBy(*by, "metric")
            .agg(F.min(F.struct(rank.alias("rank"), target)).alias("best")))
    winners = best.select(F.col(f"best.{target}").alias(target))
    wins = winners.groupBy(target).agg(F.count("*").alias("wins"))
    total = len(categories)
    return (summary.select(target).distinct().join(wins, target, "left")
            .select(target, F.coalesce("wins", F.lit(0)).alias("wins"),
                    F.lit(total).alias("categories")))


def mode_stats(runs: DataFrame) -> DataFrame:
    """Per mode and driver: spread of the averages and means of the other metrics over runs."""
    base = runs.groupBy("mode", "driver").agg(
        F.count("*").alias("runs"), mean_of_doubles("avg").alias("avg_mean"),
        F.round(F.coalesce(F.stddev_samp("avg"), F.lit(0.0)), 4).alias("avg_stdev"),
        F.min("p95").alias("p95_min"), F.max("p95").alias("p95_max"),
        F.min("p99").alias("p99_min"), F.max("p99").alias("p99_max"),
        *[mean_of_doubles(m).alias(f"{m}_mean") for m in ("p95", "p99", "min", "max", "wall", "qps")])
    medians = picked(runs, ["mode", "driver"], "avg", {"avg_median": MEDIAN}).select(
        "mode", "driver", F.round("avg_median", 4).alias("avg_median"))
    return base.join(medians, ["mode", "driver"], "left")
