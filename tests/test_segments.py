"""The cell-wise calculations against plain windows, with a key that holds most of the rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from streamkit import same_rows

from tidemark.functions import quantiles, segments
from tidemark.operators import benchstats, ranking, windows


@pytest.fixture(scope="module")
def skewed(spark):
    """4,000 rows: key 0 and key NULL are hot, times repeat, values have ties and NULLs."""
    h = lambda i: F.pmod(F.xxhash64(F.col("id"), F.lit(i)), F.lit(1000))
    return spark.range(4000).select(
        "id",
        F.when(h(1) < 400, 0).when(h(1) < 600, F.lit(None)).otherwise(h(2) % 40).cast("int").alias("k"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.expr("INTERVAL 7 MINUTE") * (h(3) * 5 % 997))
        .alias("ts"),
        F.when(h(4) > 50, (h(5) % 60).cast("decimal(18,2)")).alias("v")).cache()


def day(c="ts"):
    return segments.time_cell(c, "day")


def by_time():
    return Window.partitionBy("k").orderBy("ts", "id")


@pytest.mark.parametrize("hot_rows", [None, 300, 10 ** 6])
def test_lag(skewed, hot_rows):
    got = segments.lag_in_key(skewed, ["k"], ["ts", "id"], day(), "v", "prev", hot_rows)
    same_rows(got, skewed.withColumn("prev", F.lag("v").over(by_time())))


@pytest.mark.parametrize("grain", ["minute", "hour"])
def test_ties_on_one_instant_are_cut_too(skewed, grain):
    """Rows moved to whole hours share their instant; the order then goes on with the id."""
    rows = skewed.withColumn("ts", F.when(F.col("id") % 3 > 0, F.date_trunc("hour", "ts"))
                             .otherwise(F.col("ts")).cast("timestamp_ntz"))
    cell = segments.time_cell("ts", grain, F.floor(F.col("id") / 200))
    got = segments.lag_in_key(rows, ["k"], ["ts", "id"], cell, "v", "prev", None)
    same_rows(got, rows.withColumn("prev", F.lag("v").over(by_time())))
    got = segments.running_total(rows, ["k"], ["ts", "id"], cell, F.lit(1), "n", "total")
    same_rows(got, rows.withColumns({
        "n": F.row_number().over(by_time()), "total": F.count("*").over(Window.partitionBy("k"))}))


def test_running_total_with_key_total(skewed):
    got = segments.running_total(skewed, ["k"], ["ts", "id"], day(),
                                 F.coalesce("v", F.lit(0)), "run", "total")
    run = F.sum(F.coalesce("v", F.lit(0))).over(by_time().rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum(F.coalesce("v", F.lit(0))).over(Window.partitionBy("k"))
    same_rows(got, skewed.withColumns({"run": run, "total": total}))


def test_row_number(skewed):
    got = segments.running_total(skewed, ["k"], ["ts", "id"], day(), F.lit(1), "n")
    same_rows(got, skewed.withColumn("n", F.row_number().over(by_time())))


def test_fill_forward(skewed):
    sparse = skewed.withColumn("v", F.when(F.col("id") % 37 == 0, F.col("v")))
    got = segments.fill_forward(sparse, ["k"], ["ts", "id"], day(), ["v"])
    w = by_time().rowsBetween(Window.unboundedPreceding, 0)
    same_rows(got, sparse.withColumn("v", F.last("v", ignorenulls=True).over(w)))


@pytest.mark.parametrize("width", [0.5, 7.0, 1e9])
def test_rank(skewed, width):
    rows = skewed.withColumn("v", F.when(F.col("id") % 5 == 0, F.lit(7)).otherwise(F.col("v"))
                             .cast("decimal(18,2)"))
    got = ranking.rank_in_group(rows, "k", "v", width)
    want = rows.withColumn("rank_in_category", F.when(F.col("v").isNotNull(), F.rank().over(
        Window.partitionBy("k").orderBy(F.desc_nulls_last("v")))))
    same_rows(got, want)


def test_sessions_against_lag(skewed):
    rows = skewed.filter("k IS NOT NULL").withColumnsRenamed({"k": "user_id", "v": "value"})
    got = windows.user_sessions(rows, 420)
    w = Window.partitionBy("user_id").orderBy("ts", "id")
    gap = F.timestamp_diff("SECOND", F.lag("ts").over(w), F.col("ts")) > 420
    numbered = rows.withColumn("o", F.when(F.lag("ts").over(w).isNull() | gap, 1).otherwise(0))
    numbered = numbered.withColumn("session_no", F.sum("o").over(w))
    want = numbered.groupBy("user_id", "session_no").agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("session_end"),
        F.count("*").alias("events_in_session"), F.sum("value").alias("session_value"))
    same_rows(got, want)


def test_quantiles_against_sorted_lists(skewed):
    rows = skewed.select("k", F.col("v").cast("double").alias("v")).filter("k IS NOT NULL")
    counts = quantiles.cumulative_counts(rows, ["k"], "v", 5.0)
    got = {r.k: r for r in counts.groupBy("k").agg(
        quantiles.linear("v", 0.95).alias("lin"), quantiles.rank_pick("v", 0.95).alias("p95"),
        quantiles.rank_pick("v", 0.99, clamp=True).alias("p99"),
        benchstats._median("v").alias("med")).collect()}
    groups = {}
    for r in rows.filter("v IS NOT NULL").collect():
        groups.setdefault(r.k, []).append(r.v)
    assert set(got) == set(groups)
    for k, vs in groups.items():
        vs.sort()
        n = len(vs)
        pos = (n - 1) * 0.95
        lo, hi = int(pos), min(int(pos) + 1, n - 1)
        assert got[k].lin == pytest.approx(vs[lo] + (vs[hi] - vs[lo]) * (pos - lo))
        assert got[k].p95 == (vs[int(n * 0.95)] if n > 1 else vs[-1])
        assert got[k].p99 == vs[min(int(n * 0.99), n - 1)]
        assert got[k].med == pytest.approx((vs[(n - 1) // 2] + vs[n // 2]) / 2)


def test_small_percentiles(spark):
    rows = spark.range(10).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("v"))
    counts = quantiles.cumulative_counts(rows, ["k"], "v", 1.0).groupBy("k")
    row = counts.agg(quantiles.linear("v", 0.95).alias("a"),
                     quantiles.rank_pick("v", 0.95).alias("b")).first()
    assert (round(row.a, 9), row.b) == (8.55, 9.0)


def test_hot_key_is_spread_over_tasks(spark):
    """With every row in one key, the windowed stage still has rows in several partitions."""
    rows = spark.range(20000).select(
        F.lit(1).alias("k"), "id",
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR") * F.col("id"))
        .alias("ts"))
    out = segments.running_total(rows, ["k"], ["ts", "id"], day(), F.lit(1), "n")
    # small partitions would be merged again
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(spread) > 1 and max(r["count"] for r in spread) < 15000
    assert out.agg(F.max("n")).first()[0] == 20000


HOT = [60, 300, 10 ** 6]


@pytest.mark.parametrize("hot_rows", HOT)
def test_cells_from_the_data(skewed, hot_rows):
    """Lag, running sum, total and fill with cells that nobody typed in."""
    same_rows(segments.lag_in_key(skewed, ["k"], ["ts", "id"], None, "v", "prev", hot_rows),
              skewed.withColumn("prev", F.lag("v").over(by_time())))
    got = segments.running_total(skewed, ["k"], ["ts", "id"], None, F.coalesce("v", F.lit(0)), "run",
                                 "total", hot_rows)
    here = by_time().rowsBetween(Window.unboundedPreceding, 0)
    value = F.coalesce("v", F.lit(0))
    same_rows(got, skewed.withColumns({
        "run": F.sum(value).over(here), "total": F.sum(value).over(Window.partitionBy("k"))}))
    sparse = skewed.withColumn("v", F.when(F.col("id") % 37 == 0, F.col("v")))
    got = segments.fill_forward(sparse, ["k"], ["ts", "id"], None, ["v"], hot_rows)
    same_rows(got, sparse.withColumn("v", F.last("v", ignorenulls=True).over(here)))


def test_cells_where_one_instant_holds_a_key(skewed):
    """All rows of a key at one time: the order behind it is cut."""
    rows = skewed.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    cells = segments.cut(rows, ["k"], ["ts", "id"], 100)
    sizes = cells.filter("_cell IS NOT NULL").groupBy("k", "_cell").count().collect()
    assert max(r["count"] for r in sizes) < 400 and len(sizes) > 10
    same_rows(segments.lag_in_key(rows, ["k"], ["ts", "id"], None, "v", "prev", 100),
              rows.withColumn("prev", F.lag("v").over(by_time())))


@pytest.mark.parametrize("rows", [20_000, 200_000])
def test_cells_keep_their_share_at_any_size(spark, rows):
    """A third of the rows in one key, most of them in one hour, and times spread over ten powers:
    cells hold a bounded share, and so do the edges that meet per key."""
    parts = 60
    table = spark.range(rows).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % 5000).alias("k"),
        F.pow(F.lit(10.0), F.col("id") % 7 + F.rand(1)).alias("x"))
    cells = segments.cut(table, ["k"], ["x", "id"], rows // parts)
    sizes = cells.groupBy("k", "_cell").agg(F.count("*").alias("n"), F.min("x").alias("low"),
                                            F.max("x").alias("high"))
    hot = sorted(sizes.filter("_cell IS NOT NULL").collect(), key=lambda r: r["_cell"])
    assert {r.k for r in hot} == {0}
    assert sum(r.n for r in hot) == cells.filter("k = 0").count()
    assert max(r.n for r in hot) <= 2.5 * rows / parts
    assert parts / 6 <= len(hot) <= parts
    assert all(a.high <= b.low for a, b in zip(hot, hot[1:]))


@pytest.mark.parametrize("hot_rows", HOT)
@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e9])
def test_statistics_at_any_scale(skewed, hot_rows, scale):
    """Latencies below a millisecond and values over a billion, without a width."""
    rows = skewed.select("k", ((F.col("v") + F.col("id") / 5000) * F.lit(scale)).alias("v"))
    got = {r.k: r for r in quantiles.picked(rows, ["k"], "v", {
        "lin": quantiles.interpolated(0.95), "p95": quantiles.ranked(0.95),
        "p99": quantiles.ranked(0.99, clamp=True), "med": quantiles.MEDIAN},
        hot_rows // 20).collect()}
    groups = {}
    for r in rows.filter("v IS NOT NULL").collect():
        groups.setdefault(r.k, []).append(r.v)
    assert set(got) == set(groups)
    for k, vs in groups.items():
        vs.sort()
        n = len(vs)
        at = (n - 1) * 0.95
        lo, hi = int(at), min(int(at) + 1, n - 1)
        assert got[k].total == n
        assert got[k].lin == pytest.approx(vs[lo] + (vs[hi] - vs[lo]) * (at - lo), rel=1e-12)
        assert got[k].p95 == (vs[int(n * 0.95)] if n > 1 else vs[0])
        assert got[k].p99 == vs[min(int(n * 0.99), n - 1)]
        assert got[k].med == (vs[(n - 1) // 2] + vs[n // 2]) / 2
    if scale == 1.0:
        ranks = ranking.rank_in_group(rows, "k", "v", hot_rows=hot_rows // 20)
        same_rows(ranks, rows.withColumn("rank_in_category", F.when(F.col("v").isNotNull(), F.rank()
                  .over(Window.partitionBy("k").orderBy(F.desc_nulls_last("v"))))))


def test_only_cells_that_hold_a_position_are_sorted(spark):
    """Of a key in many cells, the window sees the rows of the wanted cells only."""
    rows = spark.range(20_000).select(F.lit(1).alias("k"), (F.col("id") * 1.5).alias("v"))
    got = quantiles.picked(rows, ["k"], "v", {"p95": quantiles.ranked(0.95)}, 200)
    assert got.first().p95 == 19_000 * 1.5
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.count("PartialWindow") == 0 and "CartesianProduct" not in text
    cells = segments.cut(quantiles.value_counts(rows, ["k"], "v"), ["k"], ["v"], 200)
    assert cells.select("_cell").distinct().count() > 50


def test_keys_and_values_that_are_null_or_empty(spark):
    empty = spark.createDataFrame([], "k int, v double")
    assert quantiles.picked(empty, ["k"], "v", {"a": quantiles.MEDIAN}).count() == 0
    assert segments.cut(empty, ["k"], ["v"]).count() == 0
    rows = spark.createDataFrame([(None, 1.0), (None, None), (1, None)], "k int, v double")
    got = quantiles.picked(rows, ["k"], "v", {"a": quantiles.MEDIAN}, 0).collect()
    assert [(r.k, r.total, r.a) for r in got] == [(None, 1, 1.0)]
