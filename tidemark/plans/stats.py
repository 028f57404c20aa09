"""Benchmark statistics: the events read as timed operations and as the logs of test runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.means import mean
from ..functions.quantiles import interpolated, picked, ranked
from ..operators import benchstats as bench
from ..session import shared_dir
from ..sources import files
from ..sources.tables import Tables
from .registry import plan
from .sqltext import avg4, dbl, with_views

RUN = ["target", "mode", "run_id"]


@plan("percentile_linear", """
    SELECT event_type, COUNT(*) AS n, ROUND(quantile_cont(value, 0.5), 4) AS p50,
           ROUND(quantile_cont(value, 0.95), 4) AS p95, ROUND(quantile_cont(value, 0.99), 4) AS p99
    FROM events GROUP BY 1""")
def percentile_linear(t: Tables):
    got = picked(t.raw("events"), ["event_type"], "value", {
        n: interpolated(p) for n, p in (("p50", .5), ("p95", .95), ("p99", .99))})
    return got.select("event_type", F.col("total").alias("n"),
                      *[F.round(c, 4).alias(c) for c in ("p50", "p95", "p99")])


PICK = """max(CASE WHEN rn = CASE WHEN n > 1 THEN {pos} + 1 ELSE 1 END THEN {v} END)"""
P95 = "CAST(floor(n * 0.95) AS BIGINT)"
P99 = "least(CAST(floor(n * 0.99) AS BIGINT), n - 1)"


@plan("percentile_rank_pick", f"""
    SELECT user_id, max(n) AS n, {PICK.format(pos=P95, v='value')} AS p95,
           {PICK.format(pos=P99, v='value')} AS p99
    FROM (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value) AS rn,
          COUNT(*) OVER (PARTITION BY user_id) AS n FROM events) GROUP BY 1""")
def percentile_rank_pick(t: Tables):
    got = picked(t.raw("events"), ["user_id"], "value", {
        "p95": ranked(0.95), "p99": ranked(0.99, clamp=True)})
    return got.select("user_id", F.col("total").alias("n"), "p95", "p99")


WALL = """SELECT target, mode, run_id, CAST(date_sub('second', min(ts), max(ts)) AS DOUBLE)
    AS wall FROM op_results GROUP BY ALL"""
NUMBERED = """SELECT *, row_number() OVER (PARTITION BY target, mode, run_id ORDER BY time_sec) AS rn,
    COUNT(*) OVER (PARTITION BY target, mode, run_id) AS n FROM op_results WHERE success"""
PICKED = f"""SELECT target, mode, run_id, ROUND(median(time_sec), 4) AS latency_p50,
    {PICK.format(pos=P95, v='time_sec')} AS latency_p95,
    {PICK.format(pos=P99, v='time_sec')} AS latency_p99 FROM numbered GROUP BY ALL"""
BASE = f"""SELECT target, mode, run_id, COUNT(*) FILTER (WHERE success) AS successful,
    COUNT(*) FILTER (WHERE NOT success) AS failed,
    CAST(coalesce(SUM(size_mb) FILTER (WHERE success), 0) AS BIGINT) AS total_data_mb,
    {avg4('time_sec', where='success')} AS latency_mean,
    min(time_sec) FILTER (WHERE success) AS latency_min,
    max(time_sec) FILTER (WHERE success) AS latency_max,
    ROUND(coalesce(stddev_samp(time_sec) FILTER (WHERE success),
        CASE WHEN COUNT(*) FILTER (WHERE success) = 1 THEN 0.0 END), 4) AS latency_stdev
    FROM op_results GROUP BY ALL"""
SUMMARY = """SELECT target, mode, run_id, successful, failed, total_data_mb, wall AS wall_time_sec,
    latency_mean, latency_min, latency_max, latency_stdev, latency_p50, latency_p95, latency_p99,
    ROUND(CASE WHEN wall > 0 THEN total_data_mb / wall ELSE 0.0 END, 4) AS throughput_mbps
    FROM base JOIN walls USING (target, mode, run_id) LEFT JOIN picked USING (target, mode, run_id)"""
SUMMARY_CTES = {"walls": WALL, "numbered": NUMBERED, "picked": PICKED, "base": BASE}


@plan("latency_summary", with_views("op_results", SUMMARY, **SUMMARY_CTES))
def latency_summary(t: Tables):
    return bench.latency_summary(t.op_results(), RUN, wall=bench.span_seconds())


METRICS = ["wall_time_sec", "throughput_mbps", "latency_p50", "latency_p95", "latency_p99",
           "latency_mean"]


@plan("aggregate_runs", with_views("op_results", " UNION ALL ".join(
    f"SELECT target, mode, '{m}' AS metric, COUNT({m}) AS num_runs, {avg4(m, scale=4)} AS mean, "
    f"ROUND(coalesce(stddev_samp({m}), 0), 4) AS stdev FROM s GROUP BY 1, 2" for m in METRICS),
    **SUMMARY_CTES, s=SUMMARY))
def aggregate_runs(t: Tables):
    return bench.aggregate_runs(latency_summary(t), ["target", "mode"], METRICS)


RATE = """ROUND(coalesce(CAST(COUNT(*) FILTER (WHERE op = '{op}' AND success) AS DOUBLE)
    / nullif(COUNT(*) FILTER (WHERE op = '{op}'), 0), 0), 4) AS {op}_success_rate"""
OP_PICK = """ROUND(coalesce(max(CASE WHEN op = '{op}' THEN {c} END), 0), 4) AS {op}_latency_{c}"""


@plan("heavy_mix", with_views("op_results", """
    SELECT b.*, coalesce(write_latency_p50, 0) AS write_latency_p50,
           coalesce(read_latency_p50, 0) AS read_latency_p50,
           coalesce(write_latency_p99, 0) AS write_latency_p99,
           coalesce(read_latency_p99, 0) AS read_latency_p99
    FROM b LEFT JOIN p USING (target, mode, run_id)""",
    b=f"""SELECT target, mode, run_id, COUNT(*) FILTER (WHERE op = 'write') AS num_writes,
        COUNT(*) FILTER (WHERE op <> 'write') AS num_reads,
        CAST(coalesce(SUM(size_mb) FILTER (WHERE success), 0) AS BIGINT) AS total_data_mb,
        {RATE.format(op='write')}, {RATE.format(op='read')} FROM op_results GROUP BY ALL""",
    q=f"""SELECT target, mode, run_id, op, median(time_sec) AS p50,
        {PICK.format(pos=P99, v='time_sec')} AS p99
        FROM (SELECT *, row_number() OVER w AS rn, COUNT(*) OVER (
              PARTITION BY target, mode, run_id, op) AS n FROM op_results WHERE success
              WINDOW w AS (PARTITION BY target, mode, run_id, op ORDER BY time_sec)) GROUP BY ALL""",
    p="SELECT target, mode, run_id, " + ", ".join(
        OP_PICK.format(op=o, c=c) for c in ("p50", "p99") for o in ("write", "read"))
      + " FROM q GROUP BY ALL"))
def heavy_mix(t: Tables):
    return bench.heavy_mix(t.op_results(), RUN)


CARD = {"p50": ("latency_p50", True), "p99": ("latency_p99", True), "mean": ("latency_mean", True),
        "rate": ("throughput_mbps", False)}


@plan("scorecard", with_views("op_results", f"""
    SELECT target, COUNT(w.metric) AS wins, CAST({len(CARD)} AS INTEGER) AS categories
    FROM (SELECT DISTINCT target FROM s) LEFT JOIN w USING (target) GROUP BY 1""",
    **SUMMARY_CTES, s=SUMMARY, m=" UNION ALL ".join(
        f"SELECT mode, run_id, target, '{c}' AS metric, {'-' if small else ''}{c} AS score FROM s "
        f"WHERE {c} IS NOT NULL" for c, small in CARD.values()),
    w="""SELECT metric, target FROM (SELECT *, row_number() OVER (PARTITION BY mode, run_id, metric
         ORDER BY score DESC, target) AS rn FROM m) WHERE rn = 1"""))
def scorecard(t: Tables):
    return bench.scorecard(latency_summary(t), "target", CARD, by=["mode", "run_id"])


# ---- logs ----------------------------------------------------------------------------------------
# One log per day, one block per event type ("driver"), as a test run would have written it.

def from_text(t: Tables, lines: DataFrame, name: str) -> DataFrame:
    """The lines as they come back from text files that were written from them."""
    path = shared_dir(t.spark, name)
    files.write_logs(lines, path)
    return files.read_logs(t.spark, path)


def day_stats(t: Tables) -> DataFrame:
    by = t.events().groupBy(F.date_format("ts", "yyyy-MM-dd").alias("file"),
                            F.col("event_type").alias("driver"))
    return by.agg(
        F.count("*").alias("queries"),
        mean("value").alias("avg"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.max("value").cast("double").alias("top"), F.sum("value").alias("wall"),
        F.count_distinct("user_id").alias("users"))


def suite_log_lines(t: Tables) -> DataFrame:
    """The log text, laid out from the day statistics; a block's lines keep their order."""
    def text(fmt, *cols):
        return F.format_string("10:00:00 | INFO | " + fmt, *cols)

    mode = F.when(F.substring("file", 10, 1).cast("int") % 2 == 0, "mixed").otherwise("large")
    lines = F.array(
        F.concat(F.lit("MODE: "), mode, F.lit(" - all drivers")),
        text("Driver: %s | Wall clock: %.2fs", F.col("driver"), F.col("wall").cast("double")),
        text("  Queries:      %d", F.col("queries")),
        text("  Avg:          %.4fs", F.col("avg")),
        text("  p50 (median): %.4fs", F.col("min").cast("double")),
        text("  p95:          %.4fs", F.col("top")),
        text("  p99:          %.4fs", F.col("top")),
        text("  Min:          %.4fs", F.col("min").cast("double")),
        text("  Max:          %.4fs", F.col("top")),
        text("  Throughput:   %.1f q/s", F.col("users").cast("double")),
        F.lit("-----"))
    # each driver writes its block at its own place in the file of the day
    block = F.xxhash64("driver")
    return day_stats(t).select("file", block.alias("block"), F.posexplode(lines).alias("pos", "line"))


DAY_STATS = f"""SELECT strftime(ts, '%Y-%m-%d') AS file, event_type AS driver, COUNT(*) AS queries,
    {avg4('value')} AS avg, CAST(MIN(value) AS DOUBLE) AS min,
    CAST(MAX(value) AS DOUBLE) AS max, CAST(SUM(value) AS DOUBLE) AS wall,
    CAST(COUNT(DISTINCT user_id) AS DOUBLE) AS users,
    CASE WHEN CAST(substr(strftime(ts, '%Y-%m-%d'), 10, 1) AS INTEGER) % 2 = 0 THEN 'mixed'
         ELSE 'large' END AS mode FROM ev GROUP BY ALL"""
SUITE = """SELECT file, mode, driver, wall, CAST(queries AS DOUBLE) AS queries, avg, min AS p50,
    max AS p95, max AS p99, min, max, users AS qps FROM d"""


@plan("parse_suite_logs", with_views("ev", SUITE, d=DAY_STATS))
def parse_suite_logs(t: Tables):
    return files.parse_suite_logs(from_text(t, suite_log_lines(t), "suite-logs"))


@plan("mode_stats", with_views("ev", f"""
    SELECT mode, driver, COUNT(*) AS runs, {avg4('avg', scale=4)} AS avg_mean,
           ROUND(coalesce(stddev_samp(avg), 0), 4) AS avg_stdev, {avg4('p95', scale=4)} AS p95_mean,
           min(p95) AS p95_min, max(p95) AS p95_max, {avg4('p99', scale=4)} AS p99_mean,
           min(p99) AS p99_min, max(p99) AS p99_max, {avg4('min', scale=4)} AS min_mean,
           {avg4('max', scale=4)} AS max_mean, {avg4('wall', scale=4)} AS wall_mean,
           {avg4('qps', scale=4)} AS qps_mean, ROUND(median(avg), 4) AS avg_median
    FROM s GROUP BY 1, 2""", d=DAY_STATS, s=SUITE))
def mode_stats(t: Tables):
    return bench.mode_stats(parse_suite_logs(t))


@plan("driver_compare", with_views("ev", f"""
    SELECT *, CASE WHEN second_mean < first_mean THEN 'view' ELSE 'click' END AS winner,
           ROUND(abs(first_mean - second_mean) / greatest(first_mean, second_mean) * 100, 1) AS lead_pct
    FROM (SELECT mode, {avg4('avg', scale=4, where="driver = 'click'")} AS first_mean,
          {avg4('avg', scale=4, where="driver = 'view'")} AS second_mean FROM s GROUP BY 1)
    WHERE first_mean IS NOT NULL AND second_mean IS NOT NULL""", d=DAY_STATS, s=SUITE))
def driver_compare(t: Tables):
    return bench.driver_compare(parse_suite_logs(t), ["mode"], "click", "view")


def fetch_log_lines(t: Tables) -> DataFrame:
    """Fetch logs: a header per driver, then one line per fetch size and its seconds."""
    by = (t.events().groupBy(F.date_format("ts", "yyyy-MM-dd").alias("file"),
                   F.col("event_type").alias("driver"),
                   ((F.col("user_id") % 4 + 1) * 10000).alias("size"))
          .agg((F.sum("value") + 1).cast("double").alias("secs")))
    row = F.concat(F.lit("    "), F.format_number("size", 0), F.lit(" rows: "),
                   F.format_string("%.3f", F.col("secs")), F.lit("s (1 rows/sec)"))
    block = F.xxhash64("driver")
    head = by.select("file", "driver").distinct().select(
        "file", block.alias("block"), F.lit(0).cast("long").alias("pos"),
        F.concat(F.lit("Fetch-speed benchmark ("), F.upper("driver"), F.lit("):")).alias("line"))
    return head.unionByName(by.select("file", block.alias("block"), F.col("size").alias("pos"),
                                      row.alias("line")))


FETCH = """SELECT strftime(ts, '%Y-%m-%d') AS file, event_type AS driver,
    (user_id % 4 + 1) * 10000 AS rows, CAST(SUM(value) + 1 AS DOUBLE) AS secs
    FROM ev GROUP BY ALL"""


@plan("parse_fetch_logs", with_views("ev", FETCH))
def parse_fetch_logs(t: Tables):
    return files.parse_fetch_logs(from_text(t, fetch_log_lines(t), "fetch-logs"))


@plan("fetch_rates", with_views("ev", f"""
    SELECT rows, a4 AS first_secs, b4 AS second_secs,
           ROUND(rows / a, 2) AS first_rate, ROUND(rows / b, 2) AS second_rate,
           ROUND((rows / b) / (rows / a), 4) AS ratio
    FROM (SELECT rows, avg(secs) FILTER (WHERE driver = 'click') AS a,
          avg(secs) FILTER (WHERE driver = 'view') AS b,
          {avg4('secs', where="driver = 'click'")} AS a4,
          {avg4('secs', where="driver = 'view'")} AS b4 FROM f GROUP BY 1)""", f=FETCH))
def fetch_rates(t: Tables):
    return bench.fetch_rates(parse_fetch_logs(t), "click", "view")


@plan("market_sheets", with_views("ev", f"""
    SELECT event_type AS symbol, user_id AS trades, {dbl('SUM(value)')} AS close,
           strftime(ts, '%Y-%m-%d') AS en_date FROM ev GROUP BY 1, 2, 4"""))
def market_sheets(t: Tables):
    """Daily sheets with two lines of preamble and a header, written as text and read by the header's
    names; odd days have other columns in another order."""
    path = shared_dir(t.spark, "sheets")
    rows = t.events().groupBy("event_type", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")
                              ).agg(F.sum("value").alias("s"))
    odd = F.substring("day", 10, 1).cast("int") % 2 == 1
    text = F.when(odd, F.concat_ws(",", "user_id", F.lit("x"), "s", "event_type")).otherwise(
        F.concat_ws(",", "event_type", "s", "user_id"))
    lines = rows.select("day", F.lit(3).alias("no"), text.alias("line")).unionByName(
        rows.select("day").distinct().select("day", F.posexplode(F.array(
            F.lit("Market watch"), F.col("day"), F.when(odd, "trades,note,close,symbol").otherwise(
                "symbol,close,trades"))).alias("no", "line")))
    dated = lines.withColumn("file", F.concat(F.lit("sheet_"), F.col("day"), F.lit(".csv")))
    (dated.repartition("file").sortWithinPartitions("file", "no").select("file", "line")
     .write.partitionBy("file").text(path))
    named = files.read_market_days(t.spark, path, "symbol string, trades long, close decimal(18,2)",
                                   pattern="*.txt")
    return named
