"""File sources, file sinks and generators."""

import json

from pyspark.sql import functions as F
from streamkit import same_rows

from tidemark.operators import benchstats
from tidemark.sources import files, generators
from tidemark.streaming import sinks

SUITE = """10:00:01 | INFO | MODE: Mixed workload - both drivers
10:00:01 | INFO | ------
10:00:02 | INFO |   Driver: PSYCO | Wall clock: 12.50s
10:00:02 | INFO |     Queries:      20
10:00:02 | INFO |     Avg:          0.1250s
10:00:02 | INFO |     p50 (median): 0.1000s
10:00:02 | INFO |     p95:          0.3000s
10:00:02 | INFO |     p99:          0.4000s
10:00:02 | INFO |     Min:          0.0500s
10:00:02 | INFO |     Max:          0.5000s
10:00:02 | INFO |     Throughput:   1.6 q/s
  Driver: ADB | Wall clock: 9.00s
    Queries:      20
    Avg:          0.1000s
    p50 (median): 0.0900s
    p95:          0.2000s
    p99:          0.2500s
    Min:          0.0400s
    Max:          0.3000s
    Throughput:   2.2 q/s
  ADB across 1 runs:
    Mean of averages: 0.1000s
"""
FETCH = """stray 5 rows: 1.0s
10:00:02 | INFO |   Fetch-speed benchmark (PSYCO):
10:00:02 | INFO |      10,000 rows: 0.500s (20,000 rows/sec)
10:00:02 | INFO |     500,000 rows: 10.000s (50,000 rows/sec)
  Fetch-speed benchmark (ADB):
     10,000 rows: 0.250s (40,000 rows/sec)
"""


def test_suite_logs(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"run{i}.log").write_text(SUITE)
    runs = files.parse_suite_logs(files.read_lines(spark, str(tmp_path), "*.log"))
    got = sorted((r.file[-8:], r.driver, r.mode, r.wall, r.queries, r.avg, r.p50, r.p95, r.p99,
                  r["min"], r["max"], r.qps) for r in runs.collect())
    assert got == [
        (f"run{i}.log", *row) for i in (1, 2) for row in [
            ("ADB", "Mixed workload", 9.0, 20.0, 0.1, 0.09, 0.2, 0.25, 0.04, 0.3, 2.2),
            ("PSYCO", "Mixed workload", 12.5, 20.0, 0.125, 0.1, 0.3, 0.4, 0.05, 0.5, 1.6)]]
    stats = {r.driver: r for r in benchstats.mode_stats(runs).collect()}
    assert (stats["ADB"].runs, stats["ADB"].avg_stdev, stats["ADB"].avg_median) == (2, 0.0, 0.1)


def test_lines_of_a_file_split_into_blocks(spark, tmp_path):
    """A file read in many blocks parses like a whole one."""
    pad = "x" * 400
    text = "\n".join(line + ("\n" + pad) * 20 for line in SUITE.splitlines())
    (tmp_path / "big.log").write_text(text)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",
                                          "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = files.read_lines(spark, str(tmp_path))
        assert lines.select("block").distinct().count() > 5
        ordered = [r.line for r in lines.orderBy("block", "pos").collect()]
        assert ordered == text.split("\n")
        runs = files.parse_suite_logs(lines).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted((r.driver, r.mode, r["max"]) for r in runs) == [
        ("ADB", "Mixed workload", 0.3), ("PSYCO", "Mixed workload", 0.5)]


def test_fetch_logs(spark, tmp_path):
    (tmp_path / "f.log").write_text(FETCH)
    got = files.parse_fetch_logs(files.read_lines(spark, str(tmp_path)))
    assert sorted((r.driver, r.rows, r.secs) for r in got.collect()) == [
        ("adb", 10000, 0.25), ("psyco", 10000, 0.5), ("psyco", 500000, 10.0)]
    rate = benchstats.fetch_rates(got, "psyco", "adb").collect()
    assert [(r.rows, r.first_rate, r.second_rate, r.ratio) for r in rate] == [
        (10000, 20000.0, 40000.0, 2.0)]


def test_market_sheets(spark, tmp_path):
    from tidemark.operators import market
    head = "preamble\nmore preamble\nنماد,close\n"
    (tmp_path / "sheet_2025-03-21.csv").write_text(head + "abc,10\nabc۲۵,11\nx7,12\n", "utf-8")
    (tmp_path / "sheet_2025-03-22.csv").write_text(head, "utf-8")
    sheets = files.read_market_days(spark, str(tmp_path), "`نماد` string, close int")
    days = market.market_days(sheets)
    assert sorted((r["نماد"], r.close, r.fa_date, r.en_date, r.fa_year) for r in days.collect()) == [
        ("abc", 10, "1404-01-01", "2025-03-21", 1404), ("x7", 12, "1404-01-01", "2025-03-21", 1404)]
    out = f"{tmp_path}/out"
    for _ in range(2):
        sinks.csv_by_day(days, out)
    back = spark.read.option("header", "true").csv(out)
    assert back.count() == 2 and str(back.first().en_date) == "2025-03-21"


def test_csv_days_replace_only_themselves(spark, tmp_path):
    df = spark.createDataFrame([("a", "2025-01-01"), ("b", "2025-01-02")], "s string, en_date string")
    sinks.csv_by_day(df, f"{tmp_path}/o")
    sinks.csv_by_day(df.filter("s = 'b'").withColumn("s", F.lit("c")), f"{tmp_path}/o")
    got = spark.read.option("header", "true").csv(f"{tmp_path}/o")
    assert sorted((r.s, str(r.en_date)) for r in got.collect()) == [("a", "2025-01-01"), ("c", "2025-01-02")]


def test_result_files(spark, tmp_path):
    for mode, size, target, name, body in [
            ("rw", "1MB", "one", "run-1.json", {"mode": "rw", "engine": "e", "threads": 4,
                                                "write": {"target": "one", "latency_p50": 0.5}}),
            ("rw", "1MB", "two", "threads-8_run-2.json", {"mode": "rw", "read": {"latency_p99": 1.5}})]:
        d = tmp_path / mode / size / target
        d.mkdir(parents=True)
        (d / name).write_text(json.dumps(body, indent=1))
    got = {r.target: r for r in files.read_results(spark, str(tmp_path)).collect()}
    assert (got["one"].run, got["one"].threads, got["one"].write.latency_p50) == (1, 4, 0.5)
    assert (got["two"].run, got["two"].threads, got["two"].engine) == (2, 8, None)
    assert (got["two"].size, got["two"].path_mode, got["two"].read.latency_p99) == ("1MB", "rw", 1.5)


def test_export_json_and_rewrite(spark, tables, tmp_path):
    tx = tables.transactions().limit(20)
    target = sinks.export_json(tx, str(tmp_path), "r1")
    row = spark.read.json(target).first()
    assert isinstance(row.amount, str) and isinstance(row.ts, str)
    src, dst = f"{tmp_path}/many", f"{tmp_path}/few"
    tables.events().repartition(12).write.parquet(src)
    sinks.rewrite_files(spark, src, dst, 2)
    inventory = files.file_inventory(spark.read.parquet(dst))
    assert inventory.count() == 2
    same_rows(spark.read.parquet(dst), tables.events())


def test_row_location_is_unique(spark, tables):
    located = files.row_location(tables.raw("orders"))
    assert located.select("file_path", "row_index").distinct().count() == located.count()


def test_views_for_sql(spark, tables):
    tables.register("v_")
    assert spark.sql("SELECT count(*) AS n FROM v_orders_raw").first().n == 6000


def test_dimensions(spark):
    assert files.demo_items(spark).count() == 10
    assert files.risk_bands(spark).count() == 3


# ---- generators ----------------------------------------------------------------------------------

def test_generators_repeat_and_do_not_depend_on_partitions(spark):
    for make in (generators.orders, generators.sensors, generators.trades, generators.activity,
                 generators.returns, generators.card_transactions, generators.products,
                 generators.keyed_events, generators.sensor_rows, generators.category_events,
                 generators.tier_rows):
        a = make(spark, 500)
        assert a.count() == 500, make.__name__
    old = spark.conf.get("spark.sql.shuffle.partitions")
    first = generators.trades(spark, 500).orderBy("trade_id").collect()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert generators.trades(spark, 500).orderBy("trade_id").collect() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_generated_shapes(spark):
    o = generators.orders(spark, 3000)
    assert o.filter("amount <> qty * price OR qty NOT BETWEEN 1 AND 5").count() == 0
    assert o.select("status").distinct().count() == 5 and o.select("item_id").distinct().count() == 10
    s = generators.sensors(spark, 5000)
    alerts = s.filter("status = 'ALERT'").count()
    assert 50 < alerts < 160 and s.select("sensor_id").distinct().count() == 50
    t = generators.trades(spark, 2000)
    lo, hi = t.agg(F.min("price"), F.max("price")).first()
    assert 50 < lo < hi < 1000
    a = generators.activity(spark, 2000)
    assert a.filter("(event_type = 'search') <> (search_query IS NOT NULL)").count() == 0
    assert a.filter("(event_type IN ('purchase', 'add_to_cart')) <> (price IS NOT NULL)").count() == 0
    c = generators.card_transactions(spark, 1000)
    assert c.filter("processed").count() == 0 and c.filter("voucherCode = ''").count() > 800


def test_resumed_products(spark):
    whole = generators.products(spark, 100)
    resumed = generators.products(spark, 40).unionByName(generators.products(spark, 100, existing=40))
    same_rows(resumed, whole)
    assert generators.products(spark, 100, existing=100).count() == 0


def test_replayed_events_repeat_ids(spark):
    e = generators.keyed_events(spark, 10, copies=2)
    assert e.count() == 20 and e.select("event_id", "value", "category").distinct().count() == 10


def test_people(spark):
    p = generators.people(spark, 50)
    assert p.filter("user_type = 'job_seeker'").filter("id % 2 = 1").count() == 0
    assert p.count() == 50
