"""Operators on hand-made rows: NULLs, ties, empty input, quirks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from streamkit import same_rows

from tidemark.functions import calendars, means, text
from tidemark.operators import (aggregates, anomaly, archive, benchstats, changes, claims, clean,
                                enrich, market, quality, versions, windows)
from tidemark.sources import files


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def ts(s):
    return dt.datetime.fromisoformat(s)


# ---- functions -----------------------------------------------------------------------------------

@pytest.mark.parametrize("day, fa", [
    ("2024-03-20", "1403-01-01"), ("2025-03-20", "1403-12-30"), ("2025-03-21", "1404-01-01"),
    ("2021-03-20", "1399-12-30"), ("2020-03-20", "1399-01-01"), ("1979-02-11", "1357-11-22")])
def test_jalali(spark, day, fa):
    row = spark.range(1).select(
        calendars.jalali_date(F.lit(day).cast("date")).alias("d"),
        calendars.jalali_year(F.lit(day).cast("date")).alias("y")).first()
    assert (row.d, row.y) == (fa, int(fa[:4]))


def test_jalali_days_follow_each_other(spark):
    """Over 200 years every day is the next of its month, or the first of the next month."""
    parts = spark.sql("SELECT explode(sequence(DATE'1900-01-01', DATE'2100-01-01')) AS d").select(
        "d", *[c.alias(n) for n, c in zip("ymx", calendars.jalali_parts("d"))])
    months = parts.groupBy("y", "m").agg(F.count("*").alias("n"), F.max("x").alias("last"))
    inner = months.filter("y BETWEEN 1279 AND 1477")
    assert inner.filter("n <> last").count() == 0
    assert inner.filter("m <= 6 AND n <> 31 OR m BETWEEN 7 AND 11 AND n <> 30").count() == 0
    assert inner.filter("m = 12 AND n NOT IN (29, 30)").count() == 0


def test_is_symbol(spark):
    cases = [("abc", True), ("abc 7", True), ("abc19", True), ("abc20", False), ("۱۰ نام", True),
             ("1023", False), (None, True), ("٢٥", False), ("0" * 25 + "19", True), ("007", True),
             ("9" * 40, False), ("x²", True)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "s string").withColumn(
        "keep", text.is_symbol("s"))
    assert {r.s: r.keep for r in df.collect()} == dict(cases)


def test_event_times(spark):
    cases = {
        "2024-01-02T03:04:05.678901": ts("2024-01-02T03:04:05.678901"),
        "2024-01-02T03:04:05.678901+00:00": ts("2024-01-02T03:04:05.678901"),
        "2024-01-02 03:04:05.5-02:00": ts("2024-01-02T05:04:05.500000"),
        "2024-01-02T03:04:05Z": ts("2024-01-02T03:04:05"),
        "2024/01/02 03:04:05": ts("2024-01-02T03:04:05"),
        " 2024-01-02 ": ts("2024-01-02T00:00:00"),
        "2024": None, "12:30": None, "2024-13-01": None, "": None}
    df = spark.createDataFrame([(c,) for c in cases] + [(None,)], "t string")
    got = {r.t: r for r in clean.parse_times(df, "t").collect()}
    assert {t: got[t].ts for t in cases} == cases
    assert got[None].rejected == 0 and got["2024"].rejected == 1 and got[" 2024-01-02 "].rejected == 0


def test_flatten_keeps_absent_fields_null(spark):
    df = spark.createDataFrame(
        [(1, '{"a": {"b": 2, "c": {"d": "x"}}, "extra": 1}'), (2, "{}"), (3, None)], "id int, j string")
    got = clean.flatten_event(df, "j", "a struct<b: int, c: struct<d: string>>, q string")
    assert got.columns == ["id", "a_b", "a_c_d", "q"]
    assert sorted(map(str, map(tuple, got.collect()))) == [
        "(1, 2, 'x', None)", "(2, None, None, None)", "(3, None, None, None)"]


# ---- clean and join ------------------------------------------------------------------------------

def test_latest_by_key_breaks_ties_by_all_columns(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, None, "n"), (None, 1, "q")],
                               "k int, v int, x string")
    got = clean.latest_by_key(df, ["k"], ["v", "x"])
    assert set(map(tuple, got.collect())) == {(1, 5, "b"), (2, None, "n"), (None, 1, "q")}
    assert clean.latest_by_key(df.limit(0), ["k"], ["v"]).count() == 0


def test_bands(spark):
    df = spark.createDataFrame([(10000.0,), (10000.5,), (50000.0,), (50001.0,), (None,)],
                               "trade_value double")
    assert [r.risk_level for r in clean.risk_banded(df).collect()] == [
        "Low", "Medium", "Medium", "High", None]
    bands = spark.createDataFrame([("A", 0, 10), ("B", 10, 20)],
                                  "risk_level string, threshold_min int, threshold_max int")
    vals = spark.createDataFrame([(0,), (10,), (11,), (21,), (None,)], "v int")
    got = enrich.join_bands(vals, "v", bands).orderBy(F.col("v").asc_nulls_last(), "risk_level")
    assert [r.risk_level for r in got.collect()] == [
        "A", "A", "B", "B", None, None]


def test_order_size_uses_strict_bounds(spark):
    df = spark.createDataFrame([(1, 1, 1, "49.99"), (2, 1, 1, "50"), (3, 1, 1, "200")],
                               "order_id int, user_id int, qty int, price string").withColumns(
        {"price": F.col("price").cast("decimal(18,2)"),
         "ts": F.lit("2024-01-07 10:00:00").cast("timestamp_ntz")})
    got = clean.transform_orders(df).orderBy("order_id").collect()
    assert [r.order_size for r in got] == ["Small", "Medium", "Large"]
    assert {r.day_of_week for r in got} == {0}  # a Sunday


def test_reject_reason_counts_null_as_broken(spark):
    df = spark.createDataFrame([(1, 1.0, 1, "2024-01-01"), (None, 1.0, 1, "2024-01-01"),
                                (1, 1.0, None, "2024-01-01"), (1, 1.0, 1, "2030-01-01")],
                               "qty int, price double, user_id int, t string").withColumn(
        "ts", F.col("t").cast("timestamp_ntz"))
    rules = clean.order_rules("2024-06-01")
    got = [r.reject_reason for r in clean.with_reject_reason(df, rules).collect()]
    assert got == [None, "qty_positive", "user_present", "not_in_future"]
    assert clean.validate(df, rules).count() == 1


def volume_tables(spark):
    trades = spark.createDataFrame(
        [(1, 1, "s", "100.00"), (2, 1, "s", "50.00"), (3, 1, "u", "7.00")],
        "trade_id int, line int, symbol string, v string").select(
        "trade_id", "line", "symbol", F.col("v").cast("decimal(18,2)").alias("trade_value"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"))
    returns = spark.createDataFrame([(1, "10.00"), (1, "5.00"), (9, "99.00")],
                                    "order_id int, v string").select(
        "order_id", F.col("v").cast("decimal(18,2)").alias("refund_amount"))
    instruments = spark.createDataFrame([("s", "stock"), ("t", "bond")],
                                        "symbol string, instrument_category string")
    return trades, returns, instruments


def test_net_volume_with_and_without_fan_out(spark):
    tables = volume_tables(spark)
    as_written = {r.instrument_category: r for r in enrich.net_trading_volume(*tables).collect()}
    stock = as_written["stock"]
    assert (stock.total_trades, stock.total_returns, float(stock.gross_volume),
            float(stock.refund_volume)) == (3, 2, 250.0, 15.0)
    assert as_written[None].total_returns == 0 and float(as_written[None].refund_volume) == 0
    exact = {r.instrument_category: r for r in enrich.net_trading_volume_exact(*tables).collect()}
    assert (exact["stock"].total_trades, float(exact["stock"].net_volume)) == (2, 135.0)
    rate = {r.instrument_category: r.return_rate_percent
            for r in enrich.return_rate(enrich.net_trading_volume(*tables)).collect()}
    assert rate == {"stock": 6.0, None: 0.0}


def test_return_rate_of_nothing_is_null(spark):
    df = spark.createDataFrame([("x", 0, 0.0, 0.0, 0.0)],
                               "instrument_category string, net_trades int, gross_volume double, "
                               "refund_volume double, net_volume double")
    assert enrich.return_rate(df).first().return_rate_percent is None


def test_reconcile_keeps_one_sided_keys(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n int")
    b = spark.createDataFrame([("y", 5), ("z", 7)], "k string, n int")
    assert set(map(tuple, enrich.reconcile(a, b, ["k"], ["n"]).collect())) == {
        ("x", 1, None, 1), ("y", 2, 5, -3), ("z", None, 7, -7)}


def test_orphans_and_semi(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "p int")
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    assert [r.p for r in enrich.orphans(child, parent, "p", "id").orderBy("p").collect()] == [None, 2, 2]
    ledger = parent.withColumnRenamed("id", "p")
    assert enrich.semi_by_ids(child, ledger, "p").count() == 1


def test_orphans_of_whole_numbers_move_bits_of_keys(spark):
    """Before the shuffle 64 neighbouring keys are one row; keys at both ends, repeated and null ones."""
    ends = [-(1 << 63), (1 << 63) - 1]
    keys = [*ends, -65, -64, -63, -1, 0, 1, 62, 63, 64, 64, 64, 127, 128, None, None]
    child = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, p long")
    for known in ([], [None], [63, -64, 0, 127, None, 127], [k for k in keys if k], ends):
        parent = spark.createDataFrame([(k,) for k in known], "k long")
        got = enrich.orphans(child, parent, "p", "k")
        assert sorted(r.id for r in got.collect()) == [
            i for i, k in enumerate(keys) if k is None or k not in known]
    small = spark.createDataFrame([(1, 5), (2, -7)], "id int, p int")
    assert [r.p for r in enrich.orphans(small, spark.createDataFrame([(5,)], "k long"), "p", "k").collect()
            ] == [-7]
    many = spark.range(64_000).select(F.col("id").alias("p"))
    found = enrich.orphans(many, many.withColumnRenamed("p", "k"), "p", "k")
    assert found.count() == 0
    assert "_block" in found._jdf.queryExecution().executedPlan().toString()



# ---- summaries -----------------------------------------------------------------------------------

def test_golden_employees(spark):
    """Eleven employees in three years: the averages are published with the data set."""
    data = [("2023", s) for s in (75000, 82000, 91000, 69000)] + [
        ("2024", s) for s in (85000, 95000, 78000, 82000)] + [
        ("2025", s) for s in (99000, 105000, 103000)]
    emp = spark.createDataFrame(data, "y string, s int").select(
        F.concat("y", F.lit("-06-01")).cast("timestamp_ntz").alias("time"),
        F.col("s").cast("decimal(18,2)").alias("salary"))
    got = {r.year: (r.employees, r.avg_salary)
           for r in aggregates.salary_stats(emp, {"year": F.year("time")}).collect()}
    assert got == {2023: (4, 79250.0), 2024: (4, 85000.0), 2025: (3, 102333.33)}


def test_replayed_events_inflate_the_insert_fed_summary(spark):
    """1,000 events, replayed once: raw 2000, final 1000, insert-fed summary 2000."""
    from tidemark.sources.generators import keyed_events
    raw = clean.parse_times(keyed_events(spark, 1000, copies=2), "timestamp").drop("timestamp")
    final = clean.latest_by_key(raw, ["event_id"], ["ts"])
    batches = [raw.filter(F.col("event_id") % 2 == i) for i in (0, 1)]
    partials = [aggregates.partial_sums(b, ["category"], "value", "ts") for b in batches]
    summary = aggregates.merge_sums(partials[0].unionByName(partials[1]), ["category"])
    assert (raw.count(), final.count()) == (2000, 1000)
    assert summary.agg(F.sum("event_count")).first()[0] == 2000
    report = quality.duplicate_report(raw, ["event_id"]).first()
    assert (report.raw_count, report.unique_count, report.surplus_count, report.inflation) == (
        2000, 1000, 1000, 2.0)


def test_means_round_half_up(spark):
    df = spark.createDataFrame([("1209647.70",)] + [("0.00",)] * 47, "v string").select(
        F.col("v").cast("decimal(18,2)").alias("v"))
    from tidemark.functions.means import mean
    assert df.agg(mean("v").alias("m")).first().m == 25200.9938  # 25200.99375


def test_fraud_label_order(spark):
    times = [(1, f"2024-01-01 00:{i:02d}:00", 1000) for i in range(12)]
    df = spark.createDataFrame(times, "user_id int, t string, value int").select(
        "user_id", F.col("t").cast("timestamp_ntz").alias("ts"), "value")
    got = windows.fraud_alerts(df, "1 day", 1).collect()
    assert [r.risk_level for r in got] == ["Suspicious: Too many orders"]


def test_session_gap_is_inclusive(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:05:00"), (1, "2024-01-01 00:10:01")],
        "user_id int, t string").select("user_id", F.col("t").cast("timestamp_ntz").alias("ts"),
                                        F.lit(1).alias("value"))
    got = windows.user_sessions(df, 300).orderBy("session_no").collect()
    assert [(r.session_start, r.session_end, r.events_in_session) for r in got] == [
        (ts("2024-01-01T00:00:00"), ts("2024-01-01T00:05:00"), 2),
        (ts("2024-01-01T00:10:01"), ts("2024-01-01T00:10:01"), 1)]


def test_anomaly_labels(spark):
    df = spark.createDataFrame([(1, f"2024-01-{d:02d}", v) for d, v in
                                [(1, 10), (2, 10), (3, 100), (9, 1)]],
                               "user_id int, d string, v int").select(
        "user_id", F.col("d").cast("timestamp_ntz").alias("ts"),
        F.col("v").cast("decimal(18,2)").alias("v"))
    got = anomaly.flag_spending(anomaly.daily_spending(df, "v")).orderBy("day").collect()
    # the window counts rows, not days: the ninth still sees the first
    assert [r.anomaly_type for r in got] == ["NORMAL", "NORMAL", "HIGH_ANOMALY", "NORMAL"]
    assert got[3].avg_7day_spending == 30.25


# ---- changes, versions, archive, claims ----------------------------------------------------------

def test_one_status_change_gives_old_then_new(spark):
    old = spark.createDataFrame([(1, "pending"), (2, "same"), (3, "gone"), (5, None)], "id int, s string")
    new = spark.createDataFrame([(1, "shipped"), (2, "same"), (4, "new"), (5, None)], "id int, s string")
    got = changes.change_feed(old, new, ["id"], ["s"], F.lit("t")).collect()
    assert {(r.id, r.s, r.op) for r in got} == {
        (1, "pending", "UpdateDelete"), (1, "shipped", "UpdateInsert"), (3, "gone", "Delete"),
        (4, "new", "Insert")}
    assert len(got) == 4


def test_apply_changes(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], "k int, v string, n int")
    log = spark.createDataFrame([(2, "x", 2, "U"), (2, "y", 3, "U"), (3, None, 2, "D"),
                                 (4, "z", 2, "I"), (5, "q", 2, "I"), (5, None, 3, "D")],
                                "k int, v string, n int, op string")
    got = changes.apply_changes(base, log, ["k"], ["n"])
    assert rows(got) == [(1, "a", 1), (2, "y", 3), (4, "z", 2)]


def test_version_folders(spark, tables, tmp_path):
    path = f"{tmp_path}/t"
    assert versions.last_version(spark, path) == 0
    ev = tables.events().select("event_id", "user_id")
    for i in range(3):
        assert versions.write_version(ev.filter(F.col("event_id") % 3 == i), path) == i + 1
    assert versions.read_as_of(spark, path).count() == ev.count()
    assert versions.read_as_of(spark, path, 1).count() == ev.filter("event_id % 3 = 0").count()
    listed = versions.list_versions(spark, path).orderBy("v").collect()
    assert [r.v for r in listed] == [1, 2, 3]
    assert sum(r.row_count for r in listed) == ev.count() and all(r.bytes > 0 for r in listed)
    added = versions.added_between(spark.read.parquet(f"{path}/data"), 1, 3)
    assert added.count() == ev.filter("event_id % 3 > 0").count()
    # a version without manifest does not exist
    ev.write.parquet(f"{path}/data/v=4")
    assert versions.read_as_of(spark, path).count() == ev.count()


def test_snapshot_diff(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 2), (3, "z", 3)], "k int, s string, n int")
    b = spark.createDataFrame([(1, "x", None), (2, "y", None), (4, "w", 4)], "k int, s string, n int")
    diff = versions.snapshot_diff(a, b, ["k"], ["s", "n"])
    assert rows(diff) == [(2, "update"), (3, "delete"), (4, "insert")]


def test_update_and_delete(spark):
    df = spark.createDataFrame([(1, "E", "100.10"), (2, "M", "50.00"), (3, None, "1.00")],
                               "id int, d string, s string").withColumn("s", F.col("s").cast("decimal(18,2)"))
    raised = versions.update_rows(df, F.col("d") == "E", {"s": F.col("s") * F.expr("1.05BD")})
    assert [str(r.s) for r in raised.orderBy("id").collect()] == ["105.11", "50.00", "1.00"]
    assert rows(versions.delete_rows(df, F.col("d") == "M"), "id") == [(1,), (3,)]


def emp_table(spark):
    return spark.createDataFrame(
        [(1, "2023-05-01"), (2, "2024-12-31 18:00:00"), (3, "2025-01-01")], "id int, t string").select(
        "id", F.col("t").cast("timestamp_ntz").alias("time"))


def test_archive_union_prunes_branches(spark):
    parts = archive.yearly("emp", [2023, 2024, 2025], hot_from=2025)
    union = archive.archive_union({p: emp_table(spark) for p in parts})
    assert rows(union, "id", "partition", "storage") == [
        (1, "emp_2023", "archive"), (2, "emp_2024", "archive"), (3, "emp_2025", "local")]
    # the last afternoon of the year belongs to the year
    year = union.filter(parts[1].holds())
    assert rows(year, "id") == [(2,)]


def test_bound_problems():
    good = archive.yearly("emp", [2023, 2024, 2025], hot_from=2025)
    assert archive.bound_problems(good) == []
    bad = [good[0], archive.Partition("emp_2025", "2025-01-01", "2024-01-01"),
           archive.Partition("late", "2024-06-01", "2025-01-01"),
           archive.Partition("over", "2024-12-01", "2026-01-01")]
    assert sorted(archive.bound_problems(bad)) == [
        ("emp_2025", "empty range"), ("late", "gap before"), ("over", "overlap")]
    assert [p.name for p in archive.retire_partition(good, "emp_2023")] == ["emp_2024", "emp_2025"]
    with pytest.raises(KeyError):
        archive.retire_partition(good, "emp_1999")


def test_route_and_migrate(spark, tables, tmp_path):
    hot, cold = f"{tmp_path}/hot", f"{tmp_path}/cold"
    emp = tables.emp()
    archive.route_by_time(emp, hot)
    by_year = {r.year: r["count"] for r in emp.groupBy(F.year("time").alias("year")).count().collect()}
    stored = {r.year: r["count"] for r in spark.read.parquet(hot).groupBy("year").count().collect()}
    assert stored == by_year
    for _ in range(2):
        assert archive.migrate_partition(spark, hot, cold, 1997) == by_year[1997]
    left = spark.read.parquet(hot).filter("year <> 1997")
    both = left.unionByName(spark.read.parquet(cold))
    same_rows(both.drop("year"), emp)


def waiting(spark, n):
    return spark.range(n).select(
        "id", F.timestamp_seconds(F.col("id") % 7).cast("timestamp_ntz").alias("ts"),
        F.lit(False).alias("processed"))


def test_work_gate_is_strict(spark):
    assert not claims.work_ready(waiting(spark, 100))
    assert claims.work_ready(waiting(spark, 101))


def test_claims_are_disjoint_and_drain_the_queue(spark):
    df, ledger, seen = waiting(spark, 250), None, []
    for run in range(3):
        batch = claims.claim_batch(claims.pending(df, ledger), 4, 25)
        got = batch.select("id", "worker").collect()
        per_worker = {}
        for r in got:
            per_worker.setdefault(r.worker, []).append(r.id)
        assert all(len(v) <= 25 for v in per_worker.values())
        seen += [r.id for r in got]
        done = spark.createDataFrame([(r.id, run) for r in got], "id long, run int")
        ledger = done if ledger is None else ledger.unionByName(done)
    assert sorted(seen) == list(range(250))
    assert claims.double_processing(ledger).count() == 0
    marked = claims.mark_processed(df, ledger)
    assert marked.filter("processed").count() == 250
    same_rows(claims.mark_processed(marked, ledger), marked)
    assert claims.double_processing(ledger.unionByName(ledger.withColumn("run", F.lit(9)))).count() == 250


# ---- market and quality --------------------------------------------------------------------------

def test_backfill_of_a_month(spark):
    """31 days: 22 trading days, 9 empty days."""
    spine = market.backfill_range(spark, "2025-01-31", "2025-01-01")  # swapped ends
    trading = spine.filter(F.dayofweek("day").between(2, 6)).filter("day <> '2025-01-01'")
    counts = market.day_counts(trading.withColumnRenamed("day", "en_date"))
    got = market.backfill_summary(market.backfill_days(spine, counts)).first()
    assert (got.dates_processed, got.trading_days, got.empty_days, got.status) == (
        31, 22, 9, "completed")
    failed = spark.createDataFrame([(dt.date(2025, 1, 1),)], "day date")
    got = market.backfill_summary(market.backfill_days(spine, counts), failed).first()
    assert (got.empty_days, got.failures, got.status) == (8, 1, "completed_with_failures")


def test_backfill_bounds():
    today = dt.date(2025, 3, 31)
    assert market.backfill_bounds(today=today) == ("2025-03-01", "2025-03-31")
    assert market.backfill_bounds("2025-02-02", "2025-01-01", today) == ("2025-01-01", "2025-02-02")


def test_gap_report_finds_missing_days(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-03"), ("b", "2024-01-02")],
                               "k string, t string").select("k", F.col("t").cast("timestamp_ntz").alias("ts"))
    got = quality.daily_gaps(df, "k", "2024-01-01", "2024-01-03")
    assert [(r.k, r.day.day) for r in got.orderBy("k", "day").collect()] == [
        ("a", 2), ("b", 1), ("b", 3)]


def test_rules_on_empty_input(spark):
    df = spark.createDataFrame([], "a int")
    got = quality.rule_report(df, {"a_set": F.col("a").isNotNull()}).first()
    assert (got.rule, got.violations, got.checked) == ("a_set", 0, 0)
    empty = quality.duplicate_report(df, ["a"]).first()
    assert (empty.raw_count, empty.unique_count, empty.inflation) == (0, 0, None)


# ---- benchmark statistics ------------------------------------------------------------------------

def test_single_run_has_no_deviation(spark):
    df = spark.createDataFrame([("t", True, 2.0, 1, 4.0), ("u", False, 1.0, 1, 4.0)],
                               "target string, success boolean, time_sec double, size_mb int, "
                               "wall_time_sec double")
    got = {r.target: r for r in benchstats.latency_summary(df, ["target"]).collect()}
    t, u = got["t"], got["u"]
    assert (t.successful, t.latency_p95, t.latency_stdev, t.throughput_mbps) == (1, 2.0, 0.0, 0.25)
    assert (u.failed, u.latency_p50, u.latency_mean, u.throughput_mbps) == (1, None, None, 0.0)
    runs = benchstats.aggregate_runs(benchstats.latency_summary(df, ["target"]), ["target"],
                                     ["latency_p95"]).collect()
    assert [(r.target, r.num_runs, r.stdev) for r in runs] == [("t", 1, 0.0)]


def test_scorecard_counts_wins(spark):
    df = spark.createDataFrame([("a", 1.0, 10.0), ("b", 2.0, 30.0), ("c", 1.0, 20.0)],
                               "target string, p50 double, rate double")
    got = benchstats.scorecard(df, "target", {"latency": ("p50", True), "rate": ("rate", False)})
    assert rows(got) == [("a", 1, 2), ("b", 1, 2), ("c", 0, 2)]


def test_driver_compare(spark):
    df = spark.createDataFrame([("m", "PSYCO", 1.0), ("m", "PSYCO", 3.0), ("m", "ADB", 1.0)],
                               "mode string, driver string, avg double")
    got = benchstats.driver_compare(df, ["mode"], "psyco", "adb").first()
    assert (got.first_mean, got.second_mean, got.winner, got.lead_pct) == (2.0, 1.0, "adb", 50.0)


def test_null_moves_are_changes(spark):
    cols = "k int, a int, b int"
    old = spark.createDataFrame([(1, 5, None), (2, None, None), (3, 1, 2)], cols)
    new = spark.createDataFrame([(1, None, 5), (2, None, None), (3, 1, 2)], cols)
    assert [tuple(r) for r in versions.snapshot_diff(old, new, ["k"], ["a", "b"]).collect()] == [
        (1, "update")]
    assert archive.content_check(old, ["k", "a", "b"]) != archive.content_check(
        new, ["k", "a", "b"])


def test_published_bands_and_overlaps(spark):
    vals = spark.createDataFrame(
        [("0.00",), ("10000.00",), ("10000.01",), ("50000.00",), ("50000.01",), ("1000000",)],
        "s string").select(F.col("s").cast("decimal(18,2)").alias("v"))
    got = enrich.join_bands(vals, "v", files.risk_bands(spark)).orderBy("v")
    assert [r.risk_level for r in got.collect()] == [
        "Low", "Low", "Medium", "Medium", "High", None]
    many = spark.createDataFrame([(f"b{i}", -2000 + 2 * i, -1999 + 2 * i) for i in range(2000)]
                                 + [("all", -5000, 5000)],
                                 "risk_level string, threshold_min int, threshold_max int")
    points = spark.createDataFrame([(-2000,), (-1,), (0,), (777,), (4000,)], "v int")
    got = enrich.join_bands(points, "v", many).groupBy("v").count().orderBy("v")
    assert [r["count"] for r in got.collect()] == [2, 2, 2, 2, 1]


def test_means_of_large_values(spark):
    df = spark.createDataFrame([(1e12,), (2e12,), (1e15,)], "x double")
    assert df.select(means.mean_of_doubles("x").alias("m")).first().m == 334333333333333.3333


def test_rows_outside_all_years_are_kept(spark):
    df = spark.createDataFrame([("1990-05-05",), ("2001-01-01",), (None,)], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("time"))
    assert list(archive.years_of(df)) == list(range(1990, 2002))
    parts = archive.yearly("p", [2001], 2000)
    got = archive.label_partitions(df, parts).orderBy(F.col("time").asc_nulls_last()).collect()
    assert [(r.partition, r.storage) for r in got] == [
        ("default", "default"), ("p_2001", "local"), ("default", "default")]
    assert archive.rest_of(df, parts).count() == 2
    assert list(archive.years_of(df.limit(0))) == []
