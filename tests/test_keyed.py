"""Tables that grow batch by batch: merged runs, ledgers, joins kept up to date, commits, claims."""

import os

import pytest
from pyspark.sql import functions as F
from streamkit import same_rows

from tidemark.operators import changes, claims, snapshots, versions
from tidemark.operators.aggregates import merge_sums
from tidemark.sources import paths, streams
from tidemark.streaming import pipelines as p
from tidemark.streaming import sinks, state
from tidemark.streaming.keyed import KeyedRuns


def test_runs_are_merged_level_by_level(spark, tmp_path):
    """What a batch writes does not grow with the batches before it."""
    runs = KeyedRuns(spark, f"{tmp_path}/t", ["k"], buckets=4, fan=3)
    for b in range(10):
        runs.put(spark.range(3).select((F.col("id") + 3 * b).alias("k"), F.lit(b).alias("b")), b)
        left = runs.runs()
        assert len(left) <= 2 * 3 and left[0].first == 0 and left[-1].last == b
        assert all(x.last + 1 == y.first for x, y in zip(left, left[1:]))
        assert runs.read().count() == 3 * (b + 1)
        # a repeated batch finds what there was before it and replaces its own rows
        assert runs.read(before=b).count() == 3 * b if b else runs.read(before=0) is None
        runs.put(spark.range(3).select((F.col("id") + 3 * b).alias("k"), F.lit(b).alias("b")), b)
        assert runs.read().count() == 3 * (b + 1)
    assert [(r.level, r.first, r.last) for r in runs.runs()] == [(2, 0, 8), (0, 9, 9)]
    assert len([n for n in os.listdir(f"{tmp_path}/t") if n.startswith("run=")]) <= 4
    assert runs.compact() == 9 and len(runs.runs()) == 1 and runs.read().count() == 30


def test_only_touched_buckets_are_read(spark, tmp_path):
    runs = KeyedRuns(spark, f"{tmp_path}/t", ["k"], buckets=64)
    runs.put(spark.range(1000).select(F.col("id").alias("k")), 0)
    asked = spark.createDataFrame([(7,)], "k long")
    mine = runs.read(of=asked)
    assert 0 < mine.count() < 60 and mine.filter("k = 7").count() == 1
    assert "bucket" in mine._jdf.queryExecution().executedPlan().toString()


def test_upsert_forgets_deleted_keys_when_nothing_older_is_left(spark, tmp_path):
    table = sinks.UpsertTable(spark, f"{tmp_path}/t", ["k"], ["seq"], buckets=4, fan=2)
    rows = [(1, 1, "I", "a"), (2, 1, "I", "b")], [(1, 2, "D", None), (3, 1, "I", "c")], \
        [(2, 3, "U", "B")], [(1, 4, "I", "again")]
    log = None
    for b, batch in enumerate(rows):
        df = spark.createDataFrame(batch, "k int, seq int, op string, v string")
        log = df if log is None else log.union(df)
        table.write(df, b)
        same_rows(table.read(), changes.current_state(log, ["k"], ["seq"]))
        if b == 1:
            assert table.runs.read().filter("op = 'D'").count() == 0


def test_ledger_reads_few_buckets(spark, tmp_path, monkeypatch):
    ledger = sinks.key_ledger(spark, f"{tmp_path}/l", ["id"], buckets=64)
    for b in range(3):
        ledger.put(spark.range(1000).select((F.col("id") + 1000 * b).alias("id")), b)
    opened = []
    read = KeyedRuns._read
    monkeypatch.setattr(KeyedRuns, "_read", lambda self, runs, schema, buckets=None:
                        opened.append(buckets) or read(self, runs, schema, buckets))
    new = spark.range(100).select((F.col("id") + 10**6).alias("id"))
    assert ledger.known(new).count() == 0
    assert sum(len(b) for b in opened) < 30, "a filter lets about one key in a hundred through"
    opened.clear()
    some = spark.createDataFrame([(5,), (1500,), (2999,), (10**7,)], "id long")
    assert sorted(r.id for r in ledger.known(some).collect()) == [5, 1500, 2999]
    assert sum(len(b) for b in opened) <= 6
    assert sorted(r.id for r in ledger.known(some, before=2).collect()) == [5, 1500]
    nulls = spark.createDataFrame([(None,)], "id long")
    assert ledger.known(nulls).count() == 0


def test_first_seen_keeps_the_earliest_row_whenever_it_came(spark, tmp_path):
    write = sinks.first_seen(f"{tmp_path}/f", ["k"], ["ts", "id"], buckets=4, fan=2)
    batches = [[(1, 10, 1), (1, 10, 0), (2, 11, 2)], [(1, 9000, 3), (3, 9001, 4), (None, 9002, 5)],
               [(3, 10**8, 6), (None, 10**8, 7), (4, 10**8, 8)]]
    for b, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "k int, ts long, id int")
        write(df, b)
        write(df, b)
    got = spark.read.parquet(f"{tmp_path}/f/rows").select("k", "ts", "id").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, 10, 0), (2, 11, 2), (3, 9001, 4), (None, 9002, 5), (4, 10**8, 8)], key=str)


def test_left_join_kept_up_to_date(spark, tmp_path):
    """Unmatched rows come out, are taken back when a match arrives, and a hot id holds a third."""
    join = state.LeftJoin(
        spark, f"{tmp_path}/j", "k",
        lambda df: df.filter("side = 'l'").select("k", F.col("v").alias("lv")),
        lambda df: df.filter("side = 'r'").select("k", F.col("v").alias("rv")), buckets=4, fan=2)
    every = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
            F.col("id") % 90).cast("int").alias("k"),
        F.when(F.xxhash64("id") % 4 == 0, "r").otherwise("l").alias("side"),
        (F.col("id") % 7).alias("v"), F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(5)).alias("batch")).cache()
    for b in range(5):
        df = every.filter(F.col("batch") == b).drop("batch")
        join.write(df, b)
        if b in (1, 4):
            join.write(df, b)  # a repeated batch
        so_far = every.filter(F.col("batch") <= b)
        left = so_far.filter("side = 'l'").select("k", F.col("v").alias("lv"))
        right = so_far.filter("side = 'r'").select("k", F.col("v").alias("rv"))
        same_rows(join.read(), left.join(right, "k", "left"))
    log = join.changes()
    assert log.filter("sign < 0").count() > 0 and log.filter("sign < 0 and rv is not null").count() == 0
    assert join.read().filter("rv is null").count() > 0


def test_left_join_counts_only_what_can_be_taken_back(spark, tmp_path):
    """Rows with something from the right pass as they are; right rows that are null are still there."""
    join = state.LeftJoin(
        spark, f"{tmp_path}/j", "k",
        lambda df: df.filter("side = 'l'").select("k", F.col("v").alias("lv")),
        lambda df: df.filter("side = 'r'").select("k", F.col("v").alias("rv")), buckets=2)
    batches = [[(1, "l", 1), (1, "l", 1), (2, "l", 5), (3, "l", None)],
               [(1, "r", None), (1, "r", 7), (1, "r", 7), (3, "r", None), (None, "l", 4)],
               [(3, "r", None), (2, "r", 8), (4, "r", 9)]]
    rows = []
    for i, batch in enumerate(batches):
        rows += batch
        join.write(spark.createDataFrame(batch, "k int, side string, v int"), i)
        so_far = spark.createDataFrame(rows, "k int, side string, v int")
        left = so_far.filter("side = 'l'").select("k", F.col("v").alias("lv"))
        right = so_far.filter("side = 'r'").select("k", F.col("v").alias("rv"))
        same_rows(join.read(), left.join(right, "k", "left"))
    plan = join.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Union" in plan
    assert "isnull(rv" in plan[plan.index("Aggregate"):]


def test_a_crash_between_two_tables_shows_neither(spark, tmp_path, monkeypatch):
    store = sinks.summary_and_rows(spark, f"{tmp_path}/s", ["k"], "v", "ts")
    df = spark.createDataFrame([(1, 2, 3), (1, 4, 5), (2, 6, 7)], "k int, v int, ts int")

    def check(times):
        assert store.read("rows").count() == 3 * times
        sums = merge_sums(store.read("sums").drop("batch_id"), ["k"]).orderBy("k").collect()
        assert [(r.k, r.event_count, r.total_value) for r in sums] == [
            (1, 2 * times, 6 * times), (2, times, 6 * times)]

    assert store.read("rows") is None
    store.write(df, 0)
    check(1)
    good = store.tables["sums"]
    store.tables["sums"] = lambda rows: 1 / 0
    with pytest.raises(ZeroDivisionError):
        store.write(df, 1)
    assert os.path.exists(f"{tmp_path}/s/rows/batch_id=1")
    check(1)
    store.tables["sums"] = good
    store.write(df, 1)
    store.write(df, 1)
    check(2)


def test_file_versions_share_files(spark, tmp_path):
    store = snapshots.FileVersions(spark, f"{tmp_path}/v", "id")
    rows = spark.range(1000).select("id", (F.col("id") % 10).alias("v"))
    assert store.create(rows, 10) == 1
    files = len(store.files(1))
    assert files >= 8 and sum(f["rows"] for f in store.files(1)) == 1000
    assert store.update((F.col("id") >= 100) & (F.col("id") < 120), {"v": F.col("v") + 1}) == 2
    assert store.delete(F.col("id") == 5) == 3
    assert store.append(spark.createDataFrame([(5000, 1)], "id long, v long")) == 4
    assert store.update(F.col("id") < 0, {"v": F.lit(0)}) == 5
    old, new = store.unshared(1, 2)
    assert 1 <= len(old) <= 2 and len(new) >= 1, "one change, few files"
    diff = store.diff(1, 2, ["v"])
    assert len(diff.inputFiles()) == len(old) + len(new)
    assert sorted(map(tuple, diff.collect())) == [(i, "update") for i in range(100, 120)]
    whole = versions.snapshot_diff(store.read(1), store.read(4), ["id"], ["v"])
    same_rows(store.diff(1, 4, ["v"]), whole)
    assert store.diff(4, 5, ["v"]).count() == 0 and store.unshared(4, 5) == ([], [])
    assert store.read(1).count() == 1000 and store.read().count() == 1000


def test_claimers_from_one_state_get_disjoint_rows(spark, tmp_path):
    log = claims.ClaimLog(spark, f"{tmp_path}/c")
    waiting = spark.range(40).select("id", F.lit(False).alias("processed"))
    pick = lambda rows: rows.orderBy("id").limit(10).select("id")
    one = log.claim(waiting, pick, seen=0)
    two = log.claim(waiting, pick, seen=0)  # started from the same state, came second
    three = log.claim(waiting, pick)
    assert [n for n, _ in (one, two, three)] == [1, 2, 3]
    assert [sorted(r.id for r in rows.collect()) for _, rows in (one, two, three)] == [
        list(range(10)), list(range(10, 20)), list(range(20, 30))]
    assert log.read().select("id").distinct().count() == 30
    assert not paths.create_once(spark, f"{tmp_path}/c/_log/2", "x")
    assert log.read().count() == 30


def test_replay_in_order_and_in_bounded_triggers(spark, tmp_path):
    rows = spark.range(1000).select(
        "id", F.timestamp_seconds((F.col("id") * 7919 % 1000) * 60).cast("timestamp_ntz").alias("ts"))
    rows = rows.withColumn("ts", F.when(F.col("id") % 100 > 0, F.col("ts")))
    seen = []

    def note(df, n):
        seen.append(df.agg(F.count("*"), F.count("ts"), F.min("ts"), F.max("ts")).first())

    sinks.run(streams.replay(rows, f"{tmp_path}/in", "ts", 5, "10 days"), f"{tmp_path}/cp", each=note)
    assert len(seen) == 6 and sum(s[0] for s in seen) == 1001 and seen[-1][0] == 1
    assert sum(s[1] for s in seen[1:]) == sum(s[0] for s in seen[1:]), "those without a time come first"
    assert all(a[3] < b[2] for a, b in zip(seen, seen[1:]))
    assert max(s[0] for s in seen) < 300
    empty = streams.replay(rows.limit(0), f"{tmp_path}/none", "ts", 3, "1 day")
    sinks.run(empty, f"{tmp_path}/cp2", each=sinks.append_batches(f"{tmp_path}/out"))


def test_late_rows_of_every_batch_count(spark, tmp_path):
    """More batches than a query keeps reports of; the late row is in an early one."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        folder = f"{tmp_path}/in"
        hours = [100, 110, 120, 1, 200, 300, 400, 500, 600]
        for i, h in enumerate(hours):
            spark.createDataFrame([(i, h * 3600)], "id int, s long").select(
                "id", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.parquet(f"{folder}/{i}")
        stream = spark.readStream.schema("id int, ts timestamp").option(
            "maxFilesPerTrigger", "1").parquet(f"{folder}/*")
        out = p.hop(p.with_event_time(stream, "1 hour"), "1 hour", "1 hour", ["id"],
                    {"n": F.count("*")})
        q = sinks.run(out, f"{tmp_path}/cp", each=sinks.append_batches(f"{tmp_path}/out"),
                      drop_late=True)
        assert len(q.recentProgress) <= 2 and sinks.late_rows(q) == 1
        with pytest.raises(RuntimeError, match="1 rows came after"):
            sinks.run(out, f"{tmp_path}/cp2", each=sinks.append_batches(f"{tmp_path}/out2"))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
