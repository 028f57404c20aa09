"""Queries over change logs, change feeds, versions, the yearly archive and the work ledger."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import means
from ..operators import aggregates as agg
from ..operators import archive, changes, claims, enrich, versions
from ..sources import files
from ..sources.tables import Tables
from .registry import plan
from .sqltext import avg4, dbl, with_views

T0, T1, T2 = "2024-01-03 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00"


# ---- change-captured state -----------------------------------------------------------------------

@plan("cdc_current_state", with_views(
    "state", f"SELECT user_id, ts, event_id, event_type, {dbl('value')} AS value FROM state"))
def cdc_current_state(t: Tables):
    return changes.current_state(t.change_log().drop("props"), ["user_id"], ["ts", "event_id"])


@plan("cdc_enriched", with_views("orders_raw state", f"""
    SELECT order_id, line, user_id, qty, event_type AS user_status, {dbl('value')} AS unit_price,
           {dbl('CAST(qty * value AS DECIMAL(18,2))')} AS total_amount
    FROM orders_raw LEFT JOIN state USING (user_id)"""))
def cdc_enriched(t: Tables):
    state = cdc_current_state(t).select(
        "user_id", F.col("event_type").alias("user_status"), F.col("value").alias("unit_price"))
    joined = enrich.enrich_from_state(t.orders_raw(price=False), state, "user_id", "unit_price")
    return joined.select("order_id", "line", "user_id", "qty", "user_status", "unit_price",
                         "total_amount")


@plan("apply_changes", with_views("change_log", f"""
    SELECT user_id, event_type, {dbl('value')} AS value FROM base
    WHERE user_id NOT IN (SELECT user_id FROM change_log WHERE ts > TIMESTAMP '{T1}')
    UNION ALL SELECT user_id, event_type, {dbl('value')} FROM fresh WHERE op <> 'D'""",
    base=f"""SELECT * FROM (SELECT DISTINCT ON (user_id) * FROM change_log
        WHERE ts <= TIMESTAMP '{T1}' ORDER BY user_id, ts DESC, event_id DESC) WHERE op <> 'D'""",
    fresh=f"""SELECT DISTINCT ON (user_id) * FROM change_log WHERE ts > TIMESTAMP '{T1}'
        ORDER BY user_id, ts DESC, event_id DESC"""))
def apply_changes(t: Tables):
    log, cut = t.change_log().drop("props"), F.lit(T1).cast("timestamp_ntz")
    base = changes.current_state(log.filter(F.col("ts") <= cut), ["user_id"], ["ts", "event_id"])
    out = changes.apply_changes(base, log.filter(F.col("ts") > cut), ["user_id"],
                                ["ts", "event_id"])
    return out.select("user_id", "event_type", "value")


def status_at(t: Tables, as_of: str) -> DataFrame:
    """Last event type of every user; a user in error has no status."""
    state = changes.state_as_of(t.events(), "user_id", "event_type", ["ts", "event_id"], as_of)
    return state.filter(F.col("event_type") != "error").select(
        "user_id", F.col("event_type").alias("status"))


def status_change(t: Tables, old: str, new: str) -> DataFrame:
    return changes.change_feed(status_at(t, old), status_at(t, new), ["user_id"], ["status"],
                               F.lit(new).cast("timestamp_ntz"))


STATUS = """SELECT user_id, event_type AS status FROM (SELECT DISTINCT ON (user_id) * FROM ev
    WHERE ts <= TIMESTAMP '{at}' ORDER BY user_id, ts DESC, event_id DESC)
    WHERE event_type <> 'error'"""
FEED = """SELECT user_id, status, op, TIMESTAMP '{at}' AS changed_at FROM (
    SELECT user_id, a.status AS status, CASE WHEN b.user_id IS NULL THEN 'Delete'
           ELSE 'UpdateDelete' END AS op
    FROM {a} a LEFT JOIN {b} b USING (user_id)
    WHERE b.user_id IS NULL OR a.status <> b.status
    UNION ALL SELECT user_id, b.status, CASE WHEN a.user_id IS NULL THEN 'Insert'
           ELSE 'UpdateInsert' END
    FROM {b} b LEFT JOIN {a} a USING (user_id)
    WHERE a.user_id IS NULL OR a.status <> b.status)"""
FEED_CTES = {"s0": STATUS.format(at=T0), "s1": STATUS.format(at=T1), "s2": STATUS.format(at=T2),
             "f1": FEED.format(a="s0", b="s1", at=T1), "f2": FEED.format(a="s1", b="s2", at=T2)}


@plan("change_feed", with_views("ev", "SELECT * FROM f1", **FEED_CTES))
def change_feed(t: Tables):
    return status_change(t, T0, T1)


@plan("new_status_notifications", with_views(
    "ev", "SELECT user_id, status, changed_at FROM f1 WHERE op = 'UpdateInsert'", **FEED_CTES))
def new_status_notifications(t: Tables):
    return changes.new_status_notifications(change_feed(t))


@plan("feed_snapshot_then_changes", with_views("ev", f"""
    SELECT user_id, status, 'Insert' AS op, TIMESTAMP '{T1}' AS changed_at,
           CAST(0 AS INTEGER) AS phase FROM s1
    UNION ALL SELECT user_id, status, op, changed_at, 1 FROM (
        SELECT * FROM f1 UNION ALL SELECT * FROM f2)
    WHERE changed_at >= TIMESTAMP '{T2}' - INTERVAL 3 DAY""", **FEED_CTES))
def feed_snapshot_then_changes(t: Tables):
    feed = change_feed(t).unionByName(status_change(t, T1, T2))
    snapshot = changes.snapshot_rows(status_at(t, T1), F.lit(T1).cast("timestamp_ntz"))
    return changes.feed_with_snapshot(snapshot, feed, T2, "3 days")


@plan("feed_stats", with_views("ev", """
    SELECT op, COUNT(*) AS event_count, MAX(changed_at) AS last_event
    FROM (SELECT * FROM f1 UNION ALL SELECT * FROM f2) GROUP BY 1""", **FEED_CTES))
def feed_stats(t: Tables):
    return changes.feed_stats(change_feed(t).unionByName(status_change(t, T1, T2)))


LOG_FEED = """
    SELECT user_id, ts, event_id, event_type, 'Insert' AS op FROM l WHERE prev IS NULL
    UNION ALL SELECT user_id, ts, event_id, prev, 'UpdateDelete' FROM l WHERE prev <> event_type
    UNION ALL SELECT user_id, ts, event_id, event_type, 'UpdateInsert' FROM l
    WHERE prev <> event_type"""
LOG_LAG = """SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
    FROM ev"""


@plan("change_feed_log", with_views("ev", LOG_FEED, l=LOG_LAG))
def change_feed_log(t: Tables):
    log = t.events().select("user_id", "ts", "event_id", "event_type")
    return changes.feed_from_log(log, ["user_id"], ["ts", "event_id"], "event_type")


# ---- versions ------------------------------------------------------------------------------------

@plan("read_as_of", with_views(
    "versions", f"SELECT v, event_id, user_id, {dbl('value')} AS value FROM versions WHERE v <= 10"))
def read_as_of(t: Tables):
    return versions.visible_at(t.versions(), 10).select("v", "event_id", "user_id", "value")


@plan("version_counts", with_views("versions", f"""
    SELECT CAST(version AS INTEGER) AS version, COUNT(*) AS row_count,
           {dbl('SUM(value)')} AS total_value
    FROM versions JOIN (VALUES (0), (5), (10), (20), (29)) AS n(version) ON v <= version
    GROUP BY 1"""))
def version_counts(t: Tables):
    return versions.version_counts(t.versions(), [0, 5, 10, 20, 29])


@plan("list_versions", with_views(
    "versions", "SELECT v, COUNT(*) AS row_count FROM versions GROUP BY 1"))
def list_versions(t: Tables):
    return versions.version_sizes(t.versions())


@plan("added_between", with_views(
    "versions", f"""SELECT v, event_id, user_id, {dbl('value')} AS value FROM versions
    WHERE v > 10 AND v <= 12"""))
def added_between(t: Tables):
    return versions.added_between(t.versions(), 10, 12).select("v", "event_id", "user_id", "value")


def order_totals(t: Tables, where) -> DataFrame:
    return t.line_items().filter(where).groupBy("order_id").agg(
        F.sum("amount").alias("amount"), F.count("*").alias("line_count"))


@plan("snapshot_diff", with_views("line_items", """
    SELECT order_id, CASE WHEN o.s IS NULL THEN 'insert' WHEN n.s IS NULL THEN 'delete'
           ELSE 'update' END AS change
    FROM o FULL JOIN n USING (order_id)
    WHERE o.s IS NULL OR n.s IS NULL OR o.s <> n.s OR o.c <> n.c""",
    o="""SELECT order_id, SUM(amount) AS s, COUNT(*) AS c FROM line_items
         WHERE ts < TIMESTAMP '2000-01-01' GROUP BY 1""",
    n="""SELECT order_id, SUM(amount) AS s, COUNT(*) AS c FROM line_items
         WHERE ts >= TIMESTAMP '1998-01-01' GROUP BY 1"""))
def snapshot_diff(t: Tables):
    old = order_totals(t, F.col("ts") < F.lit("2000-01-01").cast("timestamp_ntz"))
    new = order_totals(t, F.col("ts") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return versions.snapshot_diff(old, new, ["order_id"], ["amount", "line_count"])


@plan("snapshot_diff_counts", with_views("line_items", """
    SELECT CASE WHEN o.s IS NULL THEN 'insert' WHEN n.s IS NULL THEN 'delete'
           ELSE 'update' END AS change, COUNT(*) AS row_count
    FROM o FULL JOIN n USING (order_id)
    WHERE o.s IS NULL OR n.s IS NULL OR o.s <> n.s OR o.c <> n.c GROUP BY 1""",
    o="""SELECT order_id, SUM(amount) AS s, COUNT(*) AS c FROM line_items
         WHERE ts < TIMESTAMP '2000-01-01' GROUP BY 1""",
    n="""SELECT order_id, SUM(amount) AS s, COUNT(*) AS c FROM line_items
         WHERE ts >= TIMESTAMP '1998-01-01' GROUP BY 1"""))
def snapshot_diff_counts(t: Tables):
    return versions.diff_counts(snapshot_diff(t))


@plan("update_rows", with_views("emp", f"""
    SELECT id, department, time, {dbl('''CASE WHEN department = '1-URGENT'
        AND time >= TIMESTAMP '2000-01-01' THEN CAST(salary * 1.05 AS DECIMAL(18,2))
        ELSE salary END''')} AS salary FROM emp"""))
def update_rows(t: Tables):
    where = (F.col("department") == "1-URGENT") & (
        F.col("time") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    raised = versions.update_rows(t.emp(), where,
                                  {"salary": F.col("salary") * F.expr("1.05BD")})
    return raised.select("id", "department", "time", "salary")


@plan("delete_rows", with_views("emp", f"""
    SELECT id, department, time, {dbl('salary')} AS salary FROM emp
    WHERE NOT (department = '5-LOW' AND time < TIMESTAMP '1997-01-01')"""))
def delete_rows(t: Tables):
    where = (F.col("department") == "5-LOW") & (
        F.col("time") < F.lit("1997-01-01").cast("timestamp_ntz"))
    return versions.delete_rows(t.emp(), where).select("id", "department", "time", "salary")


# ---- archive -------------------------------------------------------------------------------------

HOT_FROM = 2000
PART_SQL = f"""coalesce('emp_' || year(time), 'default') AS partition,
    CASE WHEN time IS NULL THEN 'default' WHEN year(time) >= {HOT_FROM} THEN 'local'
         ELSE 'archive' END AS storage"""


def registry(t: Tables) -> list[archive.Partition]:
    """A partition per year from the first to the last row of the table."""
    return archive.yearly("emp", archive.years_of(t.emp()), hot_from=HOT_FROM)


def hot_and_cold(t: Tables) -> DataFrame:
    """The archive as two stores, each read once and pruned to its own range; rows without a time are
    found in the cold one."""
    edge = F.lit(f"{HOT_FROM}-01-01").cast("timestamp_ntz")
    cold = t.emp().filter((F.col("time") < edge) | F.col("time").isNull())
    hot = t.emp().filter(F.col("time") >= edge)
    return archive.label_years(cold.unionByName(hot), "emp", HOT_FROM)


@plan("archive_union", with_views("emp", f"""
    SELECT id, time, department, {dbl('salary')} AS salary, {PART_SQL} FROM emp"""))
def archive_union(t: Tables):
    return hot_and_cold(t).select("id", "time", "department", "salary", "partition", "storage")


@plan("archive_range_stats", with_views("emp", f"""
    SELECT {PART_SQL}, department, COUNT(*) AS employees, {avg4('salary', 2)} AS avg_salary
    FROM emp WHERE time >= TIMESTAMP '1999-07-01' AND time < TIMESTAMP '2000-07-01'
    GROUP BY 1, 2, 3"""))
def archive_range_stats(t: Tables):
    part = archive.Partition("asked", "1999-07-01", "2000-07-01")
    asked = hot_and_cold(t).filter(part.holds())
    return asked.groupBy("partition", "storage", "department").agg(
        F.count("*").alias("employees"), means.mean("salary", 2).alias("avg_salary"))


@plan("archive_health", with_views("emp", f"""
    SELECT {PART_SQL}, COUNT(*) AS row_count, MIN(time) AS earliest, MAX(time) AS latest
    FROM emp GROUP BY 1, 2"""))
def archive_health(t: Tables):
    return archive.archive_health(archive.label_years(t.emp(), "emp", HOT_FROM))


@plan("partition_gaps", with_views("emp", """
    SELECT id, time FROM emp WHERE year(time) IN (1998, 2001)"""))
def partition_gaps(t: Tables):
    """Rows no partition accepts, under bounds with a missing and a reversed year."""
    broken = [p for p in registry(t) if p.name not in ("emp_1998", "emp_2001")]
    broken.append(archive.Partition("emp_2001", "2001-01-01", "2000-01-01"))
    return archive.rows_out_of_bounds(t.emp(), broken).select("id", "time")


@plan("missing_periods", with_views("emp", """
    SELECT day AS period FROM (SELECT unnest(generate_series(
        (SELECT date_trunc('day', MIN(time)) FROM few), (SELECT date_trunc('day', MAX(time)) FROM few),
        INTERVAL 1 DAY)) AS day)
    WHERE day NOT IN (SELECT date_trunc('day', time) FROM few)""",
    few="SELECT time FROM emp WHERE department = '1-URGENT'"))
def missing_periods(t: Tables):
    """Days between the first and the last urgent order without one."""
    return archive.missing_periods(t.emp().filter("department = '1-URGENT'"), "day")


TABLES = ("benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
          "lineitem", "nation", "orders", "pages", "part", "region", "supplier")


def inventory(t: Tables) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        files.file_inventory(t.raw(n)).withColumn("table_name", F.lit(n)) for n in TABLES])


@plan("file_inventory", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS row_count, CAST(1 AS INTEGER) AS has_bytes FROM {n}"
    for n in TABLES))
def file_inventory(t: Tables):
    return inventory(t).groupBy("table_name").agg(
        F.sum("row_count").alias("row_count"),
        F.min(F.when(F.col("bytes") > 0, 1).otherwise(0)).alias("has_bytes"))


@plan("storage_report", " UNION ALL ".join(
    f"SELECT '{n}' AS part, COUNT(*) AS row_count, CAST(1 AS INTEGER) AS has_files, "
    f"CAST(1 AS INTEGER) AS has_bytes FROM {n}" for n in TABLES))
def storage_report(t: Tables):
    """SQL sees no files, so sizes are shown as flags here; the operator gives the numbers."""
    report = files.storage_report(inventory(t), F.col("table_name"))
    return report.select("part", "row_count", (F.col("files") > 0).cast("int").alias("has_files"),
                         (F.col("bytes") > 0).cast("int").alias("has_bytes"))


@plan("lookup_row_location", with_views("emp", f"""
    SELECT {PART_SQL}, COUNT(*) AS row_count, COUNT(*) AS located, COUNT(*) AS positions
    FROM emp GROUP BY 1, 2"""))
def lookup_row_location(t: Tables):
    stored = files.row_location(t.raw("orders")).withColumnRenamed("o_orderdate", "time")
    placed = archive.label_partitions(stored, registry(t))
    return placed.groupBy("partition", "storage").agg(
        F.count("*").alias("row_count"), F.count("file_path").alias("located"),
        F.count_distinct("file_path", "row_index").alias("positions"))


# ---- work claiming -------------------------------------------------------------------------------

WORKERS, PER_WORKER = 4, 100
CLAIM = f"""SELECT id, user_id, ts, CAST(amount AS DOUBLE) AS amount, worker, position FROM (
    SELECT *, CAST(id % {WORKERS} AS INTEGER) AS worker, CAST(row_number() OVER (
        PARTITION BY id % {WORKERS} ORDER BY ts, id) AS INTEGER) AS position
    FROM {{source}}) WHERE position <= {PER_WORKER}"""
WAITING = "SELECT * FROM transactions WHERE NOT processed"


def claim(waiting: DataFrame) -> DataFrame:
    out = claims.claim_batch(waiting, WORKERS, PER_WORKER,
                             bucket=(F.col("id") % WORKERS).cast("int"))
    return out.drop("processed")


@plan("work_ready", with_views("transactions", """
    SELECT COUNT(*) AS waiting, CAST(CASE WHEN COUNT(*) > 100 THEN 1 ELSE 0 END AS INTEGER) AS ready
    FROM transactions WHERE NOT processed"""))
def work_ready(t: Tables):
    return claims.work_ready_report(t.transactions(), 100)


@plan("claim_batch", with_views("transactions", CLAIM.format(source="w"), w=WAITING))
def claim_batch(t: Tables):
    return claim(claims.pending(t.transactions()))


@plan("claim_next_batch", with_views(
    "transactions", CLAIM.format(source="rest"), w=WAITING, first=CLAIM.format(source="w"),
    rest="SELECT * FROM w WHERE id NOT IN (SELECT id FROM first)"))
def claim_next_batch(t: Tables):
    return claim(claims.pending(t.transactions(), claim_batch(t)))


@plan("mark_processed", with_views("transactions", f"""
    SELECT id, user_id, ts, {dbl('amount')} AS amount,
           CAST(CASE WHEN processed OR id IN (SELECT id FROM first) THEN 1 ELSE 0 END AS INTEGER)
               AS processed FROM transactions""", w=WAITING, first=CLAIM.format(source="w")))
def mark_processed(t: Tables):
    marked = claims.mark_processed(t.transactions(), claim_batch(t))
    return marked.withColumn("processed", F.col("processed").cast("int"))


@plan("double_processing_report", """
    SELECT l_orderkey AS id, COUNT(DISTINCT l_suppkey) AS runs, COUNT(*) AS entries
    FROM lineitem GROUP BY 1 HAVING COUNT(DISTINCT l_suppkey) > 1""")
def double_processing_report(t: Tables):
    ledger = t.raw("lineitem").select(F.col("l_orderkey").alias("id"),
                                      F.col("l_suppkey").alias("run"))
    return claims.double_processing(ledger)
