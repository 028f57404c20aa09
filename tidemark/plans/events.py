"""Queries over the event stream table: sensors, activity, sessions, sliding windows, parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import means
from ..operators import aggregates as agg
from ..operators import anomaly, clean, windows
from ..sources.tables import Tables
from .registry import plan
from .sqltext import avg4, big, dbl, with_views

SLIDE, PANES = "6 hours", 4
HIGH, MEDIUM, HIGH_VALUE = (5, 300, 3, 100), (2, 120), 100
GAP = 7200

HOPS = """SELECT *, unnest(generate_series(b - INTERVAL 18 HOUR, b, INTERVAL 6 HOUR)) AS window_start
    FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS b FROM ev)"""
ACTIVITY = f"""SELECT user_id, window_start, COUNT(*) AS order_count, SUM(value) AS s
    FROM hops GROUP BY 1, 2"""
SCORED = f"""SELECT user_id, window_start, COUNT(*) AS order_count, SUM(value) AS s,
    COUNT(DISTINCT event_type) AS unique_items, {avg4('value')} AS avg_order_value,
    COUNT(*) FILTER (WHERE value > {HIGH_VALUE}) AS high_value_orders,
    COUNT(DISTINCT date_trunc('hour', ts)) AS active_hours FROM hops GROUP BY 1, 2"""


@plan("user_activity_hop", with_views(
    "ev", f"SELECT user_id, window_start, order_count, {dbl('s')} AS total_spent FROM a",
    hops=HOPS, a=ACTIVITY))
def user_activity_hop(t: Tables):
    return windows.activity_hop(t.events(), SLIDE, PANES)


@plan("fraud_alerts", with_views("ev", f"""
    SELECT user_id, window_start, order_count, {dbl('s')} AS total_spent,
           CASE WHEN order_count > 7 THEN 'Suspicious: Too many orders'
                WHEN s > 400 THEN 'Suspicious: High spending' ELSE 'Normal' END AS risk_level
    FROM a WHERE order_count > 5""", hops=HOPS, a=ACTIVITY))
def fraud_alerts(t: Tables):
    return windows.fraud_alerts(t.events(), SLIDE, PANES, 5, 7, 400)


SCORE = f"""CAST(CASE WHEN order_count > {HIGH[0]} THEN 30 ELSE 0 END
    + CASE WHEN s > {HIGH[1]} THEN 40 ELSE 0 END + CASE WHEN unique_items > {HIGH[2]} THEN 20 ELSE 0 END
    + CASE WHEN avg_order_value > {HIGH[3]} THEN 10 ELSE 0 END AS INTEGER)"""
RISK_CLASS = f"""CASE WHEN order_count > {HIGH[0]} OR s > {HIGH[1]} OR unique_items > {HIGH[2]}
    THEN 'HIGH_RISK' WHEN order_count > {MEDIUM[0]} OR s > {MEDIUM[1]} THEN 'MEDIUM_RISK'
    ELSE 'LOW_RISK' END"""


@plan("fraud_score", with_views("ev", f"""
    SELECT user_id, window_start, order_count, {dbl('s')} AS total_spent, unique_items,
           avg_order_value, high_value_orders, active_hours, {SCORE} AS risk_score,
           {RISK_CLASS} AS risk_category FROM a""", hops=HOPS, a=SCORED))
def fraud_score(t: Tables):
    return windows.fraud_score(t.events(), SLIDE, PANES, "event_type", HIGH, MEDIUM, HIGH_VALUE)


@plan("conditional_fraud_aggs", with_views("ev", f"""
    SELECT user_id, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start,
           COUNT(DISTINCT event_type) AS unique_items,
           COUNT(DISTINCT date_trunc('hour', ts)) AS active_hours,
           COUNT(*) FILTER (WHERE value > {HIGH_VALUE}) AS high_value_orders
    FROM ev GROUP BY 1, 2"""))
def conditional_fraud_aggs(t: Tables):
    # one pane per window: a tumbling window of a day
    hourly = t.events().withColumn("_hour", agg.trunc("ts", "hour"))
    return windows.hop(
        hourly, ["user_id"], "1 day", 1, {"h": F.count_if(F.col("value") > HIGH_VALUE)},
        {"unique_items": F.count_distinct("event_type"), "active_hours": F.count_distinct("_hour"),
         "high_value_orders": F.sum("h")}, also=["event_type", "_hour"])


SESSION_ROWS = f"""SELECT *, SUM(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no
    FROM (SELECT *, CASE WHEN lag(ts) OVER w IS NULL
              OR ts - lag(ts) OVER w > INTERVAL {GAP} SECOND THEN 1 ELSE 0 END AS opens
          FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""
SESSIONS = f"""SELECT user_id, {big('session_no')} AS session_no, MIN(ts) AS session_start,
    MAX(ts) AS session_end, COUNT(*) AS events_in_session, {dbl('SUM(value)')} AS session_value
    FROM r GROUP BY 1, 2"""


@plan("user_sessions", with_views("ev", SESSIONS, r=SESSION_ROWS))
def user_sessions(t: Tables):
    return windows.user_sessions(t.events(), GAP)


@plan("long_sessions", with_views("ev", "SELECT * FROM s WHERE events_in_session > 3",
                                  r=SESSION_ROWS, s=SESSIONS))
def long_sessions(t: Tables):
    return user_sessions(t).filter(F.col("events_in_session") > 3)


@plan("distinct_sessions", with_views("ev", """
    SELECT DISTINCT user_id, session_start, session_end FROM s""", r=SESSION_ROWS, s=SESSIONS))
def distinct_sessions(t: Tables):
    return user_sessions(t).select("user_id", "session_start", "session_end").distinct()


SPENDING = f"""SELECT user_id, day, {dbl('s')} AS daily_spending,
    {avg4('s', over='w')} AS avg_7day_spending,
    {dbl('MAX(s) OVER w - MIN(s) OVER w')} AS spending_range_7day
    FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""
DAILY = "SELECT user_id, date_trunc('day', ts) AS day, SUM(value) AS s FROM ev GROUP BY 1, 2"


@plan("anomaly_user_spending", with_views("ev", SPENDING, d=DAILY))
def anomaly_user_spending(t: Tables):
    return anomaly.daily_spending(t.events(), "value")


@plan("anomaly_flags", with_views("ev", """
    SELECT user_id, day, daily_spending, avg_7day_spending,
           CASE WHEN daily_spending > avg_7day_spending + spending_range_7day * 0.5
                THEN 'HIGH_ANOMALY'
                WHEN daily_spending < GREATEST(0, avg_7day_spending - spending_range_7day * 0.5)
                THEN 'LOW_ANOMALY' ELSE 'NORMAL' END AS anomaly_type FROM p""",
    d=DAILY, p=SPENDING))
def anomaly_flags(t: Tables):
    return anomaly.flag_spending(anomaly.daily_spending(t.events(), "value"))


@plan("sensor_stats", with_views("ev", f"""
    SELECT user_id AS sensor_id, COUNT(*) AS readings, {avg4('value')} AS avg_value,
           {dbl('MAX(value)')} AS max_value,
           ROUND(stddev_samp(CAST(value AS DOUBLE)) FILTER (WHERE value > 50), 4) AS stddev_high
    FROM ev GROUP BY 1"""))
def sensor_stats(t: Tables):
    return agg.sensor_stats(t.events(), {"sensor_id": F.col("user_id")}, 50)


@plan("sensor_stats_daily", with_views("ev", f"""
    SELECT date_trunc('day', ts) AS day, COUNT(*) AS readings, {avg4('value')} AS avg_value,
           {dbl('MAX(value)')} AS max_value,
           ROUND(stddev_samp(CAST(value AS DOUBLE)) FILTER (WHERE value > 50), 4) AS stddev_high
    FROM ev GROUP BY 1"""))
def sensor_stats_daily(t: Tables):
    return agg.sensor_stats(t.events(), {"day": agg.trunc("ts", "day")}, 50)


@plan("sensor_top", with_views("ev", f"""
    SELECT user_id AS sensor_id, COUNT(*) AS readings, {avg4('value')} AS avg_value,
           {dbl('MAX(value)')} AS max_value FROM ev GROUP BY 1
    ORDER BY readings DESC, sensor_id LIMIT 20"""))
def sensor_top(t: Tables):
    return agg.top(sensor_stats(t).drop("stddev_high"), 20, F.desc("readings"), "sensor_id")


@plan("sensor_alerts", with_views("ev", f"""
    SELECT user_id AS sensor_id, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01')
           AS window_start, COUNT(*) AS alerts, {dbl('MAX(value)')} AS max_value
    FROM ev WHERE event_type = 'error' GROUP BY 1, 2"""))
def sensor_alerts(t: Tables):
    alerts = t.events().filter(F.col("event_type") == "error").withColumnRenamed(
        "user_id", "sensor_id")
    return windows.tumble(alerts, "1 day", ["sensor_id"], {
        "alerts": F.count("*"), "max_value": F.max("value")}).drop("window_end")


@plan("range_scan", with_views("ev", f"""
    SELECT 'id_range' AS scan, event_id, user_id, {dbl('value')} AS value FROM ev
    WHERE event_id BETWEEN 500 AND 1500
    UNION ALL SELECT 'sensor_range', event_id, user_id, {dbl('value')} FROM ev WHERE user_id <= 10"""))
def range_scan(t: Tables):
    return clean.match_predicates(t.events().select("event_id", "user_id", "value"), {
        "id_range": F.col("event_id").between(500, 1500), "sensor_range": F.col("user_id") <= 10,
    }).withColumnRenamed("predicate", "scan")


@plan("sensor_range_top", with_views("ev", f"""
    SELECT user_id AS sensor_id, event_id, {dbl('value')} AS value FROM ev WHERE user_id <= 10
    ORDER BY ev.value DESC, event_id LIMIT 50"""))
def sensor_range_top(t: Tables):
    rows = t.events().filter(F.col("user_id") <= 10)
    return agg.top(rows, 50, F.desc("value"), "event_id").select(
        F.col("user_id").alias("sensor_id"), "event_id", "value")


@plan("lake_readback", with_views("ev", f"""
    SELECT event_id, ts, user_id, event_type, {dbl('value')} AS value FROM ev
    WHERE event_type = 'purchase' ORDER BY ts DESC, event_id DESC LIMIT 100"""))
def lake_readback(t: Tables):
    rows = t.events().filter(F.col("event_type") == "purchase")
    return agg.top(rows, 100, F.desc("ts"), F.desc("event_id")).drop("props")


# Event times written in the spellings a producer may use, by remainder of the id.
@plan("parse_event_time", """
    SELECT event_id, CASE event_id % 6 WHEN 0 THEN ts WHEN 1 THEN ts
        WHEN 2 THEN date_trunc('second', ts) WHEN 3 THEN date_trunc('day', ts)
        WHEN 4 THEN ts - INTERVAL '3 hours 30 minutes' END AS parsed,
        CAST(CASE WHEN event_id % 6 = 5 THEN 1 ELSE 0 END AS INTEGER) AS rejected
    FROM events""")
def parse_event_time(t: Tables):
    kind, ts = F.col("event_id") % 6, F.col("ts")
    micros = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (F.when(kind == 0, micros).when(kind == 1, F.concat(micros, F.lit("+00:00")))
            .when(kind == 2, F.date_format(ts, "yyyy/MM/dd HH:mm:ss"))
            .when(kind == 3, F.date_format(ts, "yyyy-MM-dd"))
            .when(kind == 4, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                                      F.lit("+03:30")))
            .otherwise(F.concat(F.lit("half past "), F.date_format(ts, "HH"))))
    texts = t.raw("events").select("event_id", text.alias("text"))
    return clean.parse_times(texts, "text", "parsed").drop("text")


@plan("flatten_event", """
    SELECT event_id, user_id, event_type, value AS location_lat,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS location_k,
           CASE WHEN event_type = 'purchase' THEN CAST(json_extract_string(props, '$.k') AS INTEGER)
           END AS product_id, CAST(NULL AS VARCHAR) AS search_query
    FROM events""")
def flatten_event(t: Tables):
    k = F.from_json("props", "k int").k
    nested = t.raw("events").select("event_id", F.to_json(F.struct(
        "user_id", "event_type", F.struct(F.col("value").alias("lat"), k.alias("k")).alias("location"),
        F.when(F.col("event_type") == "purchase", k).alias("product_id"))).alias("body"))
    return clean.flatten_event(
        nested, "body", "user_id bigint, event_type string, location struct<lat: double, k: int>, "
        "product_id int, search_query string")


def event_windows(size: str, unit: str):
    """Events per type in windows of one size: count, sum, mean and extremes."""
    sql = with_views("ev", f"""
        SELECT event_type, time_bucket(INTERVAL {size}, ts, TIMESTAMP '1970-01-01') AS window_start,
               time_bucket(INTERVAL {size}, ts, TIMESTAMP '1970-01-01') + INTERVAL {size} AS window_end,
               COUNT(*) AS event_count, {dbl('SUM(value)')} AS total_value,
               {avg4('value')} AS avg_value, {dbl('MIN(value)')} AS min_value,
               {dbl('MAX(value)')} AS max_value FROM ev GROUP BY 1, 2, 3""")

    @plan(f"event_windows_{unit}", sql)
    def query(t: Tables):
        return windows.tumble(t.events(), size, ["event_type"], {
            "event_count": F.count("*"), "total_value": F.sum("value"),
            "avg_value": means.mean("value"), "min_value": F.min("value"),
            "max_value": F.max("value")})


for _size, _unit in (("1 minute", "1m"), ("5 minutes", "5m"), ("1 hour", "1h")):
    event_windows(_size, _unit)
