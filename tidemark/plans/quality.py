"""Quality, reconciliation and market-calendar queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendars import day_of_week, jalali_parts, jalali_date
from ..functions.text import ARABIC_DIGITS, ASCII_DIGITS, PERSIAN_DIGITS, is_symbol
from ..operators import aggregates as agg
from ..operators import enrich, market, quality, windows
from ..sources.tables import Tables
from .registry import plan
from .sqltext import big, dbl, with_views

FINAL_STATUSES = ("F", "O", "P")


@plan("duplicate_report", """
    SELECT CAST(SUM(n) AS BIGINT) AS raw_count, COUNT(*) AS unique_count,
           COUNT(*) FILTER (WHERE n > 1) AS repeated_keys,
           CAST(SUM(n) - COUNT(*) AS BIGINT) AS surplus_count,
           ROUND(CAST(SUM(n) AS DOUBLE) / COUNT(*), 4) AS inflation
    FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def duplicate_report(t: Tables):
    return quality.duplicate_report(t.line_items(), ["order_id", "line"])


def summary(df):
    by_category = df.select((F.col("item_id") % 7).alias("category"), "amount", "ts")
    return agg.partial_sums(by_category, ["category"], "amount", "ts")


SUMMARY = """SELECT item_id % 7 AS category, COUNT(*) AS event_count, SUM(amount) AS total_value
    FROM {v} GROUP BY 1"""


@plan("mv_inflation", with_views("line_clean", f"""
    SELECT category, r.event_count AS left_event_count, {dbl('r.total_value')} AS left_total_value,
           f.event_count AS right_event_count, {dbl('f.total_value')} AS right_total_value,
           r.event_count - f.event_count AS diff_event_count,
           {dbl('r.total_value - f.total_value')} AS diff_total_value
    FROM r JOIN f USING (category)""",
    r=SUMMARY.format(v="line_items"), f=SUMMARY.format(v="line_clean")))
def mv_inflation(t: Tables):
    final = t.orders_clean(user=False, price=False)
    return quality.summary_inflation(summary(t.line_items()), summary(final), "category")


@plan("gap_report", with_views("ev", """
    SELECT user_id, CAST(day AS VARCHAR) AS day FROM (
        SELECT user_id, CAST(unnest(generate_series((SELECT CAST(MIN(ts) AS DATE) FROM ev),
               (SELECT CAST(MAX(ts) AS DATE) FROM ev), INTERVAL 1 DAY)) AS DATE) AS day
        FROM (SELECT DISTINCT user_id FROM ev))
    WHERE (user_id, day) NOT IN (SELECT (user_id, CAST(ts AS DATE)) FROM ev)"""))
def gap_report(t: Tables):
    return quality.daily_gaps(t.events(), "user_id")


@plan("hourly_counts", "SELECT date_trunc('hour', ts) AS hour, COUNT(*) AS row_count FROM events GROUP BY 1")
def hourly_counts(t: Tables):
    return quality.bucket_counts(t.events(), "hour")


@plan("enrichment_coverage", with_views("line_items items", """
    SELECT COUNT(*) AS total_orders, COUNT(item_name) AS enriched_orders,
           COUNT(*) - COUNT(item_name) AS missing_enrichment
    FROM line_items LEFT JOIN (SELECT * FROM items WHERE category <> 'PROMO') USING (item_id)"""))
def enrichment_coverage(t: Tables):
    known = t.items().filter(F.col("category") != "PROMO")
    return quality.enrichment_coverage(enrich.enrich_items(t.line_items(), known), "item_name")


RULES = {
    "id_not_null": ("o_orderkey IS NOT NULL", lambda: F.col("o_orderkey").isNotNull()),
    "status_in_list": ("o_orderstatus IN ('F', 'O')", lambda: F.col("o_orderstatus").isin("F", "O")),
    "price_in_range": ("o_totalprice BETWEEN 1000 AND 400000",
                       lambda: F.col("o_totalprice").between(1000, 400000)),
    "date_in_bounds": ("o_orderdate >= TIMESTAMP '1996-01-01'",
                       lambda: F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")),
}


@plan("constraint_report", " UNION ALL ".join(
    [f"SELECT '{n}' AS rule, COUNT(*) FILTER (WHERE NOT coalesce({s}, false)) AS violations, "
     "COUNT(*) AS checked FROM orders" for n, (s, _) in RULES.items()]
    + ["SELECT 'line_unique', CAST(SUM(n - 1) AS BIGINT), CAST(SUM(n) AS BIGINT) FROM ("
       "SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"]))
def constraint_report(t: Tables):
    rules = {n: rule() for n, (_, rule) in RULES.items()}
    unique = quality.unique_violations(t.line_items(), ["order_id", "line"], "line_unique")
    return quality.rule_report(t.raw("orders"), rules).unionByName(unique)


@plan("null_category_check", with_views("line_items", """
    SELECT CASE WHEN category IS NULL THEN '<null>' WHEN category = '' THEN '<empty>'
           ELSE category END AS category, COUNT(*) AS record_count
    FROM line_items LEFT JOIN (SELECT p_partkey AS item_id, CASE WHEN p_size < 10 THEN ''
        WHEN p_size < 40 THEN p_type END AS category FROM part) USING (item_id) GROUP BY 1"""))
def null_category_check(t: Tables):
    size = F.col("p_size")
    patchy = t.raw("part").select(
        F.col("p_partkey").alias("item_id"),
        F.when(size < 10, "").when(size < 40, F.col("p_type")).alias("category"))
    return quality.category_check(t.line_items().join(patchy, "item_id", "left"), "category")


@plan("window_multiplicity", with_views("line_items items", """
    SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, COUNT(*) AS records,
           COUNT(DISTINCT category) AS unique_categories
    FROM (SELECT DISTINCT time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS window_start,
          category FROM line_items LEFT JOIN items USING (item_id))
    GROUP BY 1 HAVING COUNT(*) > 1"""))
def window_multiplicity(t: Tables):
    return quality.window_multiplicity(
        windows.revenue_tumble(t.line_items(), t.items(), "7 days"))


@plan("component_counts", with_views("line_clean", """
    SELECT 'raw' AS component, COUNT(*) AS row_count FROM line_items
    UNION ALL SELECT 'final', COUNT(*) FROM line_clean
    UNION ALL SELECT 'summary', COUNT(DISTINCT item_id % 7) FROM line_items
    UNION ALL SELECT 'events', COUNT(*) FROM events"""))
def component_counts(t: Tables):
    return agg.labelled_counts({
        "raw": t.line_items(), "final": t.orders_clean(user=False, price=False),
        "summary": summary(t.line_items()), "events": t.raw("events")})


LOG = """SELECT category, date_trunc('month', ts) AS window_start, CAST(n AS BIGINT) AS batch_id,
    {revenue} AS revenue FROM line_items JOIN items USING (item_id)
    JOIN (SELECT unnest(range(1, 4)) AS n) b ON day(ts) <= n * 10 + CASE WHEN n = 3 THEN 1 ELSE 0 END
    GROUP BY 1, 2, 3"""


@plan("collapse_append_only", with_views("line_items items", f"""
    SELECT category, window_start, batch_id, {dbl('revenue')} AS revenue, {dbl('top')} AS max_revenue
    FROM (SELECT *, row_number() OVER (PARTITION BY category, window_start ORDER BY batch_id DESC)
          AS rn, MAX(revenue) OVER (PARTITION BY category, window_start) AS top FROM log)
    WHERE rn = 1""", log=LOG.format(revenue="SUM(amount)")))
def collapse_append_only(t: Tables):
    """Final value of every window from a log that holds each of its growing intermediate values."""
    lines = (t.line_items().join(t.items(), "item_id")
             .withColumn("window_start", agg.trunc("ts", "month"))
             .withColumn("step", F.least(F.ceil(F.dayofmonth("ts") / 10), F.lit(3))))
    steps = lines.groupBy("category", "window_start", "step").agg(F.sum("amount").alias("amount"))
    log = (steps.withColumn("batch_id", F.explode(F.sequence(F.col("step"), F.lit(3).cast("long"))))
           .groupBy("category", "window_start", "batch_id").agg(F.sum("amount").alias("revenue")))
    return (log.groupBy("category", "window_start")
            .agg(F.max(F.struct("batch_id", "revenue")).alias("last"),
                 F.max("revenue").alias("max_revenue"))
            .select("category", "window_start", "last.*", "max_revenue"))


# ---- calendar and market -------------------------------------------------------------------------

JALALI = """SELECT *, CAST(date_diff('day', DATE '1970-01-01', CAST({d} AS DATE)) AS INTEGER) + 1075195
    AS n FROM {t}"""
JALALI_R = "SELECT *, n % 12053 AS c, (n % 12053) % 1461 AS r FROM n0"
JALALI_Y = """SELECT *, -1595 + 33 * (n // 12053) + 4 * (c // 1461)
    + CASE WHEN r > 365 THEN (r - 1) // 365 ELSE 0 END AS jy,
    CASE WHEN r > 365 THEN (r - 1) % 365 ELSE r END AS x FROM n1"""
JALALI_D = """SELECT *, CASE WHEN x < 186 THEN 1 + x // 31 ELSE 7 + (x - 186) // 30 END AS jm,
    CASE WHEN x < 186 THEN 1 + x % 31 ELSE 1 + (x - 186) % 30 END AS jd FROM n2"""


def jalali_ctes(table: str, date: str) -> dict[str, str]:
    return {"n0": JALALI.format(t=table, d=date), "n1": JALALI_R, "n2": JALALI_Y, "n3": JALALI_D}


FA_DATE = "printf('%04d-%02d-%02d', jy, jm, jd)"


@plan("jalali_date", with_views("", f"""
    SELECT o_orderkey AS order_id, {FA_DATE} AS fa_date, CAST(jy AS INTEGER) AS fa_year,
           CAST(jm AS INTEGER) AS fa_month, CAST(jd AS INTEGER) AS fa_day,
           CAST(dayofweek(o_orderdate) AS INTEGER) AS weekday FROM n3""",
    **jalali_ctes("orders", "o_orderdate")))
def jalali_dates(t: Tables):
    day = F.col("o_orderdate").cast("date")
    y, m, d = jalali_parts(day)
    return t.raw("orders").select(
        F.col("o_orderkey").alias("order_id"), jalali_date(day).alias("fa_date"),
        y.alias("fa_year"), m.alias("fa_month"), d.alias("fa_day"),
        day_of_week("o_orderdate").alias("weekday"))


def listed(t: Tables):
    """Parts as market listings: a name with a number in ASCII, Persian or Arabic digits."""
    size = F.col("p_size").cast("string")
    written = (F.when(F.col("p_partkey") % 3 == 1, F.translate(size, ASCII_DIGITS, PERSIAN_DIGITS))
               .when(F.col("p_partkey") % 3 == 2, F.translate(size, ASCII_DIGITS, ARABIC_DIGITS))
               .otherwise(size))
    name = F.when(F.col("p_type") == "PROMO", F.col("p_name")).otherwise(
        F.concat("p_name", F.lit(" "), written))
    return t.raw("part").select(F.col("p_partkey").alias("item_id"), name.alias("listing"))


@plan("is_symbol", """
    SELECT p_partkey AS item_id, CAST(CASE WHEN p_type = 'PROMO' OR p_size < 20 THEN 1 ELSE 0 END
           AS INTEGER) AS keep FROM part""")
def symbols(t: Tables):
    return listed(t).select("item_id", is_symbol("listing").cast("int").alias("keep"))


def days(t: Tables):
    sheets = t.line_items().join(listed(t), "item_id").withColumn("en_date", F.to_date("ts"))
    return market.market_days(sheets, "listing")


KEPT = """SELECT * FROM line_items JOIN part ON p_partkey = item_id
    WHERE p_type = 'PROMO' OR p_size < 20"""


@plan("market_days", with_views("line_items", f"""
    SELECT order_id, line, item_id, {dbl('amount')} AS amount, {FA_DATE} AS fa_date,
           strftime(ts, '%Y-%m-%d') AS en_date, CAST(jy AS INTEGER) AS fa_year FROM n3""",
    kept=KEPT, **jalali_ctes("kept", "ts")))
def market_days(t: Tables):
    return days(t).select("order_id", "line", "item_id", "amount", "fa_date", "en_date", "fa_year")


@plan("day_row_counts", with_views("line_items", """
    SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS row_count FROM kept GROUP BY 1""",
                                   kept=KEPT))
def day_row_counts(t: Tables):
    return market.day_counts(days(t))


SPINE = """SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE),
    INTERVAL 1 DAY)) AS DATE) AS day FROM line_items"""


@plan("backfill_range", with_views(
    "line_items", "SELECT CAST(day AS VARCHAR) AS day FROM spine", spine=SPINE))
def backfill_range(t: Tables):
    return market.covered_days(t.line_items())


@plan("backfill_summary", with_views("line_items", f"""
    SELECT COUNT(*) AS dates_processed, COUNT(c.day) AS trading_days,
           COUNT(*) - COUNT(c.day) AS empty_days, CAST(MIN(s.day) AS VARCHAR) AS start_date,
           CAST(MAX(s.day) AS VARCHAR) AS end_date, {big('0')} AS failures, 'completed' AS status
    FROM spine s LEFT JOIN (SELECT DISTINCT CAST(ts AS DATE) AS day FROM kept) c USING (day)""",
    kept=KEPT, spine=SPINE))
def backfill_summary(t: Tables):
    counted = market.backfill_days(market.covered_days(t.line_items()), market.day_counts(days(t)))
    return market.backfill_summary(counted)
