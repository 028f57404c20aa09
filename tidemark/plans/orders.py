"""Queries over order lines, trades and products."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import means
from ..operators import aggregates as agg
from ..operators import anomaly, clean, enrich, ranking, windows
from ..sources import files
from ..sources.tables import LINE_VERSION, MONEY, Tables
from .registry import plan
from .sqltext import avg4, big, dbl, with_views

AS_OF = "2001-11-01 00:00:00"
MONTH = "30 days"
DAY = "1 day"
RECENT = f"ts >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AND ts <= TIMESTAMP '{AS_OF}'"
SMALL, MEDIUM = 16000, 32000
LOW, MID = 35000, 70000
TOTAL = "CAST(qty * price AS DECIMAL(18,2))"
BAND = f"CASE WHEN trade_value <= {LOW} THEN 'Low' WHEN trade_value <= {MID} THEN 'Medium' ELSE 'High' END"


# ---- newest version, validation, projections -----------------------------------------------------

@plan("latest_by_key", with_views("line_clean", f"""
    SELECT order_id, line, ts, item_id, qty, {dbl('amount')} AS amount,
           {dbl('discount_pct')} AS discount_pct FROM line_clean"""))
def latest_by_key(t: Tables):
    return clean.latest_by_key(t.line_items(), ["order_id", "line"], LINE_VERSION)


@plan("orders_transformed", with_views("orders_clean", f"""
    SELECT order_id, user_id, qty, {dbl('price')} AS price, {dbl(TOTAL)} AS total_amount,
           date_trunc('day', ts) AS order_date, CAST(dayofweek(ts) AS INTEGER) AS day_of_week,
           CASE WHEN {TOTAL} < {SMALL} THEN 'Small' WHEN {TOTAL} < {MEDIUM} THEN 'Medium'
                ELSE 'Large' END AS order_size, ts
    FROM orders_clean"""))
def orders_transformed(t: Tables):
    return clean.transform_orders(t.orders_clean(), SMALL, MEDIUM)


@plan("orders_validated", with_views("orders_clean", f"""
    SELECT order_id, line, user_id, item_id, qty, {dbl('price')} AS price, ts FROM orders_clean
    WHERE qty > 0 AND price > 0 AND ts <= TIMESTAMP '{AS_OF}' AND user_id IS NOT NULL"""))
def orders_validated(t: Tables):
    valid = clean.validate(t.orders_clean(), clean.order_rules(AS_OF))
    return valid.select("order_id", "line", "user_id", "item_id", "qty", "price", "ts")


@plan("orders_rejected", with_views("orders_clean", f"""
    SELECT CASE WHEN NOT coalesce(qty > 0, false) THEN 'qty_positive'
                WHEN NOT coalesce(price > 0, false) THEN 'price_positive'
                WHEN NOT coalesce(ts <= TIMESTAMP '{AS_OF}', false) THEN 'not_in_future'
                WHEN user_id IS NULL THEN 'user_present' ELSE 'accepted' END AS reject_reason,
           COUNT(*) AS row_count FROM orders_clean GROUP BY 1"""))
def orders_rejected(t: Tables):
    marked = clean.with_reject_reason(t.orders_clean(), clean.order_rules(AS_OF))
    return marked.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("reject_reason")).agg(
        F.count("*").alias("row_count"))


@plan("risk_banded_trades", with_views("trades", f"""
    SELECT trade_id, line, symbol, volume, {dbl('trade_value')} AS trade_value, side, exchange,
           trader_id, ts, {BAND} AS risk_level FROM trades"""))
def risk_banded_trades(t: Tables):
    return clean.risk_banded(t.trades(), LOW, MID)


@plan("status_assigned", """
    SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS ts,
           CASE o_orderkey % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'processing' WHEN 2 THEN 'shipped'
                WHEN 3 THEN 'delivered' ELSE 'cancelled' END AS status
    FROM orders""")
def status_assigned(t: Tables):
    orders = t.raw("orders").select(F.col("o_orderkey").alias("order_id"),
                                    F.col("o_custkey").alias("user_id"),
                                    F.col("o_orderdate").alias("ts"))
    return clean.assign_status(orders)


@plan("filter_scans", with_views("products", " UNION ALL ".join(
    f"SELECT '{n}' AS predicate, id, name, category, {dbl('price')} AS price, stock_quantity "
    f"FROM products WHERE {w}" for n, w in {
        "price_above_low": "price > 950", "price_above_high": "price > 990",
        "price_between": "price BETWEEN 920 AND 960", "category_is": "category = 'ECONOMY'",
        "category_in": "category IN ('ECONOMY', 'STANDARD', 'PROMO')"}.items())))
def filter_scans(t: Tables):
    price, category = F.col("price"), F.col("category")
    return clean.match_predicates(t.products(), {
        "price_above_low": price > 950, "price_above_high": price > 990,
        "price_between": price.between(920, 960), "category_is": category == "ECONOMY",
        "category_in": category.isin("ECONOMY", "STANDARD", "PROMO")})


@plan("recent_view", with_views("trades", f"""
    SELECT trade_id, line, symbol, {dbl('trade_value')} AS trade_value, ts FROM trades
    WHERE {RECENT}"""))
def recent_view(t: Tables):
    return clean.recent_view(t.trades(), "recent_trades", AS_OF, MONTH).select(
        "trade_id", "line", "symbol", "trade_value", "ts")


@plan("alert_filter", with_views("orders_raw", f"""
    SELECT order_id, line, user_id, {dbl(TOTAL)} AS total_amount,
           CASE WHEN {TOTAL} > 45000 THEN 'Suspicious: very high value'
                ELSE 'Suspicious: high value' END AS alert
    FROM orders_raw WHERE {TOTAL} > 40000"""))
def alert_filter(t: Tables):
    total = F.col("total_amount")
    labelled = clean.with_total(t.orders_raw()).withColumn(
        "alert", F.when(total > 45000, "Suspicious: very high value")
        .when(total > 40000, "Suspicious: high value").otherwise("Normal"))
    return labelled.filter(F.col("alert").startswith("Suspicious")).select(
        "order_id", "line", "user_id", "total_amount", "alert")


@plan("null_safe", """
    SELECT o_orderkey AS order_id, coalesce(c_name, '') AS user_name,
           coalesce(CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END, 'unknown')
               AS user_tier,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def null_safe(t: Tables):
    users = t.users().withColumn("user_tier",
                                 F.when(F.col("user_tier") != "MACHINERY", F.col("user_tier")))
    orders = t.raw("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("amount"))
    joined = orders.join(users, "user_id", "left").drop("user_id")
    return clean.null_safe(joined, {"user_name": "", "user_tier": "unknown"}, {"amount": MONEY})


@plan("decode_kind", """
    SELECT o_orderkey AS order_id, CASE o_orderstatus WHEN 'F' THEN 'finished'
           WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' ELSE 'other' END AS kind FROM orders""")
def decode_kind(t: Tables):
    labels = {"F": "finished", "O": "open", "P": "partial"}
    return t.raw("orders").select(F.col("o_orderkey").alias("order_id"),
                                  clean.decode("o_orderstatus", labels, "other").alias("kind"))


# ---- joins ---------------------------------------------------------------------------------------

@plan("orders_enriched", with_views("orders_raw items", f"""
    SELECT o.order_id, o.line, o.user_id, o.item_id, i.item_name, i.category, o.qty,
           {dbl('o.price')} AS price, {dbl('o.amount')} AS amount, o.ts
    FROM orders_raw o LEFT JOIN items i USING (item_id)"""))
def orders_enriched(t: Tables):
    return enrich.enrich_items(t.orders_raw(price=False), t.priced_items()).select(
        "order_id", "line", "user_id", "item_id", "item_name", "category", "qty", "price",
        "amount", "ts")


@plan("orders_fully_enriched", with_views("orders_clean items users", f"""
    SELECT o.order_id, u.user_name, u.user_tier, i.item_name, i.category, o.qty,
           {dbl('o.price')} AS price, {dbl(TOTAL)} AS total_amount
    FROM orders_clean o LEFT JOIN items i USING (item_id) LEFT JOIN users u USING (user_id)"""))
def orders_fully_enriched(t: Tables):
    return enrich.enrich_fully(t.orders_clean(price=False), t.priced_items(), t.users()).select(
        "order_id", "user_name", "user_tier", "item_name", "category", "qty", "price",
        "total_amount")


@plan("enriched_trades", with_views("trades instruments", f"""
    SELECT trade_id, line, symbol, instrument_name, instrument_category, volume,
           {dbl('trade_value')} AS trade_value, {dbl('list_price')} AS list_price, trader_id, ts
    FROM trades LEFT JOIN instruments USING (symbol)"""))
def enriched_trades(t: Tables):
    return enrich.enrich_trades(t.trades(), t.instruments()).select(
        "trade_id", "line", "symbol", "instrument_name", "instrument_category", "volume",
        "trade_value", "list_price", "trader_id", "ts")


VOLUME_COLUMNS = f"""instrument_category, total_trades, total_returns,
    total_trades - total_returns AS net_trades, {dbl('gross')} AS gross_volume,
    {dbl('refund')} AS refund_volume, {dbl('gross - refund')} AS net_volume"""
AS_WRITTEN = """
    SELECT instrument_category, COUNT(*) AS total_trades,
           COUNT(r.order_id) AS total_returns, SUM(t.trade_value) AS gross,
           COALESCE(SUM(r.refund_amount), 0) AS refund
    FROM trades t LEFT JOIN instruments USING (symbol) LEFT JOIN returns r ON t.trade_id = r.order_id
    GROUP BY 1"""


@plan("net_trading_volume", with_views(
    "trades instruments returns", f"SELECT {VOLUME_COLUMNS} FROM s", s=AS_WRITTEN))
def net_trading_volume(t: Tables):
    return enrich.net_trading_volume(t.trades(), t.returns(), t.instruments())


@plan("net_trading_volume_exact", with_views(
    "trades instruments returns", f"SELECT {VOLUME_COLUMNS} FROM s",
    first="""SELECT trade_id, symbol FROM (SELECT *, row_number() OVER (
        PARTITION BY trade_id ORDER BY ts, line, symbol) AS rn FROM trades) WHERE rn = 1""",
    g="""SELECT instrument_category, COUNT(*) AS total_trades, SUM(trade_value) AS gross
        FROM trades LEFT JOIN instruments USING (symbol) GROUP BY 1""",
    f="""SELECT instrument_category, COUNT(*) AS total_returns, SUM(refund_amount) AS refund
        FROM returns r JOIN first ON r.order_id = first.trade_id
        LEFT JOIN instruments USING (symbol) GROUP BY 1""",
    s="""SELECT instrument_category, total_trades, COALESCE(total_returns, 0) AS total_returns,
        gross, COALESCE(refund, 0) AS refund FROM g LEFT JOIN f USING (instrument_category)"""))
def net_trading_volume_exact(t: Tables):
    return enrich.net_trading_volume_exact(t.trades(), t.returns(), t.instruments())


@plan("return_rate", with_views("trades instruments returns", f"""
    SELECT instrument_category, total_trades - total_returns AS net_trades,
           {dbl('gross')} AS gross_volume, {dbl('refund')} AS refund_volume,
           {dbl('gross - refund')} AS net_volume,
           ROUND(CAST(refund AS DOUBLE) * 100.0 / NULLIF(CAST(gross AS DOUBLE), 0), 2)
               AS return_rate_percent FROM s""", s=AS_WRITTEN))
def return_rate(t: Tables):
    return enrich.return_rate(net_trading_volume(t))


@plan("self_join_windows", with_views("orders_raw items", f"""
    SELECT COALESCE(category, '') AS category, window_start, window_start + INTERVAL 7 DAY
           AS window_end, {dbl('SUM(revenue)')} AS revenue, {big('SUM(order_count)')} AS order_count
    FROM w LEFT JOIN items USING (item_id) GROUP BY 1, 2""",
    w="""SELECT item_id, time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS window_start,
         SUM(qty * price) AS revenue, COUNT(*) AS order_count FROM orders_raw
         GROUP BY item_id, window_start, ts"""))
def self_join_windows(t: Tables):
    totals = windows.priced_totals(t.line_items(), t.priced_items(), "7 days")
    return totals.groupBy(F.coalesce("category", F.lit("")).alias("category"), "window_start",
                          "window_end").agg(F.sum("revenue").alias("revenue"),
                                            F.sum("order_count").alias("order_count"))


@plan("risk_category_join", with_views("trades", f"""
    SELECT trade_id, line, {dbl('trade_value')} AS trade_value, b.risk_level
    FROM trades LEFT JOIN (VALUES ('Low', 0.00, 10000.00), ('Medium', 10000.01, 50000.00),
        ('High', 50000.01, 999999.99)) AS b(risk_level, lo, hi)
    ON trade_value BETWEEN lo AND hi"""))
def risk_category_join(t: Tables):
    bands = files.risk_bands(t.spark)
    return enrich.join_bands(t.trades().select("trade_id", "line", "trade_value"),
                             "trade_value", bands)


@plan("orphan_rows", """
    SELECT 'orders without lines' AS relation, o_orderkey AS id FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'lines without order', l_orderkey FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'orders without customer', o_orderkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def orphan_rows(t: Tables):
    lines, orders = t.raw("lineitem"), t.raw("orders")
    found = {
        "orders without lines": enrich.orphans(orders, lines, "o_orderkey", "l_orderkey"),
        "lines without order": enrich.orphans(lines, orders, "l_orderkey", "o_orderkey"),
        "orders without customer": enrich.orphans(orders, t.raw("customer"), "o_custkey",
                                                  "c_custkey"),
    }
    out = None
    for name, df in found.items():
        key = "l_orderkey" if name.startswith("lines") else "o_orderkey"
        rows = df.select(F.lit(name).alias("relation"), F.col(key).alias("id"))
        out = rows if out is None else out.unionByName(rows)
    return out


@plan("semi_by_ids", with_views("transactions", f"""
    SELECT id, user_id, ts, {dbl('amount')} AS amount FROM transactions
    WHERE id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"""))
def semi_by_ids(t: Tables):
    ledger = t.returns().select(F.col("order_id").alias("id"))
    return enrich.semi_by_ids(t.transactions(), ledger, "id").drop("processed")


@plan("catalog_join", """
    SELECT n_nationkey, n_name, r_name AS namespace,
           CASE WHEN n_nationkey % 2 = 0 THEN 'table' ELSE 'index' END AS kind
    FROM nation JOIN region ON n_regionkey = r_regionkey""")
def catalog_join(t: Tables):
    joined = enrich.catalog_join(t.raw("nation"), t.raw("region"), "n_regionkey", "r_regionkey")
    kind = clean.decode("code", {"0": "table"}, "index")
    return joined.withColumn("code", (F.col("n_nationkey") % 2).cast("string")).select(
        "n_nationkey", "n_name", F.col("r_name").alias("namespace"), kind.alias("kind"))


@plan("reconcile_sources", with_views("orders_raw line_clean items", f"""
    SELECT category, a.c AS left_order_count, {dbl('a.r')} AS left_revenue,
           b.c AS right_order_count, {dbl('b.r')} AS right_revenue,
           coalesce(a.c, 0) - coalesce(b.c, 0) AS diff_order_count,
           {dbl('coalesce(a.r, 0) - coalesce(b.r, 0)')} AS diff_revenue
    FROM a FULL JOIN b USING (category)""",
    a="SELECT category, COUNT(*) AS c, SUM(amount) AS r FROM orders_raw JOIN items USING (item_id) GROUP BY 1",
    b="SELECT category, COUNT(*) AS c, SUM(amount) AS r FROM line_clean JOIN items USING (item_id) GROUP BY 1"))
def reconcile_sources(t: Tables):
    items = t.items()
    left = agg.revenue_by_category(t.line_items(), items)
    right = agg.revenue_by_category(t.orders_clean(user=False, price=False), items)
    return enrich.reconcile(left, right, ["category"], ["order_count", "revenue"])


# ---- aggregates ----------------------------------------------------------------------------------

@plan("daily_revenue", with_views("line_items", f"""
    SELECT date_trunc('day', ts) AS day, {dbl('SUM(amount)')} AS revenue, COUNT(*) AS order_count
    FROM line_items GROUP BY 1"""))
def daily_revenue(t: Tables):
    return agg.revenue_by_time(t.line_items(), "day")


@plan("category_revenue", with_views("line_items items", f"""
    SELECT category, {dbl('SUM(amount)')} AS revenue, COUNT(*) AS order_count
    FROM line_items LEFT JOIN items USING (item_id) GROUP BY 1"""))
def category_revenue(t: Tables):
    return agg.revenue_by_category(t.line_items(), t.items())


TRADING = f"""SELECT instrument_category, COUNT(*) AS trade_count,
    {dbl('SUM(trade_value)')} AS total_value, {avg4('trade_value')} AS avg_trade_value,
    {dbl('MIN(trade_value)')} AS min_trade_value, {dbl('MAX(trade_value)')} AS max_trade_value
    FROM trades LEFT JOIN instruments USING (symbol)"""


@plan("trading_by_category", with_views("trades instruments",
                                        f"{TRADING} WHERE {RECENT} GROUP BY 1"))
def trading_by_category(t: Tables):
    return agg.trading_by_category(clean.recent(t.trades(), AS_OF, MONTH), t.instruments())


@plan("top_traders", with_views("trades", f"""
    SELECT trader_id, COUNT(*) AS trade_count, {dbl('SUM(trade_value)')} AS total_value,
           COUNT(DISTINCT symbol) AS unique_symbols, {avg4('trade_value')} AS avg_trade_value,
           MAX(ts) AS last_trade
    FROM trades GROUP BY 1 ORDER BY SUM(trade_value) DESC, trader_id LIMIT 100"""))
def top_traders(t: Tables):
    return agg.top_traders(t.trades(), 100)


RISK = f"""SELECT {BAND} AS risk_level, COUNT(*) AS trade_count,
    {dbl('SUM(trade_value)')} AS total_value, {avg4('trade_value')} AS avg_trade_value,
    COUNT(DISTINCT trader_id) AS unique_traders FROM trades GROUP BY 1"""


@plan("risk_analysis", with_views("trades", RISK))
def risk_analysis(t: Tables):
    return agg.risk_analysis(clean.risk_banded(t.trades(), LOW, MID))


@plan("user_stats", with_views("orders_raw", f"""
    SELECT user_id, COUNT(*) AS order_count, {dbl('SUM(amount)')} AS total_spent,
           MAX(ts) AS last_order FROM orders_raw GROUP BY 1"""))
def user_stats(t: Tables):
    return agg.user_stats(t.orders_raw(price=False))


@plan("hourly_revenue", with_views("ev", f"""
    SELECT date_trunc('hour', ts) AS hour, {dbl('SUM(value)')} AS revenue,
           COUNT(*) AS order_count FROM ev GROUP BY 1"""))
def hourly_revenue(t: Tables):
    return agg.revenue_by_time(t.events(), "hour", amount="value")


@plan("dashboard_sales", with_views("orders_raw", f"""
    SELECT date_trunc('minute', ts) AS minute, COUNT(*) AS orders, {dbl(f'SUM({TOTAL})')} AS revenue,
           {avg4(TOTAL)} AS avg_order_value, COUNT(DISTINCT user_id) AS unique_customers
    FROM orders_raw GROUP BY 1"""))
def dashboard_sales(t: Tables):
    return agg.dashboard_sales(t.orders_raw())


@plan("ml_user_features", with_views("orders_raw", f"""
    SELECT user_id, COUNT(*) AS total_orders, {dbl(f'SUM({TOTAL})')} AS total_spent,
           {avg4(TOTAL)} AS avg_order_value,
           date_sub('second', MIN(ts), MAX(ts)) AS lifetime_seconds,
           COUNT(DISTINCT date_trunc('day', ts)) AS active_days,
           COUNT(*) FILTER (WHERE {TOTAL} > 40000) AS high_value_orders
    FROM orders_raw GROUP BY 1"""))
def ml_user_features(t: Tables):
    return agg.user_features(t.orders_raw(), high_value=40000)




@plan("ml_product_features", with_views("orders_raw items", f"""
    SELECT item_id, item_name, category, COUNT(*) AS total_orders,
           {big('SUM(qty)')} AS total_quantity_sold, {avg4('unit_price')} AS avg_price,
           COUNT(DISTINCT user_id) AS unique_customers,
           {dbl('MAX(unit_price) - MIN(unit_price)')} AS price_range,
           ROUND(stddev_samp(CAST(unit_price AS DOUBLE)), 4) AS price_stddev
    FROM u JOIN items USING (item_id) GROUP BY 1, 2, 3""",
    u="""SELECT o.*, CAST(floor(amount) AS DECIMAL(18,2)) AS unit_price FROM orders_raw o"""))
def ml_product_features(t: Tables):
    lines = t.orders_raw(price=False).withColumn("unit_price", F.floor("amount").cast(MONEY))
    return agg.product_features(lines, t.items(), price="unit_price")


@plan("emp_by_year", with_views("emp", f"""
    SELECT CAST(year(time) AS INTEGER) AS year, COUNT(*) AS employees,
           {avg4('salary', 2)} AS avg_salary, {dbl('MIN(salary)')} AS min_salary,
           {dbl('MAX(salary)')} AS max_salary FROM emp GROUP BY 1"""))
def emp_by_year(t: Tables):
    return agg.salary_stats(t.emp(), {"year": F.year("time")})


@plan("dept_stats", with_views("emp", f"""
    SELECT department, COUNT(*) AS employees, {avg4('salary', 2)} AS avg_salary,
           {dbl('MIN(salary)')} AS min_salary, {dbl('MAX(salary)')} AS max_salary
    FROM emp GROUP BY 1"""))
def dept_stats(t: Tables):
    return agg.salary_stats(t.emp(), {"department": F.col("department")})


@plan("category_having", with_views("products", f"""
    SELECT category, COUNT(*) AS row_count, {dbl('SUM(price)')} AS total FROM products
    GROUP BY 1 HAVING COUNT(*) > 300"""))
def category_having(t: Tables):
    return agg.category_totals(t.products(), "category", "price", 300)


@plan("materializing_scan", with_views("line_items", f"""
    SELECT CASE WHEN grouping(qty) = 1 THEN 'ALL' ELSE CAST(qty AS VARCHAR) END AS grp,
           COUNT(*) AS row_count, {dbl('SUM(amount)')} AS total, {dbl('MIN(amount)')} AS min_value,
           {dbl('MAX(amount)')} AS max_value, {avg4('amount')} AS avg_value, MAX(ts) AS last_ts
    FROM line_items GROUP BY GROUPING SETS ((qty), ())"""))
def materializing_scan(t: Tables):
    return agg.measure_profile(t.line_items(), "amount", "ts", "qty")


@plan("category_profile", with_views("products", f"""
    SELECT category, COUNT(*) AS products, {avg4('price')} AS avg_price,
           {big('SUM(stock_quantity)')} AS total_stock, {dbl('MIN(price)')} AS min_price,
           {dbl('MAX(price)')} AS max_price,
           COUNT(*) FILTER (WHERE stock_quantity < 25) AS low_stock_products
    FROM products GROUP BY 1"""))
def category_profile(t: Tables):
    return agg.category_profile(t.products(), low_stock=25)


PARTIAL = """SELECT item_id % 7 AS category, date_trunc('month', ts) AS batch, COUNT(*) AS n,
    SUM(amount) AS s, MAX(ts) AS last FROM {table} GROUP BY 1, 2"""


@plan("summing_merge", with_views("line_items", f"""
    SELECT category, {big('SUM(n)')} AS event_count, {dbl('SUM(s)')} AS total_value,
           MAX(last) AS last_updated FROM p GROUP BY 1""", p=PARTIAL.format(table="line_items")))
def summing_merge(t: Tables):
    batches = t.line_items().select((F.col("item_id") % 7).alias("category"), "amount", "ts",
                                    agg.trunc("ts", "month").alias("batch"))
    partials = agg.partial_sums(batches, ["category", "batch"], "amount", "ts").drop("batch")
    return agg.merge_sums(partials, ["category"])


@plan("raw_vs_final", with_views("line_clean", " UNION ALL ".join(
    f"SELECT '{n}' AS source, item_id % 7 AS category, COUNT(*) AS row_count, "
    f"{dbl('SUM(amount)')} AS total FROM {v} GROUP BY 2"
    for n, v in [("Raw", "line_items"), ("FINAL", "line_clean")])))
def raw_vs_final(t: Tables):
    cat = (F.col("item_id") % 7).alias("category")
    raw = t.line_items().select(cat, "amount")
    final = t.orders_clean(user=False, price=False).select(cat, "amount")
    return agg.raw_vs_final(raw, final, "category", "amount")


@plan("tenant_sales", with_views("orders_raw users", f"""
    SELECT user_tier AS tenant_id, date_trunc('day', ts) AS day, COUNT(*) AS orders,
           {dbl(f'SUM({TOTAL})')} AS revenue, COUNT(DISTINCT user_id) AS unique_users
    FROM orders_raw LEFT JOIN users USING (user_id) GROUP BY 1, 2"""))
def tenant_sales(t: Tables):
    return agg.tenant_sales(clean.with_total(t.orders_raw()), t.users(), "user_tier")


@plan("tenant_usage", with_views("orders_raw users", f"""
    SELECT user_tier AS tenant_id, COUNT(*) AS order_count, {dbl(f'SUM({TOTAL})')} AS revenue,
           COUNT(DISTINCT user_id) AS user_count, COUNT(*) * 100 AS estimated_storage_bytes
    FROM orders_raw LEFT JOIN users USING (user_id) GROUP BY 1"""))
def tenant_usage(t: Tables):
    return agg.tenant_usage(clean.with_total(t.orders_raw()), t.users(), "user_tier")


@plan("item_revenue", with_views("line_items", f"""
    SELECT item_id, COUNT(*) AS order_count, {dbl('SUM(amount)')} AS revenue FROM line_items
    WHERE {RECENT} GROUP BY 1"""))
def item_revenue(t: Tables):
    return agg.totals_by(clean.recent(t.line_items(), AS_OF, MONTH), ["item_id"], "amount")


@plan("dimension_totals", with_views("orders_raw items users", " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS key, COUNT(*) AS order_count, "
    f"{dbl('SUM(amount)')} AS revenue FROM j GROUP BY 2"
    for d in ("user_id", "category", "user_tier")),
    j="""SELECT * FROM orders_raw LEFT JOIN items USING (item_id)
         LEFT JOIN users USING (user_id)"""))
def dimension_totals(t: Tables):
    per_user = agg.totals_by(t.orders_raw(price=False), ["user_id"], "amount")
    per_item = agg.totals_by(t.line_items(), ["item_id"], "amount")
    return agg.totals_per_dimension(per_user, t.users(), "user_id", ["user_id", "user_tier"]).unionByName(
        agg.totals_per_dimension(per_item, t.items(), "item_id", ["category"]))


# ---- windows over rows ---------------------------------------------------------------------------

@plan("rank_in_category", with_views("orders_raw items", f"""
    SELECT order_id, line, item_id, category, {dbl('amount')} AS amount,
           RANK() OVER (PARTITION BY category ORDER BY amount DESC) AS rank_in_category
    FROM line_items LEFT JOIN items USING (item_id)"""))
def rank_in_category(t: Tables):
    lines = t.line_items().join(t.items(), "item_id", "left")
    ranked = ranking.rank_in_group(lines, "category", "amount")
    return ranked.select("order_id", "line", "item_id", "category", "amount", "rank_in_category")


@plan("product_price_rank", with_views("products", f"""
    SELECT id, name, category, {dbl('price')} AS price,
           RANK() OVER (PARTITION BY category ORDER BY price DESC) AS rank_in_category
    FROM products WHERE price > 10"""))
def product_price_rank(t: Tables):
    ranked = ranking.rank_in_group(t.products().filter(F.col("price") > 10), "category", "price")
    return ranked.select("id", "name", "category", "price", "rank_in_category")


PREV_ORDER = "ts, order_id, line, item_id, qty, amount, discount_pct"


@plan("prev_amount", with_views("orders_raw", f"""
    SELECT user_id, order_id, line, item_id, ts, {dbl('amount')} AS amount,
           {dbl(f'LAG(amount) OVER (PARTITION BY user_id ORDER BY {PREV_ORDER})')} AS prev_amount
    FROM orders_raw"""))
def prev_amount(t: Tables):
    lines = t.orders_raw(price=False)
    out = windows.previous_value(lines, ["user_id"], PREV_ORDER.split(", "), "amount",
                                 "prev_amount")
    return out.select("user_id", "order_id", "line", "item_id", "ts", "amount", "prev_amount")


@plan("group_top_n", with_views("orders_raw items", f"""
    SELECT * FROM (SELECT category, order_id, line, item_id, {dbl('amount')} AS amount,
        CAST(row_number() OVER (PARTITION BY category ORDER BY amount DESC, order_id, line, item_id,
            ts) AS INTEGER) AS rank FROM line_items LEFT JOIN items USING (item_id))
    WHERE rank <= 10"""))
def group_top_n(t: Tables):
    lines = t.line_items().join(t.items(), "item_id", "left")
    top = ranking.top_n_per_group(
        lines, ["category"], [F.desc("amount"), "order_id", "line", "item_id", "ts"], 10)
    return top.select("category", "order_id", "line", "item_id", "amount", "rank")


@plan("key_history", with_views("line_items", f"""
    SELECT order_id, line, ts, item_id, qty, {dbl('amount')} AS amount, version, versions FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id, line
                   ORDER BY ts, item_id, qty, amount, discount_pct) AS version,
               COUNT(*) OVER (PARTITION BY order_id, line) AS versions FROM line_items)
    WHERE versions > 1"""))
def key_history(t: Tables):
    numbered = ranking.key_history(t.line_items(), ["order_id", "line"], LINE_VERSION)
    return numbered.select("order_id", "line", "ts", "item_id", "qty", "amount", "version",
                           "versions")


# ---- top-k ---------------------------------------------------------------------------------------

@plan("top_products", with_views("orders_raw items", f"""
    SELECT item_name, category, COUNT(*) AS order_count, {dbl(f'SUM({TOTAL})')} AS total_revenue
    FROM orders_raw LEFT JOIN items USING (item_id) WHERE {RECENT} GROUP BY 1, 2
    ORDER BY SUM({TOTAL}) DESC, item_name, category LIMIT 10"""))
def top_products(t: Tables):
    recent = clean.recent(clean.with_total(t.orders_raw(user=False)), AS_OF, MONTH)
    return agg.top_products(recent, t.items(), 10)


@plan("top_priced", with_views("products", f"""
    SELECT id, name, category, {dbl('price')} AS price FROM products
    ORDER BY products.price DESC, id LIMIT 50"""))
def top_priced(t: Tables):
    return agg.top(t.products(), 50, F.desc("price"), "id").select(
        "id", "name", "category", "price")


@plan("top_salaries", with_views("emp", f"""
    SELECT id, department, {dbl('salary')} AS salary, time FROM emp
    ORDER BY emp.salary DESC, id LIMIT 5"""))
def top_salaries(t: Tables):
    return agg.top(t.emp(), 5, F.desc("salary"), "id").select("id", "department", "salary", "time")


@plan("top_duplicates", """
    SELECT l_orderkey AS order_id, l_linenumber AS line, COUNT(*) AS occurrences FROM lineitem
    GROUP BY 1, 2 HAVING COUNT(*) > 1 ORDER BY 3 DESC, 1, 2 LIMIT 10""")
def top_duplicates(t: Tables):
    return agg.top_duplicates(t.line_items(), ["order_id", "line"], 10)


CATEGORY_WINDOWS = f"""
    SELECT category, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start,
           time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') + INTERVAL 1 DAY AS window_end,
           {dbl('SUM(amount)')} AS revenue, COUNT(*) AS order_count
    FROM {{table}} LEFT JOIN items USING (item_id) GROUP BY 1, 2, 3"""


@plan("latest_windows", with_views("line_items items", """
    SELECT * FROM w ORDER BY window_start DESC, category LIMIT 20""",
    w=CATEGORY_WINDOWS.format(table="line_items")))
def latest_windows(t: Tables):
    w = windows.revenue_tumble(t.line_items(), t.items(), DAY)
    return agg.top(w, 20, F.desc("window_start"), "category")


@plan("ordered_reads", with_views("trades", f"{RISK} ORDER BY SUM(trade_value) DESC, 1"))
def ordered_reads(t: Tables):
    return risk_analysis(t).orderBy(F.desc("total_value"), "risk_level")


# ---- time windows --------------------------------------------------------------------------------

@plan("revenue_tumble", with_views("line_clean items",
                                   CATEGORY_WINDOWS.format(table="line_clean")))
def revenue_tumble(t: Tables):
    """Flagship: newest version of every line, revenue per item and day, then per category."""
    lines = t.orders_clean(user=False, price=False)
    return windows.revenue_tumble(lines, t.items(), DAY)


@plan("category_hourly", with_views("orders_raw items", f"""
    SELECT category, time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS window_start,
           COUNT(*) AS orders, {dbl(f'SUM({TOTAL})')} AS revenue, {avg4(TOTAL)} AS avg_order_value
    FROM orders_raw LEFT JOIN items USING (item_id) GROUP BY 1, 2"""))
def category_hourly(t: Tables):
    totals = windows.priced_totals(t.line_items(), t.priced_items(), "7 days")
    # an unknown item has no price, and its orders do not count in the mean
    priced = F.sum(F.when(F.col("price").isNotNull(), F.col("order_count")))
    return totals.groupBy("category", "window_start").agg(
        F.sum("order_count").alias("orders"), F.sum("revenue").alias("revenue"),
        means.ratio(F.sum("revenue"), priced).alias("avg_order_value"))


@plan("trades_5min", with_views("trades", f"""
    SELECT symbol, time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS window_start,
           time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') + INTERVAL 7 DAY AS window_end,
           COUNT(*) AS trade_count, {big('SUM(volume)')} AS total_volume,
           {dbl('SUM(trade_value)')} AS total_value, {avg4('trade_value')} AS avg_value,
           {dbl('MIN(trade_value)')} AS min_value, {dbl('MAX(trade_value)')} AS max_value
    FROM trades GROUP BY 1, 2, 3"""))
def trades_5min(t: Tables):
    return windows.trade_windows(t.trades(), "7 days")


# ---- rolling profile over orders -----------------------------------------------------------------

@plan("order_spending_profile", with_views("orders_raw", f"""
    SELECT user_id, day, {dbl('s')} AS daily_spending,
           {avg4('s', over='w')} AS avg_7day_spending,
           {dbl('MAX(s) OVER w - MIN(s) OVER w')} AS spending_range_7day
    FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    d=f"SELECT user_id, date_trunc('day', ts) AS day, SUM({TOTAL}) AS s FROM orders_raw GROUP BY 1, 2"))
def order_spending_profile(t: Tables):
    return anomaly.daily_spending(clean.with_total(t.orders_raw()), "total_amount")
