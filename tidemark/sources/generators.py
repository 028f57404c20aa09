"""Deterministic test data as Spark jobs: the same seed gives the same rows on any cluster.

Random values are hashes of (row number, column, seed), so no value depends on partitioning. Walks
and drifts are running sums of whole-number steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.segments import running_total
from .files import DEMO_ITEMS

# Fixed values of the generated events.
ORDER_STATUSES = ["pending", "processing", "shipped", "delivered", "cancelled"]
DISCOUNTS = [0.0, 0.0, 0.0, 5.0, 10.0, 15.0, 20.0]
PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "apple_pay"]
SOURCE_SYSTEMS = ["web", "mobile_app", "api"]
SYMBOLS = ["AAPL", "GOOGL", "MSFT", "AMZN", "TSLA", "META", "NVDA", "AMD", "INTC", "NFLX"]
EXCHANGES = ["NYSE", "NASDAQ", "CBOE"]
EVENT_TYPES = ["page_view", "click", "search", "add_to_cart", "purchase", "login", "logout"]
PAGES = ["/home", "/products", "/cart", "/checkout", "/profile", "/help"]
REFERRERS = [None, "google.com", "facebook.com", "twitter.com"]
DEVICES = ["desktop", "mobile", "tablet"]
BROWSERS = ["Chrome", "Firefox", "Safari", "Edge"]
RETURN_REASONS = ["defective", "wrong_item", "changed_mind", "too_late"]
CITIES = ["Berlin", "Lagos", "Lima", "Osaka", "Oslo", "Quito", "Tehran", "Turin"]
CURRENCIES = ["USD", "GBP"]
CARD_METHODS = ["credit_card", "debit_card", "online_transfer"]
PRODUCT_CATEGORIES = ["Electronics", "Books", "Clothing", "Home", "Sports"]
CATEGORIES = ["A", "B", "C", "D"]

CELL = 100_000
START = "2024-01-01 00:00:00"


class Random:
    """Column expressions from hashes of the row id."""

    def __init__(self, seed: int, id_column: str = "id"):
        self.seed, self.id = seed, F.col(id_column)

    def bits(self, name: str) -> Column:
        return F.xxhash64(self.id, F.lit(name), F.lit(self.seed))

    def unit(self, name: str) -> Column:
        """Uniform in [0, 1) with 53 bits."""
        return F.pmod(self.bits(name), F.lit(1 << 53)).cast("double") / float(1 << 53)

    def between(self, name: str, low: float, high: float) -> Column:
        return F.lit(float(low)) + self.unit(name) * float(high - low)

    def integer(self, name: str, low: int, high: int) -> Column:
        return (F.pmod(self.bits(name), F.lit(high - low + 1)) + low).cast("int")

    def pick(self, name: str, values: list) -> Column:
        options = F.array(*[F.lit(v) for v in values])
        return F.get(options, self.integer(name, 0, len(values) - 1))

    def uuid(self, name: str) -> Column:
        h = F.md5(F.concat_ws(":", F.lit(str(self.seed)), F.lit(name), self.id.cast("string")))
        return F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def _rows(spark: SparkSession, n: int, every: str = "1 second", start: int = 0) -> DataFrame:
    step = F.expr(f"INTERVAL {every}")
    ids = spark.range(start, n)
    return ids.withColumn("ts", F.lit(START).cast("timestamp_ntz") + step * F.col("id"))


def _money(c: Column) -> Column:
    return F.round(c, 2).cast("decimal(18,2)")


def orders(spark: SparkSession, n: int, seed: int = 1) -> DataFrame:
    r = Random(seed)
    item = F.get(F.array(*[F.struct(F.lit(i).alias("item_id"), F.lit(float(p)).alias("base"))
                           for i, _, _, p in DEMO_ITEMS]), r.integer("item", 0, len(DEMO_ITEMS) - 1))
    rows = _rows(spark, n).withColumns({
        "order_id": F.col("id") + 1000, "user_id": r.integer("user", 1, 10000).cast("long"),
        "item": item, "qty": r.integer("qty", 1, 5)})
    priced = rows.withColumn("price", _money(F.col("item.base") * r.between("price", 0.9, 1.1)))
    return priced.select(
        "order_id", "user_id", F.col("item.item_id").cast("long").alias("item_id"), "qty", "price",
        (F.col("qty") * F.col("price")).cast("decimal(18,2)").alias("amount"),
        r.pick("discount", DISCOUNTS).cast("decimal(5,2)").alias("discount_pct"),
        r.pick("status", ORDER_STATUSES).alias("status"), "ts",
        F.concat(F.lit("Customer "), F.col("user_id")).alias("customer_name"),
        F.concat(F.lit("customer"), F.col("user_id"), F.lit("@example.com")).alias("customer_email"),
        F.struct(F.concat(r.integer("house", 1, 999), F.lit(" Main Street")).alias("street"),
                 r.pick("city", CITIES).alias("city"), F.lit("CA").alias("state"),
                 F.lpad(r.integer("zip", 0, 99999).cast("string"), 5, "0").alias("zip"),
                 F.lit("US").alias("country")).alias("shipping_address"),
        r.pick("payment", PAYMENT_METHODS).alias("payment_method"),
        r.pick("system", SOURCE_SYSTEMS).alias("source_system"))


def sensors(spark: SparkSession, n: int, count: int = 50, seed: int = 2) -> DataFrame:
    """Readings around a drifting base; about 2 % are anomalies with status ALERT."""
    r = Random(seed)
    rows = _rows(spark, n).withColumns({
        "sensor": r.integer("sensor", 0, count - 1),
        "step": F.round(r.between("step", -50, 50)).cast("long")})
    rows = running_total(rows, ["sensor"], ["id"], F.floor(F.col("id") / CELL), F.col("step"), "drift")
    of_sensor = Random(seed, "sensor")
    base = of_sensor.between("base", 15, 25) + (F.col("drift") - F.col("step")) / 100
    alert = r.unit("alert") < 0.02
    heat = F.when(alert, r.between("heat", 20, 40)).otherwise(r.between("noise", -2, 2))
    return rows.select(
        F.format_string("sensor_%03d", "sensor").alias("sensor_id"),
        F.round(base + heat, 2).alias("temperature"),
        F.round(r.between("humidity", 30, 70), 2).alias("humidity"),
        F.round(r.between("pressure", 980, 1020), 2).alias("pressure"),
        F.round(r.between("battery", 70, 100), 1).alias("battery_level"),
        F.when(alert, "ALERT").otherwise("NORMAL").alias("status"),
        F.struct(F.round(r.between("lat", 37, 38), 6).alias("lat"),
                 F.round(r.between("lon", -122.5, -121.5), 6).alias("lon")).alias("location"), "ts")


def trades(spark: SparkSession, n: int, seed: int = 3) -> DataFrame:
    """Prices walk by factors in [0.995, 1.005], as sums of logarithms in billionths."""
    r = Random(seed)
    step = F.round(F.log(r.between("step", 0.995, 1.005)) * 1e9).cast("long")
    rows = _rows(spark, n, "100 milliseconds").withColumns(
        {"symbol": r.pick("symbol", SYMBOLS), "step": step})
    rows = running_total(rows, ["symbol"], ["id"], F.floor(F.col("id") / CELL), F.col("step"), "walk")
    start = Random(seed, "symbol").between("start", 100, 500)
    return rows.select(
        (F.col("id") + 1000000).alias("trade_id"), "symbol",
        _money(start * F.exp(F.col("walk") / 1e9)).alias("price"),
        r.integer("volume", 100, 10000).alias("volume"),
        r.pick("side", ["BUY", "SELL"]).alias("side"), r.pick("exchange", EXCHANGES).alias("exchange"),
        F.format_string("trader_%04d", r.integer("trader", 1, 1000)).alias("trader_id"), "ts")


def activity(spark: SparkSession, n: int, seed: int = 4) -> DataFrame:
    """User events; a search has a query, cart and purchase events have product and price."""
    r = Random(seed)
    rows = _rows(spark, n).withColumn("event_type", r.pick("type", EVENT_TYPES))
    buys = F.col("event_type").isin("add_to_cart", "purchase")
    octets = [r.integer(f"ip{i}", 1, 254).cast("string") for i in range(4)]
    return rows.select(
        r.uuid("event").alias("event_id"), r.integer("user", 1, 10000).cast("long").alias("user_id"),
        r.uuid("session").alias("session_id"), "event_type", r.pick("page", PAGES).alias("page_url"),
        r.pick("referrer", REFERRERS).alias("referrer"), r.pick("device", DEVICES).alias("device"),
        r.pick("browser", BROWSERS).alias("browser"), F.concat_ws(".", *octets).alias("ip_address"),
        r.pick("country", ["DE", "IR", "JP", "NG", "NO", "PE", "US"]).alias("country"), "ts",
        F.when(F.col("event_type") == "search",
               F.concat(F.lit("query "), r.integer("query", 1, 500))).alias("search_query"),
        F.when(buys, r.integer("product", 1, 100)).alias("product_id"),
        F.when(buys, _money(r.between("price", 10, 500))).alias("price"))


def returns(spark: SparkSession, n: int, orders_from: int = 1000, orders_to: int = 999999,
            seed: int = 5) -> DataFrame:
    r = Random(seed)
    return _rows(spark, n).select(
        (F.col("id") + 1000).alias("return_id"),
        r.integer("order", orders_from, orders_to).cast("long").alias("order_id"),
        _money(r.between("refund", 10, 500)).alias("refund_amount"),
        r.pick("reason", RETURN_REASONS).alias("reason"), "ts")


def card_transactions(spark: SparkSession, n: int, seed: int = 6) -> DataFrame:
    """Unprocessed card payments; most have no voucher."""
    r = Random(seed)
    voucher = F.when(r.unit("has_voucher") < 0.1, F.concat(F.lit("DISCOUNT"), r.integer("v", 1, 99)))
    return _rows(spark, n).select(
        r.uuid("tx").alias("transactionId"), F.concat(F.lit("user"), r.integer("u", 1, 5000)).alias("userId"),
        F.col("ts").alias("timestamp"), _money(r.between("amount", 10, 1000)).alias("amount"),
        r.pick("currency", CURRENCIES).alias("currency"), r.pick("city", CITIES).alias("city"),
        r.pick("country", ["DE", "IT", "JP", "NO"]).alias("country"),
        F.concat(F.lit("Merchant "), r.integer("m", 1, 200)).alias("merchantName"),
        r.pick("method", CARD_METHODS).alias("paymentMethod"),
        F.concat_ws(".", *[r.integer(f"ip{i}", 1, 254).cast("string") for i in range(4)]).alias("ipAddress"),
        F.coalesce(voucher, F.lit("")).alias("voucherCode"), r.uuid("affiliate").alias("affiliateId"),
        F.lit(False).alias("processed"))


def products(spark: SparkSession, target: int, existing: int = 0, seed: int = 7) -> DataFrame:
    """Products ``existing`` .. ``target``: a resumed load makes only the missing ones."""
    r = Random(seed)
    return _rows(spark, target, start=min(existing, target)).select(
        r.uuid("product").alias("id"), F.concat(F.lit("Product "), "id").alias("name"),
        r.pick("category", PRODUCT_CATEGORIES).alias("category"),
        _money(r.between("price", 1, 1000)).alias("price"),
        r.integer("stock", 0, 1000).alias("stock_quantity"),
        F.concat(F.lit("Description of product "), "id").alias("description"),
        F.col("ts").alias("created_at"))


def keyed_events(spark: SparkSession, n: int, copies: int = 1, seed: int = 8) -> DataFrame:
    """Ids 1..n, each ``copies`` times as if the load had been replayed; copies differ in time."""
    r = Random(seed)
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    rows = _rows(spark, n).select("id", "ts", copy)
    return rows.select(
        (F.col("id") + 1).cast("int").alias("event_id"), r.integer("value", 1, 1000).alias("value"),
        F.date_format(F.col("ts") + F.expr("INTERVAL 1 DAY") * F.col("copy"),
                      "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        r.pick("category", CATEGORIES).alias("category"))


def sensor_rows(spark: SparkSession, n: int, seed: int = 9) -> DataFrame:
    r = Random(seed)
    return _rows(spark, n).select(
        r.uuid("row").alias("id"), "ts", r.integer("sensor", 1, 1000).alias("sensor_id"),
        F.round(r.between("value", 0, 100), 4).alias("value"),
        F.concat(F.lit("label_"), r.integer("label", 0, 9)).alias("label"))


def category_events(spark: SparkSession, n: int, seed: int = 10) -> DataFrame:
    r = Random(seed)
    letters = F.array(*map(F.lit, CATEGORIES))
    return _rows(spark, n).select(
        "id", F.element_at(letters, (F.col("id") % 4 + 1).cast("int")).alias("category"),
        F.round(r.between("value", 0, 1000), 4).alias("value"), F.col("ts").alias("event_time"))


def tier_rows(spark: SparkSession, n: int, payload_bytes: int = 100, seed: int = 11) -> DataFrame:
    """Rows with a payload of a chosen size, to fill files of a chosen size."""
    r = Random(seed)
    number = F.lpad(F.col("id").cast("string"), 10, "0")
    filler = F.repeat(F.lit("x"), max(0, payload_bytes - 10))
    return _rows(spark, n).select(
        "id", F.concat(number, filler).alias("payload"), F.col("ts").alias("timestamp"),
        r.integer("category", 0, 9).alias("category"), r.unit("value").alias("value"))


def people(spark: SparkSession, n: int) -> DataFrame:
    """Users 1..n; even ids seek work, odd ids employ."""
    return spark.range(1, n + 1).select(
        "id", F.concat(F.lit("user"), "id").alias("username"),
        F.concat(F.lit("user"), "id", F.lit("@example.com")).alias("email"),
        F.when(F.col("id") % 2 == 0, "job_seeker").otherwise("employer").alias("user_type"))
