"""Streams with a declared schema, from files or from a message broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed schemas of the event topics.
ORDER_EVENT = (
    "order_id bigint, user_id bigint, item_id bigint, qty int, price decimal(18,2), "
    "amount decimal(18,2), discount_pct decimal(5,2), status string, ts timestamp, "
    "customer_name string, customer_email string, shipping_address struct<street: string, "
    "city: string, state: string, zip: string, country: string>, payment_method string, "
    "source_system string")
SENSOR_EVENT = (
    "sensor_id string, temperature double, humidity double, pressure double, "
    "battery_level double, status string, location struct<lat: double, lon: double>, ts timestamp")
TRADE_EVENT = (
    "trade_id bigint, symbol string, price decimal(18,2), volume int, side string, "
    "exchange string, trader_id string, ts timestamp")
ACTIVITY_EVENT = (
    "event_id string, user_id bigint, session_id string, event_type string, page_url string, "
    "referrer string, device string, browser string, ip_address string, country string, "
    "ts timestamp, search_query string, product_id int, price decimal(18,2)")
RETURN_EVENT = (
    "return_id bigint, order_id bigint, refund_amount decimal(18,2), reason string, ts timestamp")
KEYED_EVENT = "event_id int, value int, timestamp string, category string"


def stream_source(spark: SparkSession, format: str, schema: str, path: str | None = None,
                  **options: str) -> DataFrame:
    """Rows of a topic or of a growing folder; fields outside the schema are dropped.

    A broker delivers JSON text in ``value`` and is read from its earliest offset.
    """
    reader = spark.readStream.format(format)
    if format == "kafka":
        raw = reader.options(**{"startingOffsets": "earliest", **options}).load()
        body = F.from_json(F.col("value").cast("string"), schema)
        return raw.select(body.alias("e")).select("e.*")
    return reader.schema(schema).options(**options).load(path)


def table_stream(spark: SparkSession, folder: str, table: str,
                 files_per_trigger: int | None = None) -> DataFrame:
    """A stored Parquet table, a file or a folder of files, read as a stream."""
    path = f"{folder}/{table}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    # as a glob: a plain path would have to be a folder
    return reader.parquet(f"{folder}/{table}.parque[t]")


def replay(df: DataFrame, path: str, ts: str, triggers: int = 4,
           end_after: str | None = None, end_values: dict | None = None) -> DataFrame:
    """A stored table as a stream that arrives in event-time order, in bounded triggers.

    The rows are written below ``path`` in slices of about equally many rows, one slice after another,
    and each trigger of the stream takes one slice; a row is never earlier than those of the slices
    before it, so no watermark drops any. Rows without a time come first.

    With ``end_after`` a last trigger follows with one row that is NULL but for a time so long after
    the last one: it closes every window, session and join that is still open. Its own stays open, so
    in append mode it never comes out. The side of a join that must match needs ``end_values`` for its
    keys: rows with NULL keys are filtered away before the watermark sees them.
    """
    spark = df.sparkSession
    shares = [i / triggers for i in range(1, triggers)]
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("last"),
                  F.percentile_approx(F.col(ts).cast("timestamp"), shares).alias("cuts")
                  if shares else F.lit(None).alias("cuts")).first()
    # the last cut may be the least time: a slice without rows would be none of the triggers
    cuts = sorted(set(seen["cuts"] or []))
    files = 1 + seen["n"] // (triggers * ROWS_PER_FILE)
    t = F.col(ts).cast("timestamp")
    edges = [None, *cuts, None]
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        inside = F.lit(True)
        if low is not None:
            inside &= t >= F.lit(low)
        if high is not None:
            inside &= t < F.lit(high)
        if low is None:
            inside |= t.isNull()
        _slice(df.filter(inside), f"{path}/slice-{i:03d}", files)
    if end_after is not None and seen["last"] is not None:
        end = spark.range(1).select(*[
            ((F.lit(seen["last"]) + F.expr(f"INTERVAL {end_after}")) if f.name == ts
             else F.lit((end_values or {}).get(f.name))).cast(f.dataType).alias(f.name)
            for f in df.schema.fields])
        _slice(end, f"{path}/slice-end", files)
    return (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", str(files))
            .parquet(f"{path}/slice-*"))


#: rows of a file of a slice
ROWS_PER_FILE = 500_000


def _slice(df: DataFrame, path: str, files: int) -> None:
    """Write the rows as exactly so many files, the last of them empty if there are too few rows."""
    spark = df.sparkSession
    df.repartition(files).write.mode("overwrite").parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sum(f.getPath().getName().endswith(".parquet") for f in fs.listStatus(at))
    for _ in range(files - found):
        df.limit(0).coalesce(1).write.mode("append").parquet(path)
