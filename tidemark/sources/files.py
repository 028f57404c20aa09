"""File sources: inventories, ordered text lines, daily sheets, logs and result files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.segments import fill_forward
from ..functions.text import to_number


def file_inventory(df: DataFrame) -> DataFrame:
    """Files a Parquet-backed table is read from, with size and rows."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.max("_metadata.file_size").alias("bytes"), F.count("*").alias("row_count"))


def storage_report(inventory: DataFrame, group: Column) -> DataFrame:
    """Bytes, files and rows per group of files (a table, a partition)."""
    return inventory.groupBy(group.alias("part")).agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes"),
        F.sum("row_count").alias("row_count"))


def row_location(df: DataFrame) -> DataFrame:
    """Every row with the file and the row number in it where it is stored."""
    return df.select("*", F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.row_index").alias("row_index"))


# ---- text in line order ------------------------------------------------------------------------

def read_lines(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Text lines as (file, block, pos, line); (block, pos) orders the lines of a file.

    A large file is read as several blocks by several tasks. ``block`` is the byte offset of the
    block and ``pos`` grows within it, so no file is ever one row or one task.
    """
    text = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
            .text(path))
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))


def write_logs(lines: DataFrame, path: str) -> None:
    """Lines (file, block, pos, line) as text files, one folder per ``file``, in the order of a file."""
    (lines.repartition("file").sortWithinPartitions("file", "block", "pos").select("file", "line")
     .write.partitionBy("file").text(path))


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files that lie in folders named after their log."""
    lines = read_lines(spark, path, "*.txt")
    return lines.withColumn("file", F.regexp_extract("file", "file=([^/]+)/", 1))


def read_market_days(spark: SparkSession, path: str, schema: str, preamble: int = 2,
                     width: int = 64, pattern: str = "*.csv") -> DataFrame:
    """Daily CSV sheets of one folder: ``preamble`` lines and a header, then the rows.

    Columns are found by the names in each sheet's own header, wherever they stand there; a column that
    a sheet lacks is NULL in its rows, and others are left out. A sheet has at most ``width`` columns.
    The day is the date in the name of the file, or of its folder if that is one sheet. A sheet without rows contributes nothing.
    """
    wanted = T.StructType.fromDDL(schema).fields
    lines = read_lines(spark, path, pattern)
    # only the first block of a file holds its preamble and its header
    in_block = Window.partitionBy("file", "block").orderBy("pos")
    numbered = lines.withColumn("no", F.row_number().over(in_block))
    cells = F.from_csv("line", ", ".join(f"c{i} string" for i in range(width)))
    cells = F.array(*[F.trim(cells[f"c{i}"]) for i in range(width)])
    header = numbered.filter((F.col("block") == 0) & (F.col("no") == preamble + 1)).select(
        F.col("file").alias("of"), cells.alias("names"))
    body = numbered.filter((F.col("block") > 0) | (F.col("no") > preamble + 1))
    body = body.filter(F.trim("line") != "").select("file", cells.alias("cells"))
    # one header per sheet
    named = body.join(header, F.col("file") == F.col("of"))

    def column(f):
        at = F.coalesce(F.array_position("names", F.lit(f.name)), F.lit(0)).cast("int")
        return F.when(at > 0, F.element_at("cells", F.greatest(at, F.lit(1)))).cast(f.dataType).alias(
            f.name)

    day = F.regexp_extract("file", r"(\d{4}-\d{2}-\d{2})[^/]*(?:/part-[^/]*)?$", 1)
    return named.select(*[column(f) for f in wanted], day.alias("en_date"))


# Fixed patterns of the benchmark logs.
LOG_PREFIX = r"^\d{2}:\d{2}:\d{2}\s+\|\s+\w+\s+\|\s?"
MODE_LINE = r"MODE: (.+?)(?: -|$)"
DRIVER_LINE = r"Driver: (\w+) \| Wall clock: ([\d.]+)s"
FETCH_HEADER = r"Fetch-speed benchmark \((\w+)\):"
FETCH_ROW = r"([\d,]+) rows: ([\d.]+)s"
METRIC_LINES = {
    "queries": r"Queries:\s+(\d+)",
    "avg": r"Avg:\s+([\d.]+)s",
    "p50": r"p50 \(median\):\s+([\d.]+)s",
    "p95": r"p95:\s+([\d.]+)s",
    "p99": r"p99:\s+([\d.]+)s",
    "min": r"Min:\s+([\d.]+)s",
    "max": r"Max:\s+([\d.]+)s",
    "qps": r"Throughput:\s+([\d.]+) q/s",
}


def _found(line: Column, pattern: str, group: int = 1) -> Column:
    """The captured text, or NULL where the pattern does not match."""
    return F.nullif(F.regexp_extract(line, pattern, group), F.lit(""))


def parse_suite_logs(lines: DataFrame) -> DataFrame:
    """One row per run block: file, mode, driver and its metrics.

    A block begins with its driver line. Lines learn their block and the mode of their file by
    carrying the last header forward; the metrics of a block are then a plain aggregate.
    """
    line = F.regexp_replace("line", LOG_PREFIX, "")
    tagged = lines.select("file", "block", "pos", line.alias("line"))
    tagged = tagged.withColumns({
        "mode": _found(F.col("line"), MODE_LINE),
        "driver": _found(F.col("line"), DRIVER_LINE),
        "wall": to_number(_found(F.col("line"), DRIVER_LINE, 2)),
        **{m: to_number(_found(F.col("line"), p)) for m, p in METRIC_LINES.items()}})
    header = F.col("driver").isNotNull()
    tagged = tagged.withColumn("run", F.when(header, F.struct("block", "pos", "driver", "wall")))
    any_value = F.coalesce("mode", "driver", *[F.col(m).cast("string") for m in METRIC_LINES])
    useful = tagged.filter(any_value.isNotNull())
    known = fill_forward(useful, ["file"], ["block", "pos"], F.col("block"), ["run", "mode"])
    blocks = known.filter(F.col("run").isNotNull()).groupBy("file", "run").agg(
        F.min_by("mode", F.struct("block", "pos")).alias("mode"),
        *[F.min_by(m, F.when(F.col(m).isNotNull(), F.struct("block", "pos"))).alias(m)
          for m in METRIC_LINES])
    return blocks.select(
        "file", F.coalesce("mode", F.lit("unknown")).alias("mode"),
        F.col("run.driver").alias("driver"), F.col("run.wall").alias("wall"), *METRIC_LINES)


def parse_fetch_logs(lines: DataFrame) -> DataFrame:
    """(file, driver, rows, secs) from fetch-speed logs; rows before any header are dropped."""
    line = F.regexp_replace("line", LOG_PREFIX, "")
    tagged = lines.select(
        "file", "block", "pos",
        F.lower(_found(line, FETCH_HEADER)).alias("driver"),
        to_number(_found(line, FETCH_ROW)).cast("long").alias("rows"),
        to_number(_found(line, FETCH_ROW, 2)).alias("secs"))
    useful = tagged.filter(F.col("driver").isNotNull() | F.col("rows").isNotNull())
    known = fill_forward(useful, ["file"], ["block", "pos"], F.col("block"), ["driver"])
    return known.filter(F.col("rows").isNotNull() & F.col("driver").isNotNull()).select(
        "file", "driver", "rows", "secs")


# ---- result files --------------------------------------------------------------------------------

RESULT_METRICS = (
    "target:string, run_id:int, successful:long, failed:long, total_data_mb:double, "
    "wall_time_sec:double, aggregate_throughput_mbps:double, latency_mean:double, "
    "latency_p50:double, latency_p95:double, latency_p99:double, latency_min:double, "
    "latency_max:double, latency_stdev:double")
HEAVY_METRICS = (
    "wall_time_sec:double, total_data_mb:double, aggregate_throughput_mbps:double, "
    "write_success_rate:double, read_success_rate:double, write_latency_p50:double, "
    "read_latency_p50:double, write_latency_p99:double, read_latency_p99:double")
RESULT_SCHEMA = (
    f"mode string, engine string, threads int, write struct<{RESULT_METRICS}>, "
    f"read struct<{RESULT_METRICS}>, heavy struct<{HEAVY_METRICS}>")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Result files ``{mode}/{size}/{target}/run-N.json`` or ``threads-T_run-N.json``.

    Path parts become columns; engine and threads may be absent from the file.
    """
    raw = (spark.read.schema(RESULT_SCHEMA).option("multiLine", "true")
           .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(path))
    p = F.col("_metadata.file_path")

    def part(pattern):
        return F.nullif(F.regexp_extract(p, pattern, 1), F.lit(""))

    tail = r"/[^/]*\.json$"
    return raw.withColumns({
        "path_mode": part(r"([^/]+)/[^/]+/[^/]+" + tail),
        "size": part(r"([^/]+)/[^/]+" + tail),
        "target": part(r"([^/]+)" + tail),
        "run": part(r"run-(\d+)\.json$").cast("int"),
        "threads": F.coalesce("threads", part(r"threads-(\d+)_").cast("int"))})


# ---- small declared tables -----------------------------------------------------------------------

# Fixed values of the demonstration dimensions.
DEMO_ITEMS = [
    (1, "Laptop", "Electronics", "899.99"),
    (2, "Mouse", "Accessories", "29.99"),
    (3, "Monitor", "Electronics", "299.99"),
    (4, "Keyboard", "Accessories", "79.99"),
    (5, "Headphones", "Electronics", "149.99"),
    (6, "USB Cable", "Accessories", "12.99"),
    (7, "Webcam", "Electronics", "89.99"),
    (8, "Desk Lamp", "Accessories", "39.99"),
    (9, "External SSD", "Electronics", "199.99"),
    (10, "Mouse Pad", "Accessories", "19.99"),
]
RISK_BANDS = [(1, "Low", "0.00", "10000.00"), (2, "Medium", "10000.01", "50000.00"),
              (3, "High", "50000.01", "999999.99")]


def static_dimension(spark: SparkSession, rows: list[tuple], schema: str | T.StructType,
                     money: tuple[str, ...] = ()) -> DataFrame:
    """A small typed-in table; columns named in ``money`` are given as text and become exact.

    The rows are literals of the plan, so no Python runs when it is read."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    typed = F.array(*[F.struct(*[
        F.lit(v).cast("decimal(18,2)" if f.name in money else f.dataType).alias(f.name)
        for f, v in zip(fields, row, strict=True)]) for row in rows])
    return spark.range(1).select(F.inline(typed))


def demo_items(spark: SparkSession) -> DataFrame:
    return static_dimension(
        spark, DEMO_ITEMS, "item_id int, item_name string, category string, base_price string",
        ("base_price",))


def risk_bands(spark: SparkSession) -> DataFrame:
    return static_dimension(
        spark, RISK_BANDS,
        "risk_id int, risk_level string, threshold_min string, threshold_max string",
        ("threshold_min", "threshold_max"))
