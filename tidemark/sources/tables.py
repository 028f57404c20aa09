"""Views over the input tables in the shapes the operators work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

#: total order of the versions of one order line: time, then every other column
LINE_VERSION = ["ts", "item_id", "qty", "amount", "discount_pct"]


def money(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(MONEY)


class Tables:
    """Lazy readers; a caller selects what it needs and the scan is pruned to that."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    # ---- order lines -------------------------------------------------------------------------

    def line_items(self) -> DataFrame:
        """Order lines with the columns that come from the line itself."""
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_quantity").cast("int").alias("qty"),
            money("l_extendedprice").alias("amount"),
            money(F.col("l_discount") * 100).alias("discount_pct"),
            F.col("l_shipdate").alias("ts"))

    def with_user(self, lines: DataFrame) -> DataFrame:
        owners = self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))
        return lines.join(owners, "order_id", "left")

    def with_price(self, lines: DataFrame) -> DataFrame:
        prices = self.raw("part").select(
            F.col("p_partkey").alias("item_id"), money("p_retailprice").alias("price"))
        return lines.join(prices, "item_id", "left")

    def orders_raw(self, user: bool = True, price: bool = True) -> DataFrame:
        """At-least-once order lines: a line can arrive more than once."""
        return self._complete(self.line_items(), user, price)

    def orders_clean(self, user: bool = True, price: bool = True) -> DataFrame:
        """Newest version of every order line.

        The version is picked before the lookups: they depend on the line only, and the shuffle
        then carries the narrow row.
        """
        from ..operators.clean import latest_by_key
        lines = latest_by_key(self.line_items(), ["order_id", "line"], LINE_VERSION)
        return self._complete(lines, user, price)

    def _complete(self, lines: DataFrame, user: bool, price: bool) -> DataFrame:
        if user:
            lines = self.with_user(lines)
        return self.with_price(lines) if price else lines

    # ---- dimensions --------------------------------------------------------------------------

    def items(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("item_id"), F.col("p_name").alias("item_name"),
            F.col("p_type").alias("category"))

    def priced_items(self) -> DataFrame:
        """Name, category and list price of an item, for one lookup."""
        return self.raw("part").select(
            F.col("p_partkey").alias("item_id"), F.col("p_name").alias("item_name"),
            F.col("p_type").alias("category"), money("p_retailprice").alias("price"))

    def users(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"),
            F.col("c_mktsegment").alias("user_tier"))

    def instruments(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("symbol"), F.col("p_name").alias("instrument_name"),
            F.col("p_type").alias("instrument_category"),
            money("p_retailprice").alias("list_price"))

    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
            F.col("p_type").alias("category"), money("p_retailprice").alias("price"),
            F.col("p_size").alias("stock_quantity"))

    # ---- trades ------------------------------------------------------------------------------

    def trades(self) -> DataFrame:
        """``trade_value`` is the traded amount, ``price`` the list price of the instrument."""
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("trade_id"), F.col("l_linenumber").alias("line"),
            F.col("l_partkey").alias("symbol"),
            F.col("l_quantity").cast("int").alias("volume"),
            money("l_extendedprice").alias("trade_value"),
            F.col("l_returnflag").alias("side"), F.col("l_linestatus").alias("exchange"),
            F.col("l_suppkey").alias("trader_id"), F.col("l_shipdate").alias("ts"))

    def returns(self) -> DataFrame:
        return self.raw("lineitem").filter(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
            money("l_extendedprice").alias("refund_amount"), F.col("l_shipdate").alias("ts"))

    # ---- events ------------------------------------------------------------------------------

    def events(self) -> DataFrame:
        return self.raw("events").withColumn("value", money("value"))

    def change_log(self) -> DataFrame:
        """Events read as a change log: op I, U or D per user, in (ts, event_id) order."""
        op = (F.when(F.col("event_type") == "signup", "I")
              .when(F.col("event_type") == "error", "D").otherwise("U"))
        return self.events().withColumn("op", op)

    def versions(self) -> DataFrame:
        """Events as an append-only versioned table; v is the day number since 2024-01-01."""
        v = F.datediff(F.col("ts"), F.lit("2024-01-01").cast("date"))
        return self.events().withColumn("v", v.cast("int"))

    def op_results(self) -> DataFrame:
        """Events read as timed operations of a benchmark: target, mode, run, op, time, size."""
        kind = F.col("event_type")
        return self.raw("events").select(
            F.concat(F.lit("target_"), F.col("user_id") % 3).alias("target"),
            F.when(F.col("user_id") % 2 == 0, "mixed").otherwise("large").alias("mode"),
            F.dayofmonth("ts").alias("run_id"),
            F.when(kind.isin("purchase", "signup"), "write").otherwise("read").alias("op"),
            (kind != "error").alias("success"),
            F.col("value").alias("time_sec"),
            (F.get_json_object("props", "$.k").cast("int")).alias("size_mb"),
            F.col("event_id"), F.col("ts"))

    # ---- orders as work items and as an archive ------------------------------------------------

    def transactions(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("ts"), money("o_totalprice").alias("amount"),
            (F.col("o_orderstatus") == "F").alias("processed"))

    def emp(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("person_id"),
            F.col("o_orderdate").alias("time"), F.col("o_orderpriority").alias("department"),
            money("o_totalprice").alias("salary"))

    # ---- SQL -----------------------------------------------------------------------------------

    VIEWS = ("orders_raw", "orders_clean", "items", "users", "instruments", "products", "trades",
             "returns", "events", "change_log", "versions", "op_results", "transactions", "emp")

    def register(self, prefix: str = "") -> None:
        """Make the views available to ``spark.sql``."""
        for name in self.VIEWS:
            getattr(self, name)().createOrReplaceTempView(prefix + name)
