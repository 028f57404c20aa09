"""Shared pieces of the check SQL."""

from __future__ import annotations

_VIEWS = {
    "line_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS item_id,
               CAST(l_quantity AS INTEGER) AS qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
               CAST(l_discount * 100 AS DECIMAL(18,2)) AS discount_pct, l_shipdate AS ts
        FROM lineitem""",
    "line_clean": """
        SELECT DISTINCT ON (order_id, line) * FROM line_items
        ORDER BY order_id, line, ts DESC, item_id DESC, qty DESC, amount DESC, discount_pct DESC""",
    "orders_raw": """
        SELECT l.*, o.o_custkey AS user_id, CAST(p.p_retailprice AS DECIMAL(18,2)) AS price
        FROM line_items l LEFT JOIN orders o ON l.order_id = o.o_orderkey
        LEFT JOIN part p ON l.item_id = p.p_partkey""",
    "orders_clean": """
        SELECT l.*, o.o_custkey AS user_id, CAST(p.p_retailprice AS DECIMAL(18,2)) AS price
        FROM line_clean l LEFT JOIN orders o ON l.order_id = o.o_orderkey
        LEFT JOIN part p ON l.item_id = p.p_partkey""",
    "items": "SELECT p_partkey AS item_id, p_name AS item_name, p_type AS category FROM part",
    "users": """SELECT c_custkey AS user_id, c_name AS user_name, c_mktsegment AS user_tier
        FROM customer""",
    "trades": """
        SELECT l_orderkey AS trade_id, l_linenumber AS line, l_partkey AS symbol,
               CAST(l_quantity AS INTEGER) AS volume,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS trade_value, l_returnflag AS side,
               l_linestatus AS exchange, l_suppkey AS trader_id, l_shipdate AS ts
        FROM lineitem""",
    "instruments": """
        SELECT p_partkey AS symbol, p_name AS instrument_name, p_type AS instrument_category,
               CAST(p_retailprice AS DECIMAL(18,2)) AS list_price FROM part""",
    "returns": """
        SELECT l_orderkey AS order_id, l_linenumber AS line,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS refund_amount, l_shipdate AS ts
        FROM lineitem WHERE l_returnflag = 'R'""",
    "products": """
        SELECT p_partkey AS id, p_name AS name, p_type AS category,
               CAST(p_retailprice AS DECIMAL(18,2)) AS price, p_size AS stock_quantity FROM part""",
    "ev": """
        SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value, props
        FROM events""",
    "change_log": """
        SELECT *, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op
        FROM ev""",
    "state": """
        SELECT user_id, ts, event_id, event_type, value FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
            FROM change_log) WHERE rn = 1 AND op <> 'D'""",
    "versions": """
        SELECT *, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS v
        FROM ev""",
    "op_results": """
        SELECT 'target_' || (user_id % 3) AS target,
               CASE WHEN user_id % 2 = 0 THEN 'mixed' ELSE 'large' END AS mode,
               CAST(day(ts) AS INTEGER) AS run_id,
               CASE WHEN event_type IN ('purchase', 'signup') THEN 'write' ELSE 'read' END AS op,
               event_type <> 'error' AS success, value AS time_sec,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS size_mb, event_id, ts
        FROM events""",
    "transactions": """
        SELECT o_orderkey AS id, o_custkey AS user_id, o_orderdate AS ts,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderstatus = 'F' AS processed
        FROM orders""",
    "emp": """
        SELECT o_orderkey AS id, o_custkey AS person_id, o_orderdate AS time,
               o_orderpriority AS department, CAST(o_totalprice AS DECIMAL(18,2)) AS salary
        FROM orders""",
}

_NEEDS = {
    "line_clean": ["line_items"], "orders_raw": ["line_items"], "orders_clean": ["line_clean"],
    "change_log": ["ev"], "state": ["change_log"], "versions": ["ev"],
}


def with_views(names: str, body: str, **ctes: str) -> str:
    """A query over the named views (space separated) and further CTEs."""
    order: list[str] = []

    def need(name: str) -> None:
        for n in _NEEDS.get(name, []):
            need(n)
        if name not in order:
            order.append(name)

    for name in names.split():
        need(name)
    parts = [f"{n} AS ({_VIEWS[n].strip()})" for n in order]
    parts += [f"{n} AS ({s.strip()})" for n, s in ctes.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def avg4(expr: str, digits: int = 4, scale: int = 2, over: str = "", where: str = "") -> str:
    """Mean of a non-negative value with ``scale`` decimals, rounded half up, in whole numbers.

    A mean can lie exactly between two roundings, where doubles fall to either side.
    """
    tail = (f" FILTER (WHERE {where})" if where else "") + (f" OVER {over}" if over else "")
    units = f"CAST(round(CAST({expr} AS DECIMAL(28,9)) * {10 ** scale}) AS HUGEINT)"
    num = f"SUM({units}){tail} * {10 ** max(0, digits - scale)}"
    den = f"COUNT({expr}){tail} * {10 ** max(0, scale - digits)}"
    return f"(((2 * {num} + {den}) // nullif(2 * {den}, 0)) / {10.0 ** digits})"
