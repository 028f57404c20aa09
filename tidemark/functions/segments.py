"""Ordered per-key calculations that never put a whole key into one task.

``lag``, ``row_number`` or a running sum over ``partitionBy(key)`` sort every row of a key in one
task. When one key holds a third of the table that task is the job. Here the rows of a hot key are
cut into *cells* along the order and the window runs per (key, cell). What a cell must know about the
cells before it fits in one row, which is worked out over rows per cell, not over the rows themselves:

* a lag is missing only in the first row of a cell, so first and last rows are matched up apart;
* running sums and fills get a *carry* row per cell that sorts first and is dropped afterwards.

The rows are shuffled once. Where the cells lie is taken from the data (``cut``): a sample of the hot
key's rows, chosen by hash at a rate that aims at ``STEP`` rows a cell, is sorted, and every
``STEP``-th row is a bound. Bounds are whole order tuples, so rows that share an instant are cut as
well as any others, and cells hold about as many rows each whatever the values are. All hot keys
together have at most ``2 * HOT_PARTS`` cells at any size of the table, so the bounds can be
broadcast and the edges of all cells of a key fit in one window.

A caller that knows cells already (a file block, a range of ids) can give them: any expression that
never decreases along the order. Then every key is cut, and there must be few cells per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CELL, _ROW, _W = "_cell", "_row", "_weight"

#: a key is cut into cells if it has more rows than this, and more than one part in so many of all
HOT_ROWS = 1_000_000
HOT_PARTS = 20_000
#: sampled rows per cell; branches of the search for a row's cell
STEP, FAN = 32, 32


def _cells(df: DataFrame, keys: list[str], order: list[str], cell: Column | None,
           hot_rows: int) -> DataFrame:
    marked = cut(df, keys, order, hot_rows) if cell is None else df.withColumn(_CELL, cell)
    return marked.withColumn(_ROW, F.lit(1))


def _cut_rows(rows: DataFrame, cell: Column | None) -> DataFrame:
    """The rows that may need a carry: a key that is not cut has nothing before its cell."""
    return rows if cell is not None else rows.filter(F.col(_CELL).isNotNull())


def _with_carry(rows: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    both = rows.unionByName(carry.withColumn(_ROW, F.lit(0)), allowMissingColumns=True)
    # Explicit, because input that is already hashed by the key alone would satisfy the window too,
    # and would put all cells of a key back into one task.
    return both.repartition(*keys, _CELL)


def _cell_window(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys, _CELL).orderBy(_ROW, *order)


def time_cell(ts: str | Column, grain: str = "day", tie: Column | None = None) -> Column:
    """Cells of one grain of time, for rows ordered by time and then by what ``tie`` is made of.

    Coarse clocks put many rows of a key on one instant. With ``tie``, a column that never decreases
    along the rest of the order, the rows that stand exactly on the start of a grain are cut further
    by it; the later rows of the grain form one more cell.
    """
    t = F.col(ts) if isinstance(ts, str) else ts
    start = F.date_trunc(grain, t).cast("timestamp_ntz")
    if tie is None:
        return start
    later = t != start
    return F.struct(start.alias("start"), later.alias("later"), F.when(~later, tie).alias("tie"))


def _hot_keys(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """Keys with more rows than ``hot_rows`` and than one part in HOT_PARTS of the table, and how many
    cells that are not larger they make. Counting reads the key columns only and combines on the map
    side."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    least = counts.agg(F.greatest(F.lit(float(hot_rows)), F.sum("_n") / HOT_PARTS).alias("_least"))
    hot = counts.withColumn("_least", least.scalar()).filter(F.col("_n") > F.col("_least"))
    return hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.col("_n").alias("_hot"),
                      F.ceil(F.col("_n") / F.col("_least")).alias("_hot_cells"))


def _same(keys: list[str]) -> list[Column]:
    return [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]


def hot_cells(df: DataFrame, keys: list[str], cell: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds the cell column: ``cell`` for hot keys, one cell (NULL) for all others."""
    marked = df.join(F.broadcast(_hot_keys(df, keys, hot_rows)), _same(keys), "left")
    return marked.withColumn(_CELL, F.when(F.col("_hot").isNotNull(), cell)).drop(
        "_hot", "_hot_cells", *[f"_hot_{k}" for k in keys])


def _at_or_below(bounds: Column, row: Column) -> Column:
    return F.size(F.filter(bounds, lambda b: b <= row))


def cut(df: DataFrame, keys: list[str], order: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds the cell column: a number that rises along ``order`` for rows of hot keys, else NULL.

    The cells of a key hold about equally many rows. ``order`` should be a total order inside a key;
    rows equal in all of it stay together.
    """
    names = [f"_hot_{k}" for k in keys]
    hot = _hot_keys(df, keys, hot_rows)
    row = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)])
    # a number in [0, 1) from the row itself: a repeated task samples the same rows
    chance = F.shiftrightunsigned(F.xxhash64(*keys, *order), 11) / F.lit(float(1 << 53))
    sample = (df.select(*dict.fromkeys([*keys, *order])).join(F.broadcast(hot), _same(keys))
              .filter(chance * F.col("_hot") < F.col("_hot_cells") * STEP)
              .select(*names, row.alias("_bound")))
    nth = F.row_number().over(Window.partitionBy(*names).orderBy("_bound"))
    bounds = sample.withColumn("_nth", nth).filter(F.col("_nth") % STEP == 0).groupBy(*names).agg(
        F.sort_array(F.collect_list("_bound")).alias("_bounds"))

    def every(n):  # the first of each n bounds
        return F.transform(F.sequence(F.lit(0), F.floor((F.size("_bounds") - 1) / n)),
                           lambda i: F.element_at("_bounds", (i * n + 1).cast("int")))

    bounds = bounds.withColumns({"_coarse": every(FAN * FAN), "_middle": every(FAN)})
    marked = df.join(F.broadcast(bounds), _same(keys), "left")
    # a search in three steps: the block of bounds, the smaller block, the bound
    one = F.when(F.col("_bounds").isNotNull(), _at_or_below(F.col("_coarse"), row))
    marked = marked.withColumn("_at", one)
    two = _at_or_below(F.slice("_middle", (F.col("_at") - 1) * FAN + 1, F.lit(FAN)), row)
    marked = marked.withColumn("_at", F.when(F.col("_at") > 0, (F.col("_at") - 1) * FAN + two)
                               .otherwise(F.col("_at")))
    three = _at_or_below(F.slice("_bounds", (F.col("_at") - 1) * FAN + 1, F.lit(FAN)), row)
    marked = marked.withColumn(_CELL, F.when(F.col("_at") > 0, (F.col("_at") - 1) * FAN + three)
                               .otherwise(F.col("_at")))
    return marked.drop("_at", "_bounds", "_coarse", "_middle", *names)


def lag_in_key(df: DataFrame, keys: list[str], order: list[str], cell: Column | None,
               value: str, out: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Value of the previous row of the key; ``order`` must be a total order inside a key.

    Without ``cell`` hot keys are cut where the data says. Without ``hot_rows`` every key is cut by
    ``cell``, for inputs that are dear to read twice.
    """
    if hot_rows is None:
        marked = df.withColumn(_CELL, cell)
    else:
        marked = cut(df, keys, order, hot_rows) if cell is None else hot_cells(
            df, keys, cell, hot_rows)
    # both uses below read the same shuffle
    rows = marked.repartition(*keys, _CELL)
    in_cell = Window.partitionBy(*keys, _CELL).orderBy(*order)
    rows = rows.withColumns({
        out: F.lag(value).over(in_cell), "_nth": F.row_number().over(in_cell),
        "_last": F.lead(F.lit(1)).over(in_cell).isNull()})
    # a key that is not cut has no cell before it
    first = F.col("_nth") == 1
    if hot_rows is not None:
        first &= F.col(_CELL).isNotNull()
    inner = rows.filter(~first)
    edge = first | F.col("_last")
    edges = rows.filter(edge if hot_rows is None else edge & F.col(_CELL).isNotNull())
    of_key = Window.partitionBy(*keys).orderBy(_CELL, "_nth")
    starts = edges.withColumn(out, F.lag(value).over(of_key)).filter(first)
    return inner.unionByName(starts).drop(_CELL, "_nth", "_last")


def fill_forward(df: DataFrame, keys: list[str], order: list[str], cell: Column | None,
                 columns: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Replace each of ``columns`` by its last non-null value at or before the row."""
    rows = _cells(df, keys, order, cell, hot_rows)
    last = _cut_rows(rows, cell).groupBy(*keys, _CELL).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in columns])
    before = Window.partitionBy(*keys).orderBy(_CELL).rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*keys, _CELL, *[
        F.last(c, ignorenulls=True).over(before).alias(c) for c in columns])
    here = _cell_window(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = _with_carry(rows, carry, keys)
    return (filled.withColumns({c: F.last(c, ignorenulls=True).over(here) for c in columns})
            .filter(F.col(_ROW) == 1).drop(_CELL, _ROW))


def running_total(df: DataFrame, keys: list[str], order: list[str], cell: Column | None,
                  weight: Column, out: str, total: str | None = None,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inclusive running sum of ``weight`` inside a key, and on request the sum of the whole key.

    With weight 1 the running sum is the row number and the total is the row count.
    """
    rows = _cells(df, keys, order, cell, hot_rows).withColumn(_W, weight)
    sums = _cut_rows(rows, cell).groupBy(*keys, _CELL).agg(F.sum(_W).alias(_W))
    type_ = sums.schema[_W].dataType
    rows = rows.withColumn(_W, F.col(_W).cast(type_))
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy(_CELL).rowsBetween(Window.unboundedPreceding, -1)
    # the first cell of a key starts from nothing; a key of one cell needs no carry row at all
    needed = F.col("_many") if total else F.col("_many") & F.col(_W).isNotNull()
    carry = sums.select(
        *keys, _CELL, F.sum(_W).over(before).cast(type_).alias(_W),
        F.sum(_W).over(by_key).cast(type_).alias("_total"),
        (F.count("*").over(by_key) > 1).alias("_many")).filter(needed).drop("_many")
    carry = carry.withColumn(_W, F.coalesce(_W, F.lit(0)).cast(type_))
    if not total:
        carry = carry.drop("_total")
    w = _cell_window(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = _with_carry(rows, carry, keys).withColumn(out, F.sum(_W).over(w).cast(type_))
    if total:
        own = F.sum(F.when(F.col(_ROW) == 1, F.col(_W))).over(Window.partitionBy(*keys, _CELL))
        # the carry row sorts first, so it is in every frame
        done = done.withColumn(total, F.coalesce(F.first("_total").over(w), own.cast(type_)))
        done = done.drop("_total")
    return done.filter(F.col(_ROW) == 1).drop(_CELL, _ROW, _W)
