"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

The mix is a sequence of 2^k slots of equally many words. Slot n has the van der Corput point
bits_reversed(n) / 2^k; cumulative target weights cut the points into one interval per source, so
any run of slots holds the sources nearly in proportion and a whole period gives every source its
share of slots to within one at either end. The r-th slot of a source takes the r-th block of the
source's documents, which lie one after another in a shuffled order, twice (a document is taken at
most two times).

Defined results: null and empty texts have size 0 and are never taken; a null source is a source of
its own and the last one; repeated rows are mixed row by row; tables without words have targets
and taken words of 0; an empty table gives no rows; other columns stay with their rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, stored

WORD = "[^\\x20\\x09-\\x0D]+"
SEED = "mix"
#: weights of the sources in code point order, repeating
WEIGHTS = (5, 2, 1)
#: words of the mix as a share of all words, as numerator and denominator
SHARE = (3, 2)
#: most times that a source or document is taken
PASSES = 2
#: a block has more than half as many words and at most so many
BLOCK_WORDS = 64
#: rows of the shuffled order, and slots, that one window sorts
CELL = 65_536


def size_of(text: str | Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(t, F.lit("")), F.lit(WORD)).cast("long")


def by_key(df: DataFrame) -> DataFrame:
    """A side that grows with the data: it is shuffled by the key of the join, never broadcast."""
    return df.hint("merge")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            share: tuple[int, int] = SHARE, passes: int = PASSES) -> DataFrame:
    """source, source_no, source_size, target: words shared by weight, none above passes * size.

    A source's share is level * weight where that is below its limit. With sources in the order of
    limit / weight, the level is (words - limits so far) / (weights from here on) at the first
    source that this level does not fill. The windows run over one row per source.
    """
    whole, by_name = Window.partitionBy(), Window.orderBy(F.col("source").isNull(), "source")
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    per = per.withColumn("source_no", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.get(F.array(*[F.lit(w) for w in weights]),
                        F.col("source_no") % len(weights)).cast("long")).withColumn(
        "limit", passes * F.col("source_size"))
    rising = Window.orderBy(F.col("limit") / F.col("weight"), "source_no")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn(
        "num", share[0] * F.sum("source_size").over(whole)
        - share[1] * F.coalesce(F.sum("limit").over(before), F.lit(0))).withColumn(
        "den", share[1] * (F.sum("weight").over(whole)
                           - F.coalesce(F.sum("weight").over(before), F.lit(0)))).withColumn(
        "at", F.row_number().over(rising))
    is_open = F.col("num") * F.col("weight") <= F.col("limit") * F.col("den")
    level = F.min(F.when(is_open, F.struct("at", "num", "den"))).over(whole)
    shared = F.col("level.num").cast("double") * F.col("weight") / F.col("level.den")
    return per.withColumn("level", level).select("source", "source_no", "source_size", F.least(
        F.col("limit").cast("double"), shared).alias("target"))


def slots(goals: DataFrame, bits: int) -> DataFrame:
    """source_no, slot, rank: every slot of the schedule of 2^bits slots with its source.

    goals: source_no, first, past: the source's interval of points. A source's slots are the
    reversed bits of its points. They are ranked in two steps, by counts per run of slots and
    inside a run, so the largest source is spread over many tasks.
    """
    tasks = int(goals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = goals.filter("past > first").select("source_no", "first", "past", F.explode(F.expr(
        f"sequence(first div {CELL}, (past - 1) div {CELL})")).alias("cell"))
    points = cells.repartition(tasks, "source_no", "cell").select("source_no", F.explode(F.expr(
        f"sequence(greatest(first, cell * {CELL}), least(past, (cell + 1) * {CELL}) - 1)")
    ).alias("point"))
    reverse = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long")
    rows = points.select("source_no", reverse.alias("slot")).withColumn(
        "run", F.expr(f"slot div {CELL}"))
    runs = rows.groupBy("source_no", "run").agg(F.count("*").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.partitionBy("source_no").orderBy(
            "run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("source_no", "run").orderBy("slot")) - 1
    return by_key(rows.withColumn("inside", inside)).join(
        by_key(runs.drop("n")), ["source_no", "run"]).select(
        "source_no", "slot", (F.col("before") + F.col("inside")).alias("rank"))


def shuffled(sizes: DataFrame, seed: str, rows: int) -> DataFrame:
    """Adds `start`: words of the source that lie before the row in the shuffled order.

    The order is that of md5(seed:doc_id). Sums per leading digits of the hash give each cell its
    start; a window only sorts one cell, whose size does not grow with the source.
    """
    digits = max(1, math.ceil(math.log(max(1, 2 * rows / CELL), 16)))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(
        F.col("doc_id").cast("string"), F.concat(F.lit("row "), F.col("row_id").cast("string")))))
    keyed = sizes.withColumn("key", key).withColumn("cell", F.substring("key", 1, digits))
    cells = keyed.groupBy("source_no", "cell").agg(F.sum("size").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.partitionBy("source_no").orderBy(
            "cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inside = F.coalesce(F.sum("size").over(Window.partitionBy("source_no", "cell").orderBy(
        "key", "row_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return by_key(keyed.withColumn("inside", inside)).join(
        by_key(cells), ["source_no", "cell"]).withColumn(
        "start", F.col("before") + F.col("inside")).drop("key", "cell", "before", "inside")


def mixed(sizes: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS,
          share: tuple[int, int] = SHARE, passes: int = PASSES,
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """row_id, doc_id, source, size, source_size, target, taken for every row.

    sizes: stored rows of row_id, doc_id, source, size.
    """
    goals = targets(sizes, weights, share, passes)
    summed = stored(goals, "mix-targets")
    total = summed.agg(F.sum("target").alias("words"), F.sum("source_size").alias("n")).first()
    words = total["n"] * share[0] / share[1] if total["n"] else 0.0
    named = sizes.join(summed, sizes["source"].eqNullSafe(summed["source"])).drop(summed["source"])
    if not words:
        return named.drop("source_no").withColumn("taken", F.lit(0).cast("long"))
    bits = max(1, math.ceil(math.log2(words / block_words)))
    block = words / 2**bits
    ends = F.sum("target").over(Window.orderBy("source_no")) / words
    goal = summed.select("source_no", "target", F.round(ends * 2**bits).cast("long").alias("past"))
    goal = goal.withColumn("first", F.coalesce(
        F.lag("past").over(Window.orderBy("source_no")), F.lit(0)))
    placed = shuffled(named.select("row_id", "doc_id", "source_no", "source_size", "size").filter(
        "size > 0"), seed, sizes.count())
    # the blocks that a document lies in, in each pass over its source; the first and last guess are
    # one wide, since division rounds
    spans = placed.withColumn("pass", F.explode(F.array(*[F.lit(p) for p in range(passes)]))
                              ).select("row_id", "source_no", "size", (
        F.col("start") + F.col("pass") * F.col("source_size")).alias("start"))
    edge = lambda j: F.floor(j * F.lit(block)).cast("long")
    j = F.col("rank")
    overlap = F.least(F.col("start") + F.col("size"), edge(j + 1)) - F.greatest(
        F.col("start"), edge(j))
    blocks = spans.withColumn("rank", F.explode(F.sequence(
        F.greatest(F.lit(0).cast("long"), F.floor(F.col("start") / block) - 1),
        F.floor((F.col("start") + F.col("size")) / block) + 1))).withColumn(
        "words", overlap).filter("words > 0").select("row_id", "source_no", "rank", "words")
    taken = by_key(blocks).join(by_key(slots(goal, bits)), ["source_no", "rank"]).groupBy("row_id").agg(
        F.sum("words").cast("long").alias("taken"))
    return by_key(named).join(by_key(taken), "row_id", "left").drop("source_no").withColumn(
        "taken", F.coalesce("taken", F.lit(0).cast("long")))


def sizes_of(docs: DataFrame, id: str = "doc_id", source: str = "source",
             text: str = "text") -> DataFrame:
    """Stored row_id, doc_id, source, size of every row."""
    return stored(numbered(docs.select(
        F.col(id).alias("doc_id"), F.col(source).alias("source"), size_of(text).alias("size"))),
        "mix-sizes")


def mixed_documents(docs: DataFrame, id: str = "doc_id", source: str = "source",
                    text: str = "text") -> DataFrame:
    """The mix as rows of `docs`, all columns: each as often as the mix takes it.

    Blocks cut the first and last document of a source's share; such a document counts if at least
    half of it is taken.
    """
    rows = stored(numbered(docs.select(
        F.struct("*").alias("row"), size_of(text).alias("size"))), "mix-documents")
    sizes = rows.select("row_id", F.col(f"row.{id}").alias("doc_id"),
                        F.col(f"row.{source}").alias("source"), "size")
    times = mixed(sizes).filter("taken > 0").select("row_id", F.round(
        F.col("taken") / F.col("size")).cast("int").alias("times")).filter("times > 0")
    return by_key(rows).join(by_key(times), "row_id").select("row", F.explode(
        F.array_repeat(F.lit(0), F.col("times")))).select("row.*")
