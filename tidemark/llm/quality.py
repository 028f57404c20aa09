"""Quality rules with a verdict per host (DataFrame functions only).

Every text gets the counts of the base rules. Rule failures are summed per domain, the rate of each
domain is shrunk with a beta prior fitted to all domains, and the verdict on the domain is joined
back to its documents.

Defined results: a null or empty text has no words and fails the base rules; a null domain is a
domain of its own; repeated rows count as often as they occur; an empty table gives no rows; other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
#: most repeated words, in percent
MAX_REPEATED = 30
#: a host is rejected when its shrunk failure rate is above this
MAX_HOST_RATE = 0.5


def word_array(text: str | Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text in order; none for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def repeated_windows(words: DataFrame, words_column: str, out: str) -> DataFrame:
    """Words that lie in a window of eight words found twice or more in the same text.

    Windows are compared by a 64-bit hash. Texts without a repeated window, nearly all, stop after
    the hash set; the others sort (hash, place) and add up the places covered, so the work per
    text is n log n however repetitive it is.
    """
    hashed = words.withColumn("_h", F.transform(words_column, lambda w: F.xxhash64(w)))
    windows = hashed.withColumn("_w", F.when(
        F.size("_h") < WINDOW, F.array().cast("array<bigint>")).otherwise(F.transform(
            F.sequence(F.lit(0), F.size("_h") - WINDOW),
            lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(WINDOW)]))))
    repeats = F.size(F.array_distinct("_w")) < F.size("_w")
    ordered = windows.withColumn("_s", F.when(repeats, F.array_sort(F.transform(
        "_w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def found_again(x, k):
        beside = [F.get("_s", k + d)["h"] == x["h"] for d in (-1, 1)]
        return F.coalesce(beside[0], F.lit(False)) | F.coalesce(beside[1], F.lit(False))

    places = ordered.withColumn("_p", F.array_sort(
        F.transform(F.filter("_s", found_again), lambda x: x["i"])))
    covered = F.aggregate(
        "_p", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"),
                              (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")),
        lambda a: a["n"])
    return places.withColumn(out, F.coalesce(covered, F.lit(0)).cast("long")).drop(
        "_h", "_w", "_s", "_p")


def rule_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input's columns with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long)
    and base_failed."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    counted = docs.withColumn("_words", word_array(text)).withColumn("_lines", lines)
    counted = counted.withColumn("n_words", F.size("_words").cast("long")).withColumn(
        "word_chars", F.length(F.array_join("_words", "")).cast("long")).withColumn(
        "n_symbols", (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long")
    ).withColumn(
        "n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    counted = repeated_windows(counted, "_words", "n_repeat_words").drop("_words", "_lines")
    return counted.withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))


def host_rates(counts: DataFrame, host: str) -> DataFrame:
    """One row per host: documents, failures, and the failure rate shrunk by the beta prior.

    The prior's mean m and weight k come from all hosts by the method of moments: with rates p of n
    documents, k = m(1-m)/v - 1 for the variance v of the rates, at least 1. A host with few
    documents is pulled to m, one with many keeps its own rate. If all hosts agree (v = 0), every
    host gets m.
    """
    hosts = counts.groupBy(host).agg(
        F.count("*").alias("docs"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    prior = hosts.agg((F.sum("failed") / F.sum("docs")).alias("m"),
                      F.var_pop(F.col("failed") / F.col("docs")).alias("v")).first()
    if not prior["v"]:
        return hosts.withColumn("rate", F.lit(prior["m"]).cast("double"))
    m = prior["m"]
    k = max(1.0, m * (1 - m) / prior["v"] - 1)
    return hosts.withColumn("rate", (F.col("failed") + m * k) / (F.col("docs") + k))


def judged(docs: DataFrame, host: str = "source", text: str = "text", id: str = "doc_id",
           max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """id, host, the counts, base_failed, host_rate and kept for every row of `docs`.

    The counts are narrow and stored once; they feed the sums per host and the final join. Failures
    are summed before the shuffle, so a host with a third of all rows sends one row per task.
    """
    counts = stored(rule_counts(docs.select(
        F.col(id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"))).drop(
        "text"), "quality-counts")
    rates = host_rates(counts, "host").select(
        F.col("host").alias("_host"), F.col("rate").alias("host_rate"))
    return counts.join(rates, F.col("host").eqNullSafe(F.col("_host"))).drop("_host").withColumn(
        "kept", ~F.col("base_failed") & (F.col("host_rate") <= max_host_rate))


def kept_documents(docs: DataFrame, host: str = "source", text: str = "text",
                   max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of `docs` that the rules and their host's verdict keep, all columns."""
    counted = rule_counts(docs.select(
        F.struct("*").alias("row"), F.col(host).alias("host"), F.col(text).alias("text")))
    counted = stored(counted.select("row", "host", "base_failed"), "quality-documents")
    bad = host_rates(counted, "host").filter(F.col("rate") > max_host_rate).select(
        F.col("host").alias("_host"))
    return counted.filter(~F.col("base_failed")).join(
        bad, F.col("host").eqNullSafe(F.col("_host")), "left_anti").select("row.*")
