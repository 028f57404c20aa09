"""The registered queries of the operators, and SQL for those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, tune
from . import (
    context_mixing, decontaminate, fixity, mixing, near_duplicates, quality, spelling, suffix_runs,
    token_counts, token_files, toxicity, whitening, wrappers,
)
from .common import table
from .sql import ORACLES


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


def damaged(page_id: Column, record: Column) -> Column:
    """What the second replica holds: of 97 pages in turn, one has changed bytes and one is lost."""
    turn = F.pmod(page_id * 7919, F.lit(97))
    return F.when(turn == 1, F.reverse(record)).when(
        turn == 2, F.lit(None).cast("binary")).otherwise(record)


def op1_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return fixity.audit(fixity.page_records(pages), fixity.page_records(pages, damaged))


def op2_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extracted(table(spark, sf_dir, "pages"))


def op3_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(decontaminate.occurrences(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op4_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(
        table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op6_nearest_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    examples = toxicity.examples_of(docs, table(spark, sf_dir, "labels"), ~held_out(3, 1))
    return toxicity.scored(docs, examples).select(
        "doc_id", held_out(3, 1).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "neighbours")


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", F.col("n_rows").alias("class_rows"))


def op8_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = mixing.sizes_of(table(spark, sf_dir, "documents"))
    return mixing.mixed(sizes).select(
        "doc_id", "size", "source_size", "target", "taken")


def op9_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.scored(
        table(spark, sf_dir, "documents"), ~held_out(7, 2)).withColumn(
        "held_out", held_out(7, 2)).drop("n_bytes")


def op10_orc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "token-files")
    token_files.write_ids(table(spark, sf_dir, "documents"), out,
                          tokenizer_path("byte_bpe_50k.json"))
    return token_files.digests(token_files.read_ids(spark, out))


def op11_suffix_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_runs.deduplicated(table(spark, sf_dir, "documents"))


def op12_qd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_bloom_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def tuned(query: Callable) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tune(spark), sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_merkle_audit, op2_wrapper_text, op3_fm_index, op4_piece_counts, op5_host_rules,
        op6_nearest_examples, op7_order_minhash, op8_source_schedule, op9_context_mixing,
        op10_orc_ids, op11_suffix_runs, op12_qd_whitening, op13_bloom_variants,
        pipeline,
    ]
    return {q.__name__: tuned(q) for q in found}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    return ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
