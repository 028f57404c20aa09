"""From documents to token files: quality rules, near-duplicates, benchmark passages, mixing, ids.

A stage's result is written before the next stage is called; `run` then deletes the intermediate tables
that the stage made, and no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, near_duplicates, quality, token_files
from tidemark.llm.common import Scratch, stored, table
from tidemark.llm.queries import tokenizer_path
from tidemark.session import shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose source is not rejected."""
    return quality.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return near_duplicates.one_of_each(docs, in_files=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; the words of benchmark passages are cut out of the texts."""
    return decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix by source weights takes them."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes ids as ORC files and gives doc_id, start, n_tokens, ids_crc32 read back from them."""
    out = shared_dir(spark, "token-files")
    token_files.write_ids(docs, out, tokenizer_path("byte_bpe_50k.json"))
    return token_files.digests(token_files.read_ids(spark, out))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

#: sketches, alignment and the tokenizer have no SQL; the tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are stored and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with Scratch(spark) as made:
            docs = stored(stage(spark, docs, sf_dir), name, temporary=False)
        made.clear()
    return STAGES[-1][1](spark, docs, sf_dir)
