"""Token counts without token ids: each distinct pre-token is counted once.

A piece of the model never has a word separator behind another character, nor a line break, so a
text may be cut before each run of separators and around line breaks, and the number of tokens is the
sum over these pre-tokens. Distinct pre-tokens of the whole corpus are counted once each by the
library, joined to the per-document frequencies and summed. The model is asked whether that holds;
for one where it does not, every text is a single pre-token, which is right but slower.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows and null ids are rows
of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_in
from .frequencies import CHUNK_BYTES, CHUNK_ROWS

#: buckets of words per shuffle partition
BUCKETS = 8
SEPARATOR = "▁"
PIECE = re.compile("\n| +[^ \n]*|[^ \n]+")
#: characters that Unicode normalisation, lower-casing or stripping would change
PROBE = "Aﬁ①Å½ｶ 　é​\x07  b \t"


@cache
def model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@cache
def can_cut(path: str) -> bool:
    """Whether counts add up over pre-tokens of this model."""
    m = model(path)
    pieces = (m.id_to_piece(i) for i in range(m.get_piece_size())
              if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i)))
    return m.normalize(PROBE) == SEPARATOR + PROBE.replace(" ", SEPARATOR) and not any(
        SEPARATOR in p.lstrip(SEPARATOR) or "\n" in p for p in pieces)


def pre_tokens(text: str | None, path: str) -> list[bytes]:
    """The text's pre-tokens; one that starts a text has the space that the model puts there. The
    separator sign itself is a space to the model."""
    if not text:
        return []
    if not can_cut(path):
        return [text.encode()]
    return [p.encode() for p in PIECE.findall(" " + text.replace(SEPARATOR, " "))]


def count_tokens(words: list[bytes], path: str) -> list[int]:
    """Tokens of each pre-token. The library starts each input with a space of its own; a line break
    keeps it apart from a pre-token that has none, and costs one token itself."""
    m, texts = model(path), [w.decode() for w in words]
    if not can_cut(path):
        return [len(x) for x in m.encode(texts, num_threads=1)]
    lengths = m.encode([t[1:] + "\n" if t[0] == " " else "\n" + t for t in texts], num_threads=1)
    return [len(x) - (1 if t[0] == " " else 2) for x, t in zip(lengths, texts)]


def packed_rows(batches: Iterator[pa.RecordBatch], path: str, buckets: int
                ) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> a row per chunk and bucket of words with the words, the documents they stand
    in and how often, compressed; and a row per chunk with the ids and sizes of its documents.

    A word that a quarter of a chunk's documents have goes to a bucket that also depends on the
    chunk, so frequent words are spread (and counted once in each of those).
    """
    first = TaskContext.get().partitionId() << 33
    for number, rows in enumerate(rows_in(batches, CHUNK_ROWS, CHUNK_BYTES)):
        chunk = first + number
        names: dict[bytes, int] = defaultdict()
        names.default_factory = names.__len__
        texts = rows["text"].to_pylist()
        coded = [np.fromiter(map(names.__getitem__, pre_tokens(t, path)), np.int64) for t in texts]
        totals = np.array([len(c) for c in coded])
        pair, count = np.unique((np.concatenate(coded) << 16) | np.repeat(
            np.arange(len(texts)), totals), return_counts=True)
        documents = np.bincount(pair >> 16, minlength=len(names))
        crc = np.fromiter(map(zlib.crc32, names), np.int64, len(names))
        bucket = np.where(4 * documents > len(texts), crc + chunk, crc) % buckets
        order = np.argsort(bucket, kind="stable")
        place_of = np.empty(len(names), np.int64)
        place_of[order] = np.arange(len(names))
        by = np.argsort(place_of[pair >> 16], kind="stable")
        words, places = list(names), (pair[by] & 0xFFFF).astype("<u2")
        count, documents = count[by].astype("<u4"), documents[order].astype("<u4")
        lengths = np.fromiter(map(len, words), np.int64, len(words))[order].astype("<u4")
        ends = np.concatenate([[0], np.cumsum(documents)]).astype(np.int64)
        heads = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        sizes, blobs = [], []
        for a, b in zip(heads, [*heads[1:], len(words)]):
            raw = b"".join([
                np.uint32([b - a, ends[b] - ends[a]]).tobytes(), lengths[a:b].tobytes(),
                documents[a:b].tobytes(), count[ends[a]:ends[b]].tobytes(),
                places[ends[a]:ends[b]].tobytes(), *[words[i] for i in order[a:b]]])
            sizes.append(len(raw))
            blobs.append(pa.compress(raw, codec="zstd", asbytes=True))
        none = pa.nulls(len(heads), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[order][heads].astype(np.int32)), pa.array(np.full(len(heads), chunk)),
             pa.array(sizes, type=pa.int32()), pa.array(blobs, type=pa.binary()), none, none],
            names=PACKED)
        n_bytes = [len((t or "").encode()) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk % buckets], type=pa.int32()), pa.array([chunk]), pa.array([0], type=pa.int32()),
             pa.array([None], type=pa.binary()),
             *[pa.array([x], type=pa.list_(pa.int64()))
               for x in (rows["doc_id"].to_pylist(), n_bytes)]], names=PACKED)


PACKED = ["bucket", "chunk", "size", "packed", "doc_ids", "sizes"]
SUMMED = ["chunk", "places", "sums", "doc_ids", "sizes"]
#: chunks whose sums a task holds before it hands them on
HELD_CHUNKS = 512


def unpacked(packed: bytes, size: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Words; documents per word; places and counts of all words after each other."""
    raw = memoryview(pa.decompress(packed, decompressed_size=size, codec="zstd"))
    words, pairs = np.frombuffer(raw, "<u4", 2).tolist()
    numbers = np.frombuffer(raw, "<u4", 2 * words + pairs, 8)
    at = 8 + 4 * len(numbers)
    places = np.frombuffer(raw, "<u2", pairs, at)
    ends = at + 2 * pairs + np.concatenate([[0], np.cumsum(numbers[:words], dtype=np.int64)])
    text = bytes(raw)
    return ([text[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())],
            numbers[words:2 * words], places, numbers[2 * words:])


def sum_rows(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Rows of `packed_rows` in the order of their buckets -> sums of tokens per chunk.

    The words of a bucket are counted when they first come and remembered for its other chunks.
    """
    known: dict[bytes, int] = {}
    current = None
    held: dict[int, np.ndarray] = {}
    none = pa.nulls(1, pa.list_(pa.int64()))

    def out():
        for chunk, sums in held.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk]), pa.array([at.astype("<u2").tobytes()], type=pa.binary()),
                 pa.array([sums[at].tobytes()], type=pa.binary()), none, none], names=SUMMED)
        held.clear()

    for batch in batches:
        for i in range(batch.num_rows):
            bucket, chunk, size, packed, ids, sizes = (c[i] for c in batch.columns)
            if not packed.is_valid:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("chunk").slice(i, 1), pa.nulls(1, pa.binary()),
                     pa.nulls(1, pa.binary()), batch.column("doc_ids").slice(i, 1),
                     batch.column("sizes").slice(i, 1)], names=SUMMED)
                continue
            if bucket != current:
                current, known = bucket, {}
            words, documents, places, counts = unpacked(packed.as_py(), size.as_py())
            new = [w for w in words if w not in known]
            known.update(zip(new, count_tokens(new, path)))
            tokens = np.repeat(np.fromiter(map(known.__getitem__, words), np.int64, len(words)),
                               documents) * counts
            sums = held.setdefault(chunk.as_py(), np.zeros(CHUNK_ROWS, np.int64))
            sums += np.bincount(places, weights=tokens, minlength=CHUNK_ROWS).astype(np.int64)
            if len(held) > HELD_CHUNKS:
                yield from out()
    yield from out()


def document_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `sum_rows` in the order of their chunks -> doc_id, n_bytes, n_tokens."""
    current, sums, documents = None, None, None

    def out():
        ids, sizes = documents
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, type=pa.int64()), pa.array(sizes, type=pa.int64()),
             pa.array(sums[:len(ids)])], names=["doc_id", "n_bytes", "n_tokens"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["chunk"] != current:
                if current is not None:
                    yield out()
                current, sums = row["chunk"], np.zeros(CHUNK_ROWS, np.int64)
            if row["places"] is None:
                documents = row["doc_ids"], row["sizes"]
            else:
                sums[np.frombuffer(row["places"], "<u2")] += np.frombuffer(row["sums"], np.int64)
    if current is not None:
        yield out()


def token_counts(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens for every row.

    Two shuffles: packed frequencies by bucket of words, where each distinct word is counted and
    joined to the chunks that have it, and sums by chunk. A bucket holds some thousand words of each
    task, whatever the size of the input.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    lists = "doc_ids array<long>, sizes array<long>"
    packed = rows.mapInArrow(lambda b: packed_rows(b, path, BUCKETS * tasks),
                             f"bucket int, chunk long, size int, packed binary, {lists}")
    sums = packed.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(
        lambda b: sum_rows(b, path), f"chunk long, places binary, sums binary, {lists}")
    return sums.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(
        document_rows, "doc_id long, n_bytes long, n_tokens long")
