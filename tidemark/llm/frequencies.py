"""Word frequencies per document as an inverted table, and sums of word values over documents.

A chunk is a run of up to 8,192 documents of one task. For every distinct word of a chunk there is
one row with the documents it stands in and how often, so a word is stored once per chunk instead
of once per document. Values known per distinct word come back to the documents by a join on the
word; a task adds up what it has per chunk, and only these sums are shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import rows_in, stored

CHUNK_ROWS, CHUNK_BYTES = 8_192, 16 << 20
#: sums that a task holds before it hands them on
HELD = 2_000_000


def schema_of(groups: int) -> list[str]:
    """Columns of the table; c0, c1 ... count a word in the documents of each group."""
    return ["chunk long", "word binary", "places binary", "counts binary",
            *[f"c{g} long" for g in range(groups)],
            "doc_ids array<long>", "sizes array<long>", "totals array<long>"]


def binaries(ends: np.ndarray, data: np.ndarray) -> pa.Array:
    """A binary column over one buffer; ends: first place of each value, then the length."""
    offsets = (ends * data.itemsize).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def chunk_rows(batches: Iterator[pa.RecordBatch], split: Callable[[str | None], list[bytes]],
               groups: int) -> Iterator[pa.RecordBatch]:
    """doc_id, text, in_group -> the rows of schema_of(groups): one per word, and one per chunk
    without a word that has the ids, UTF-8 sizes and word totals of its documents."""
    columns = [c.split()[0] for c in schema_of(groups)]
    first = TaskContext.get().partitionId() << 33
    for number, rows in enumerate(rows_in(batches, CHUNK_ROWS, CHUNK_BYTES)):
        names: dict[bytes, int] = defaultdict()
        names.default_factory = names.__len__
        texts = rows["text"].to_pylist()
        totals = np.zeros(len(texts), np.int64)
        coded = []
        for i, text in enumerate(texts):
            words = split(text)
            totals[i] = len(words)
            coded.append(np.fromiter(map(names.__getitem__, words), np.int64, len(words)))
        flat = np.concatenate(coded)
        place = np.repeat(np.arange(len(texts)), totals)
        pair, count = np.unique((flat << 16) | place, return_counts=True)
        word = pair >> 16
        group = rows["in_group"].combine_chunks().fill_null(-1).to_numpy()[pair & 0xFFFF]
        by_group = [pa.array(np.bincount(word, weights=count * (group == g),
                                         minlength=len(names)).astype(np.int64))
                    for g in range(groups)]
        times = (count + 254) // 255  # a count above 255 takes several entries
        rest = count - 255 * (times - 1)
        lasts = np.cumsum(times) - 1
        counts = np.full(int(times.sum()), 255, np.uint8)
        counts[lasts] = rest
        places = np.repeat(pair & 0xFFFF, times).astype("<u2")
        ends = np.concatenate([[0], np.cumsum(np.bincount(
            word, weights=times, minlength=len(names)))]).astype(np.int64)
        n = len(names)
        chunk = first + number
        none = pa.nulls(n, pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(n, chunk)), pa.array(list(names), type=pa.binary()),
            binaries(ends, places), binaries(ends, counts),
            *by_group, none, none, none], names=columns)
        sizes = [len((t or "").encode("utf-8", "surrogatepass")) for t in texts]
        yield pa.RecordBatch.from_arrays([
            pa.array([chunk]), pa.array([None], type=pa.binary()),
            pa.array([None], type=pa.binary()), pa.array([None], type=pa.binary()),
            *[pa.array([None], type=pa.int64())] * groups,
            *[pa.array([x], type=pa.list_(pa.int64()))
              for x in (rows["doc_id"].to_pylist(), sizes, totals.tolist())]], names=columns)


def frequencies(docs: DataFrame, split: Callable[[str | None], list[bytes]], id: str = "doc_id",
                text: str = "text", in_group: Column | None = None, groups: int = 0) -> DataFrame:
    """The stored table. in_group: the number of a row's group, null for none."""
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       (F.lit(None) if in_group is None else in_group).cast("int").alias("in_group"))
    table = rows.mapInArrow(lambda b: chunk_rows(b, split, groups), ", ".join(schema_of(groups)))
    return stored(table, "frequencies")


def documents_of(table: DataFrame) -> DataFrame:
    """chunk, place, doc_id, n_bytes, n_words of every row of the input."""
    return table.filter("word is null").select("chunk", F.posexplode(
        F.arrays_zip("doc_ids", "sizes", "totals")).alias("place", "d")).select(
        "chunk", "place", F.col("d.doc_ids").alias("doc_id"), F.col("d.sizes").alias("n_bytes"),
        F.col("d.totals").alias("n_words"))


def sum_rows(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.RecordBatch]:
    """chunk, places, counts, columns -> chunk, places, sums: one row per chunk that a task met.

    sums holds a number per column and place. What is held stays below HELD sums; then the rows go
    out and the task starts anew.
    """
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    chunk_list: list[int] = []  # chunks by the small numbers that keys use
    numbers: dict[int, int] = {}

    def combined():
        keys = np.concatenate([k for k, _ in held])
        values = np.concatenate([v for _, v in held], axis=1)
        distinct, at = np.unique(keys, return_inverse=True)
        return distinct, np.stack([np.bincount(at, weights=v) for v in values])

    def out(keys, values):
        heads = np.flatnonzero(np.diff(keys >> 16, prepend=-1))
        ends = [*heads[1:], len(keys)]
        yield pa.RecordBatch.from_arrays([
            pa.array([chunk_list[keys[h] >> 16] for h in heads], type=pa.int64()),
            pa.array([(keys[a:b] & 0xFFFF).astype("<u2").tobytes() for a, b in zip(heads, ends)],
                     type=pa.binary()),
            pa.array([values[:, a:b].tobytes() for a, b in zip(heads, ends)], type=pa.binary()),
        ], names=["chunk", "places", "sums"])

    for batch in batches:
        if not batch.num_rows:
            continue
        places, counts = batch.column("places"), batch.column("counts")
        flat = [np.frombuffer(c.buffers()[2], kind)
                for c, kind in ((places, "<u2"), (counts, np.uint8))]
        ends = np.frombuffer(counts.buffers()[1], "<i4")[
            counts.offset:counts.offset + len(counts) + 1].astype(np.int64)
        place, count = flat[0][ends[0]:ends[-1]].astype(np.int64), flat[1][ends[0]:ends[-1]]
        for c in set(batch.column("chunk").to_pylist()).difference(numbers):
            numbers[c] = len(chunk_list)
            chunk_list.append(c)
        chunk = np.fromiter((numbers[c] for c in batch.column("chunk").to_pylist()), np.int64,
                            batch.num_rows)
        n = np.diff(ends)
        keys = (np.repeat(chunk, n) << 16) | place
        values = np.stack([np.repeat(batch.column(c).to_numpy(zero_copy_only=False), n) * count
                           for c in columns])
        held.append((keys, values))
        size += len(keys)
        if size > HELD:
            keys, values = combined()
            held, size = [(keys, values)], len(keys)
            if size > HELD // 2:
                yield from out(keys, values)
                held, size, chunk_list, numbers = [], 0, [], {}
    if held:
        yield from out(*combined())


def total_rows(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of `sum_rows` in the order of their chunks -> one row per document."""
    current, sums, seen = None, None, None

    def out():
        at = np.flatnonzero(seen)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), current)), pa.array(at.astype(np.int32)),
             *[pa.array(v[at]) for v in sums]], names=["chunk", "place", *columns])

    for batch in batches:
        for chunk, places, values in zip(*(batch.column(c) for c in ("chunk", "places", "sums"))):
            if chunk.as_py() != current:
                if current is not None:
                    yield out()
                current = chunk.as_py()
                sums, seen = np.zeros((len(columns), CHUNK_ROWS)), np.zeros(CHUNK_ROWS, bool)
            at = np.frombuffer(places.as_buffer(), "<u2")
            seen[at] = True
            sums[:, at] += np.frombuffer(values.as_buffer()).reshape(len(columns), -1)
    if current is not None:
        yield out()


def document_sums(table: DataFrame, values: DataFrame, columns: list[str]) -> DataFrame:
    """documents_of(table) with, for each column of `values` (word, columns), its sum over the
    words of the document."""
    postings = table.filter("word is not null").select("chunk", "word", "places", "counts")
    joined = postings.join(values, "word").select(
        "chunk", "places", "counts", *[F.col(c).cast("double") for c in columns])
    schema = ", ".join(["chunk long", "place int", *[f"{c} double" for c in columns]])
    partial = joined.mapInArrow(lambda b: sum_rows(b, columns),
                                "chunk long, places binary, sums binary")
    # a chunk is met by many tasks; its rows come together in order and are added one by one
    sums = partial.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(
        lambda b: total_rows(b, columns), schema)
    return documents_of(table).join(sums, ["chunk", "place"], "left").drop(
        "chunk", "place").fillna(0.0, columns)
