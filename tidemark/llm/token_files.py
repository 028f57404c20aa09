"""Token ids as ORC files in document order.

Rows are dealt by ranges of the document id and sorted, so file i holds smaller ids than file i+1.
Each row keeps the id, the file's number, the place of its first token in that file and the ids as
an integer array: ORC stores the ids in stripes with integer run-length encoding, keeps minimum and
maximum per stripe and per row group, and a Bloom filter on the document id, so a reader takes
single stripes in parallel and skips those a filter excludes.

Defined results: a null or empty text has only the end id; null document ids come first; rows that
share an id lie next to each other in the order of their text's hash, and repeated rows each keep
their own ids; an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import rows_in

END_ID = 0
#: texts encoded at a time: rows and bytes
BATCH_ROWS, BATCH_BYTES = 4_000, 1 << 19
#: pieces whose ids a worker remembers (and as many from before, of which those that come again stay),
#: and pieces encoded in one call
CACHE_PIECES, LINES = 600_000, 2_000
#: marks that are encoded apart from the word before them
MARKS = ".,;:!?"
#: at these, and at two spaces or line breaks together, a text is not cut into pieces
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class Encoder:
    """Ids of texts by the tokenizers library; pieces that occur often are encoded once.

    The pre-tokenizer never joins what stands before a single space or around a single line break, nor a
    letter or digit and a punctuation mark that ends a word, so texts are cut there and each distinct
    piece is encoded on its own. Pieces are found, told apart and put together as arrays: two 64-bit
    hashes stand for a piece, differences of running sums over the bytes. Texts with other white space,
    or with a special token's string, go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.specials = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.line = np.array(self.library.encode("\n", add_special_tokens=False).ids, dtype="<u4")
        self.known, self.older = Pieces(), Pieces()

    def direct(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4")
                for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def each(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one after another, and how many each has. Pieces without line breaks stand in
        one text, a line each."""
        ids, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for a in range(0, len(pieces), LINES):
            lines = b"\n".join(pieces[a:a + LINES]).decode()
            got = np.array(self.library.encode_batch_fast([lines], add_special_tokens=False)[0].ids, "<u4")
            breaks = got == self.line[0]
            ends = np.append(np.flatnonzero(breaks), len(got))
            ids.append(got[~breaks])
            sizes.append(np.diff(ends, prepend=-1) - 1)
        return np.concatenate(ids), np.concatenate(sizes)

    def whole(self, texts: list[bytes], data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which texts (their bytes, one after another, are `data`) are not cut into pieces."""
        kind = KIND[data]
        apart = kind == 1
        together = apart[1:] & apart[:-1]
        together[ends[(ends > 0) & (ends < len(data))] - 1] = False  # two texts
        odd = np.concatenate([np.flatnonzero(together), np.flatnonzero(kind == 2)])
        whole = np.zeros(len(texts), bool)
        whole[np.searchsorted(ends, odd, side="right") - 1] = True
        other = np.zeros(len(texts), bool)
        other[np.searchsorted(ends, np.flatnonzero(kind == 3), side="right") - 1] = True
        raw = data.tobytes()
        special = [s for s in self.specials if s in raw]
        for i in np.flatnonzero(~whole & (other | bool(special))):
            whole[i] = any(s in texts[i] for s in special) or (
                other[i] and OTHER_SPACE.search(texts[i].decode()) is not None)
        return whole

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after another, and how many each text has."""
        coded = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(coded), np.uint8)
        ends = np.cumsum([0, *map(len, coded)])
        whole = self.whole(coded, data, ends)
        if not whole.any():
            return self.from_pieces(data, ends)
        cut = np.flatnonzero(~whole)
        counts = np.zeros(len(texts), np.int64)
        some = [coded[i] for i in cut]
        ids, counts[cut] = self.from_pieces(np.frombuffer(b"".join(some), np.uint8),
                                            np.cumsum([0, *map(len, some)]))
        rest = np.flatnonzero(whole)
        others = self.direct([texts[i] for i in rest])
        counts[rest] = [len(x) for x in others]
        parts = dict(zip(rest.tolist(), others))
        parts.update(zip(cut.tolist(), np.split(ids, np.cumsum(counts[cut])[:-1]) if len(cut) else []))
        return np.concatenate([parts[i] for i in range(len(texts))]), counts

    def from_pieces(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that are cut, and how many each has; text i is data[ends[i]:ends[i + 1]]."""
        starts = piece_starts(data, ends)
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(len(ends) - 1, np.int64)
        stops = np.append(starts[1:], len(data))
        first, second = piece_hashes(data, np.append(starts, len(data)))
        distinct, at, which = distinct_values(first)
        if not (second[at][which] == second).all():  # two pieces with one hash
            whole = self.direct([data[a:b].tobytes().decode() for a, b in zip(ends[:-1], ends[1:])])
            return (np.concatenate([np.zeros(0, "<u4"), *whole]),
                    np.array([len(x) for x in whole], np.int64))
        second = second[at]
        missing = np.flatnonzero(self.known.missing(distinct, second))
        again = ~self.older.missing(distinct[missing], second[missing])
        old = missing[again]
        self.known.add(distinct[old], second[old], *self.older.take(distinct[old]))
        new = missing[~again]
        line = data[starts[at[new]]] == 10  # a line break is a piece of its own
        if line.any():
            self.known.add(distinct[new[line]], second[new[line]], self.line,
                           np.array([len(self.line)], np.int64))
        new = new[~line]
        raw = data.tobytes()
        pieces = [raw[a:b] for a, b in zip(starts[at[new]].tolist(), stops[at[new]].tolist())]
        self.known.add(distinct[new], second[new], *self.each(pieces))
        ids, sizes = self.known.take(distinct)
        ids, sizes = spread(ids, sizes, which)
        counts = np.add.reduceat(np.append(sizes, 0), np.searchsorted(starts, ends[:-1]))
        counts[np.diff(ends) == 0] = 0
        if len(self.known) > CACHE_PIECES:
            self.older, self.known = self.known, Pieces()
        return ids, counts


class Pieces:
    """Ids of known pieces, in the order of their first hashes."""

    def __init__(self):
        self.first, self.second = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.sizes, self.starts, self.ids = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, "<u4")

    def __len__(self) -> int:
        return len(self.first)

    def missing(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Which of some pieces are unknown."""
        at = np.minimum(np.searchsorted(self.first, first), max(0, len(self) - 1))
        if not len(self):
            return np.ones(len(first), bool)
        return (self.first[at] != first) | (self.second[at] != second)

    def add(self, first: np.ndarray, second: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """More pieces, in the order of their first hashes."""
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        at = np.searchsorted(self.first, first) + np.arange(len(first))
        old = np.ones(len(self) + len(first), bool)
        old[at] = False
        for name, values in (("first", first), ("second", second), ("sizes", sizes),
                             ("starts", starts)):
            had = getattr(self, name)
            merged = np.empty(len(old), had.dtype)
            merged[old], merged[at] = had, values
            setattr(self, name, merged)
        self.ids = np.concatenate([self.ids, ids])

    def take(self, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number of known pieces."""
        at = np.searchsorted(self.first, first)
        sizes = self.sizes[at].astype(np.int64)
        return ragged(self.ids, self.starts[at], sizes), sizes


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of an array, one after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts - ends + sizes, sizes)]


def spread(ids: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches repeated and ordered as `which` says."""
    starts = np.cumsum(sizes) - sizes
    return ragged(ids, starts[which], sizes[which]), sizes[which]


#: of a byte: 1 a space or line break, 2 other ASCII white space, 3 the first byte of other white space
KIND = np.zeros(256, np.uint8)
KIND[[0, 9, 11, 12, 13, *range(0x1C, 0x20)]] = 2
KIND[[0x20, 0x0A]] = 1
KIND[[0xC2, 0xE1, 0xE2, 0xE3]] = 3
ALNUM = np.zeros(256, bool)
ALNUM[[*b"0123456789", *range(65, 91), *range(97, 123)]] = True
MARK = np.zeros(256, bool)
MARK[list(MARKS.encode())] = True


def piece_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pieces begin: at texts, at spaces, at and behind line breaks, and at a mark that ends a
    word."""
    space, line = data == 32, data == 10
    cut = np.zeros(len(data) + 1, bool)
    cut[:-1] = space | line
    cut[1:] |= line
    cut[ends] = True
    mark = np.flatnonzero(MARK[data[1:]] & ALNUM[data[:-1]]) + 1
    cut[mark[cut[mark + 1]]] = True
    return np.flatnonzero(cut[:-1])


_BASES = [(b, pow(b, -1, 1 << 64)) for b in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        p = np.full(n, base, np.uint64)
        p[0] = 1
        _powers[base] = np.multiply.accumulate(p)
    return _powers[base][:n]


def piece_hashes(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two hashes of each piece and its length: polynomials over its bytes, modulo 2^64."""
    out = []
    size = np.diff(bounds).astype(np.uint64)
    wide = data.astype(np.uint64)
    wide += np.uint64(1)
    sums = np.zeros(len(data) + 1, np.uint64)
    for base, inverse in _BASES:
        np.multiply(wide, powers(base, len(data)), out=sums[1:])
        np.cumsum(sums[1:], out=sums[1:])
        h = np.diff(sums[bounds]) * powers(inverse, len(data) + 1)[bounds[:-1]] + size
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        out.append(h ^ (h >> np.uint64(29)))
    return out


def distinct_values(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values in order, a place of each, and which of them stands at each place."""
    order = np.argsort(values)
    ordered = values[order]
    head = np.append(True, ordered[1:] != ordered[:-1])
    which = np.empty(len(values), np.int64)
    which[order] = np.cumsum(head) - 1
    return ordered[head], order[head], which


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_rows(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> doc_id, part, start_in_part, n_tokens, ids, in the order of the rows."""
    library, part, start = encoder(path), TaskContext.get().partitionId(), 0
    pa.default_memory_pool().release_unused()  # what the worker's task before held
    for rows in rows_in(batches, BATCH_ROWS, BATCH_BYTES):
        ids, sizes = library.encode([t or "" for t in rows["text"].to_pylist()])
        n = sizes + 1
        ends = np.concatenate([[0], np.cumsum(n)])
        values = np.full(ends[-1], END_ID, dtype="<u4")
        inside = np.ones(len(values), bool)
        inside[ends[1:] - 1] = False
        values[inside] = ids
        yield pa.RecordBatch.from_arrays([
            rows["doc_id"].combine_chunks(), pa.array(np.full(len(n), part, dtype=np.int32)),
            pa.array(start + ends[:-1]), pa.array(n),
            pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.view("<i4"))),
        ], names=["doc_id", "part", "start_in_part", "n_tokens", "ids"])
        start += int(ends[-1])


def write_ids(docs: DataFrame, out: str, tokenizer: str, id: str = "doc_id", text: str = "text",
              stripe_mb: int = 64, row_group: int = 10_000, fpp: float = 0.01) -> None:
    """Encode every text and write the ORC files; the only shuffle is the one by ranges of ids.

    Ranges also use the text's hash, so an id that many rows share (or null) is still spread.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order, "text")
    coded = dealt.mapInArrow(
        lambda batches: encode_rows(batches, tokenizer),
        "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>")
    coded.write.option("orc.bloom.filter.columns", "doc_id").option(
        "orc.bloom.filter.fpp", fpp).option("orc.stripe.size", stripe_mb << 20).option(
        "orc.row.index.stride", row_group).option("compression", "zstd").orc(out)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids; start counts the ids of all documents before it.

    The first ids of the files come from one pass over two small columns. That table has one row
    per file, at most as many as the tasks of the writing job, so it is broadcast.
    """
    rows = spark.read.schema("doc_id long, part int, start_in_part long, n_tokens long, "
                             "ids array<int>").orc(path)
    parts = rows.groupBy("part").agg(
        F.max(F.col("start_in_part") + F.col("n_tokens")).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids")


def checksum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        values = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), dtype="<i4")
        ends = ids.offsets.to_numpy()
        crc = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            + [pa.array(crc, type=pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of rows that `read_ids` gives."""
    return rows.mapInArrow(
        checksum_rows, "doc_id long, start long, n_tokens long, ids_crc32 long")
