"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents of one task. Its words become numbers, every document ends with a
separator of its own, and the suffix order of the whole shard gives the Burrows-Wheeler text. That is
kept as a wavelet matrix with rank counts, and every 16th text place (and each document's first) is
kept with its suffix. A phrase is searched backwards, all phrases of a shard at a time: each word
narrows a range of suffixes by two ranks. The places of the last range are found by stepping back to
a kept place. Overlapping finds of a document are merged into spans.

Documents are not shuffled: a shard's index is made, searched and forgotten in the task that read
it. Phrases are a query set: they travel to the tasks in blocks of at most `PHRASE_BYTES`.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. An item of ten words or
more gives every window of ten; a shorter one, but not one without words, is one window.

Defined results: null and empty texts have no words and no finds; a null or empty item has no
windows; items with equal windows each count; a null item id never counts but its windows hit;
repeated rows are searched row by row; empty tables give no finds or no rows; other columns of
either table are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_in

WINDOW = 10
#: distance of text places whose suffix is kept
SAMPLE = 16
#: documents and bytes of text in one shard, whose index takes about sixty times that; a longer text is a
#: shard of its own
SHARD_ROWS, SHARD_BYTES = 20_000, 2 << 20
#: bytes of benchmark text that are sent to the tasks at a time
PHRASE_BYTES = 8 << 20

_keep = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _keep else 0x20 for b in range(256))

#: the same words in a text whose case is kept
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """The start places of all suffixes in order; symbols end in one that occurs only there.

    Ranks of the first h symbols are refined to the first 2h for those suffixes that still tie.
    """
    n = len(symbols)
    bits = max(1, int(symbols.max()).bit_length())
    wide = max(1, min(62 // bits, 4, n))  # so many symbols in one sort key
    key = symbols.astype(np.int64)
    for k in range(1, wide):
        key <<= bits
        key[: n - k] |= symbols[k:]
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    change = np.flatnonzero(np.diff(key[order])) + 1
    heads = np.concatenate([[0], change])
    sizes = np.diff(np.concatenate([heads, [n]]))
    rank[order] = np.repeat(heads, sizes)  # a group is named by the place of its first suffix
    tied = np.repeat(sizes > 1, sizes)
    h = wide
    while tied.any():
        at = np.flatnonzero(tied)
        suffix = order[at]
        after = suffix + h
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        first = rank[suffix]
        by = np.lexsort((second, first))
        suffix, first, second = suffix[by], first[by], second[by]
        order[at] = suffix
        new = np.concatenate([[True], (np.diff(first) != 0) | (np.diff(second) != 0)])
        heads = np.flatnonzero(new)
        sizes = np.diff(np.concatenate([heads, [len(at)]]))
        rank[suffix] = np.repeat(at[heads], sizes)
        tied[at] = np.repeat(sizes > 1, sizes)
        h *= 2
    return order


class WaveletMatrix:
    """Rank and access on a sequence of numbers, one bit vector per bit, highest first."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.bits = max(1, int(values.max()).bit_length()) if self.n else 1
        self.ones: list[np.ndarray] = []  # running count of one bits, n + 1 long
        self.zeros: list[int] = []
        for b in range(self.bits - 1, -1, -1):
            bit = (values >> b) & 1
            ones = np.zeros(self.n + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(self.n - int(ones[-1]))
            is_one = bit.astype(bool)
            values = np.concatenate([values[~is_one], values[is_one]])

    def rank(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each value occurs before its place."""
        start = np.zeros_like(at)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            one = (value >> (self.bits - 1 - level)) & 1 == 1
            a, s = ones[at], ones[start]
            at = np.where(one, zeros + a, at - a)
            start = np.where(one, zeros + s, start - s)
        return at - start

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at places, and how often each occurs before its place."""
        value, start = np.zeros_like(at), np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros):
            a, s = ones[at], ones[start]
            one = ones[at + 1] > a
            value = (value << 1) | one
            at = np.where(one, zeros + a, at - a)
            start = np.where(one, zeros + s, start - s)
        return value, at - start


class ShardIndex:
    """FM-index over the words of a list of documents."""

    def __init__(self, documents: list[list[bytes]]):
        names: dict[bytes, int] = {}
        self.names = names
        self.lengths = np.array([len(d) for d in documents], dtype=np.int64)
        flat = np.fromiter((names.setdefault(w, len(names)) for d in documents for w in d),
                           dtype=np.int64, count=int(self.lengths.sum()))
        count = len(documents)
        ends = np.cumsum(self.lengths)
        text = np.insert(flat + count, ends, np.arange(count))  # separators are the lowest symbols
        self.first_place = np.concatenate([[0], (ends + np.arange(1, count + 1))[:-1]])
        order = suffix_order(text)
        before = np.where(order > 0, order - 1, len(text) - 1)
        last = np.maximum(text[before] - count + 1, 0)  # all separators are 0 here
        self.matrix = WaveletMatrix(last)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(last, minlength=len(names) + 1))])
        kept = (order % SAMPLE == 0) | (last == 0)
        self.kept = np.zeros(len(text) + 1, dtype=np.int64)
        np.cumsum(kept, out=self.kept[1:])
        self.sampled = order[kept]

    def search(self, phrases: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that start with each phrase (empty where low = high)."""
        get = self.names.get
        coded = [[get(w, -1) + 1 for w in p] for p in phrases]
        alive = np.array([i for i, c in enumerate(coded) if all(c)], dtype=np.int64)
        low, high = np.zeros(len(phrases), np.int64), np.zeros(len(phrases), np.int64)
        if not len(alive):
            return low, high
        depth = np.array([len(coded[i]) for i in alive])
        table = np.zeros((len(alive), depth.max()), np.int64)
        for row, i in enumerate(alive):
            table[row, -depth[row]:] = coded[i]
        lo, hi = np.zeros(len(alive), np.int64), np.full(len(alive), self.matrix.n)
        for column in range(table.shape[1] - 1, -1, -1):
            on = np.flatnonzero((table[:, column] > 0) & (lo < hi))
            if not len(on):
                continue
            symbol = table[on, column]
            lo[on] = self.starts[symbol] + self.matrix.rank(symbol, lo[on])
            hi[on] = self.starts[symbol] + self.matrix.rank(symbol, hi[on])
        low[alive], high[alive] = lo, np.maximum(lo, hi)
        return low, high

    def locate(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """phrase, document, first word of every occurrence."""
        n = high - low
        phrase = np.repeat(np.arange(len(low)), n)
        row = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        place, steps = np.full(len(row), -1), np.zeros(len(row), np.int64)
        open_ = np.arange(len(row))
        while len(open_):
            at = row[open_]
            k = self.kept[at]
            found = self.kept[at + 1] > k
            place[open_[found]] = self.sampled[k[found]] + steps[open_[found]]
            open_ = open_[~found]
            symbol, rank = self.matrix.access(row[open_])
            row[open_] = self.starts[symbol] + rank
            steps[open_] += 1
        document = np.searchsorted(self.first_place, place, side="right") - 1
        return phrase, document, place - self.first_place[document]


def windows_of(items: list[tuple[str | None, str | None]]) -> tuple[list, list]:
    """Distinct windows and, for each, the ids of the items it stands in."""
    owners: dict[tuple, dict] = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - WINDOW + 1) if w else 0):
            owners.setdefault(tuple(w[i:i + WINDOW]), {})[item] = None
    return list(owners), [list(x) for x in owners.values()]


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Spans that cover the given ones, without overlaps."""
    by = np.argsort(starts, kind="stable")
    starts, ends = starts[by], np.maximum.accumulate(ends[by])
    cut = np.flatnonzero(starts[1:] > ends[:-1]) + 1
    return list(zip(starts[np.concatenate([[0], cut])].tolist(),
                    ends[np.concatenate([cut - 1, [len(ends) - 1]])].tolist()))


def find_in_shards(batches: Iterator[pa.RecordBatch], blocks, carry: list[str], text: str
                   ) -> Iterator[pa.RecordBatch]:
    """Rows with n_words, spans (first word, past word) and item_ids added to the carried columns."""
    blocks = blocks.value
    for rows in rows_in(batches, SHARD_ROWS, SHARD_BYTES, text):
        documents = [words_of(t) for t in rows[text].to_pylist()]
        spans = [[] for _ in documents]
        items: list[set] = [set() for _ in documents]
        index = ShardIndex(documents) if any(documents) else None
        for windows, owners in blocks if index else ():
            low, high = index.search(windows)
            hit = np.flatnonzero(high > low)
            phrase, document, first = index.locate(low[hit], high[hit])
            past = first + np.array([len(windows[i]) for i in hit], dtype=np.int64)[phrase]
            for d, p in set(zip(document.tolist(), phrase.tolist())):
                items[d].update(owners[hit[p]])
            by = np.argsort(document, kind="stable")
            document, first, past = document[by], first[by], past[by]
            heads = np.flatnonzero(np.diff(document, prepend=-1))
            for a, b in zip(heads, [*heads[1:], len(document)]):
                spans[document[a]] += merged(first[a:b], past[a:b])
        if len(blocks) > 1:
            spans = [merged(*np.array(s).T) if len(s) > 1 else s for s in spans]
        yield pa.RecordBatch.from_arrays(
            [rows[c].combine_chunks() for c in carry] + [
                pa.array([len(d) for d in documents], type=pa.int64()),
                pa.array([[{"first": a, "past": b} for a, b in s] for s in spans],
                         type=pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))),
                pa.array([sorted(str(i) for i in x if i is not None) for x in items],
                         type=pa.list_(pa.string()))],
            names=[*carry, "n_words", "spans", "item_ids"])


def phrase_blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> list:
    """The windows of all items in blocks; a block ends once it holds PHRASE_BYTES of text."""
    blocks, held, size = [], [], 0
    for r in benchmark.select(F.col(item).cast("string"), text).toLocalIterator():
        held.append(tuple(r))
        size += len(r[1] or "")
        if size >= PHRASE_BYTES:
            blocks.append(windows_of(held))
            held, size = [], 0
    return blocks + [windows_of(held)] * bool(held)


def occurrences(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
                carry: tuple[str, ...] = ()) -> DataFrame:
    """id, the carried columns, n_words, spans, item_ids for every row of `docs`."""
    columns = [id, *carry]
    rows = docs.select(*columns, *([] if text in columns else [text]))
    blocks = docs.sparkSession.sparkContext.broadcast(phrase_blocks(benchmark))
    types = dict(docs.dtypes)
    return rows.mapInArrow(
        lambda batches: find_in_shards(batches, blocks, columns, text),
        ", ".join(f"`{c}` {types[c]}" for c in columns) + ", n_words long, "
        "spans array<struct<first:long,past:long>>, item_ids array<string>")


def digests(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of rows of `occurrences`."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["past"] - s["first"])
    return found.select(
        F.col(id).alias("doc_id"), "n_words", hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))


def without_spans(text: str | None, spans: list) -> str | None:
    """The text without the words of each span and what stands between them."""
    if not spans:
        return text
    at = [m.span() for m in WORD.finditer(text)]
    out, last = [], 0
    for s in spans:
        out.append(text[last:at[s["first"]][0]])
        last = at[s["past"] - 1][1]
    return "".join([*out, text[last:]])


def cut_rows(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column("spans").to_pylist()
        cut = [without_spans(t, s) for t, s in zip(batch.column(text).to_pylist(), spans)]
        names = [c for c in batch.schema.names if c not in ("n_words", "spans", "item_ids")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cut, type=pa.string()) if c == text else batch.column(c) for c in names],
            names=names)


def cleaned(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns of `docs`; texts have lost the benchmark's words. n_chars follows."""
    names, types = docs.columns, dict(docs.dtypes)
    plain = [f"c{i}" for i in range(len(names))]  # the input's own names may be used inside
    at = plain[names.index(text)]
    blocks = docs.sparkSession.sparkContext.broadcast(phrase_blocks(benchmark))
    # found and cut by one worker per task: another would hold the texts once more
    out = docs.toDF(*plain).mapInArrow(
        lambda batches: cut_rows(find_in_shards(batches, blocks, plain, at), at), ", ".join(
            f"{c} {types[n]}" for c, n in zip(plain, names))).toDF(*names)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(
            F.col(text).isNull(), F.col("n_chars")).otherwise(F.length(text)).cast(
            types["n_chars"]))
    return out
