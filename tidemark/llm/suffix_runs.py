"""Repeated long passages by a sparse suffix array, merged from front-coded runs.

A byte goes if a string of `LENGTH` bytes that covers it starts anywhere else too. Sorting all
suffixes by `LENGTH` bytes would move every byte `LENGTH` times, so only suffixes at *anchors* are
sorted: each window of `LENGTH` bytes picks the first of its `GRAM`-byte strings with the least hash.
The choice depends on the window's bytes alone, so equal windows pick equal anchors, and a window can
only repeat if its anchor's string does. That leaves one suffix in about 150 bytes, and of those only
the ones whose string occurs again.

* Tasks cut a suffix (from the anchor on) and what stands before it out of the text, make equal ones
  one record, sort them, and write *runs*: of each suffix only what the one before does not begin
  with (front coding). A run goes to one range of the order, which begins with the anchor's hash, so
  ranges are even and hold all suffixes of an anchor's string.
* A range merges its runs with a loser tree whose nodes keep how long a prefix the loser shares with
  the last winner (`merged`). A longer common prefix decides alone; characters are only compared
  behind it, none twice.
* Neighbours in the merged order share prefixes, which are classes of equal right parts for every
  length; the same holds for the reversed left parts. A window, `d` bytes before its anchor, repeats
  if its left and right class meet in two records.

Strings that more than `HOT` anchors have may fill a task. Their windows are not merged: Spark counts
the windows' digests, adds up before the shuffle, and joins the repeated ones back.

Defined results: null texts are empty; texts under `LENGTH` bytes lose nothing and repeat nothing;
a repeated row's text is repeated, so all its copies go; null and repeated ids stay rows; an empty
table gives no rows; other columns are ignored. Positions are bytes, so a cut may part a character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, rows_in, stored

LENGTH, GRAM = 400, 128
#: records of a range (more where shuffle partitions are fewer), of a run, worked on at a time, and
#: anchors from which a string is hot
RANGE_ROWS, RUN_ROWS, GROUP_ROWS, HOT = 50_000, 30_000, 10_000, 20_000
BATCH_ROWS, BATCH_BYTES, CHUNK = 4_000, 8 << 20, 1 << 21

_BASE = 0x9E3779B97F4A7C15
_HEAD = 8  # bytes of the hash that a suffix begins with
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        def of(x):
            p = np.full(n, x, np.uint64)
            p[0] = 1
            return np.multiply.accumulate(p)

        have = _powers[0] = of(_BASE), of(pow(_BASE, -1, 1 << 64))
    return have


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the `gram` bytes from each place on, from differences of one running sum."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[:len(data) - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def least_in_windows(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, from minima towards block borders in both directions."""
    padded = np.concatenate([h, np.full(-len(h) % width, 2**64 - 1, np.uint64)]).reshape(-1, width)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(h) - width + 1
    return np.minimum(back[:n], forward[width - 1:width - 1 + n])


def anchors(data: np.ndarray, valid: np.ndarray, length: int, gram: int) -> tuple:
    """hash, place, and the first and last window that picked it, of each anchor.

    `valid` says for each window, by where it starts, whether it counts.
    """
    h, width = gram_hashes(data, gram), length - gram + 1
    least = least_in_windows(h, width)
    cut = np.flatnonzero((least[1:] != least[:-1]) | (valid[1:] != valid[:-1])) + 1
    first, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(least)]])
    first, end = first[valid[first]], end[valid[first]]
    views = sliding_window_view(h, width)
    at = np.concatenate([first[:0]] + [
        first[a:a + 4096] + views[first[a:a + 4096]].argmin(axis=1)
        for a in range(0, len(first), 4096)])
    ties = np.flatnonzero(end > at + 1)  # the least hash occurs again behind the anchor
    if len(ties):
        parts = [(first, np.minimum(end, at + 1), at)]
        for i in ties:
            s, e = at[i] + 1, end[i]
            again = s + np.flatnonzero(h[s:e + width - 1] == least[first[i]])
            starts = np.concatenate([[s], again[:-1] + 1])
            stops = np.minimum(again + 1, e)
            some = starts < stops
            parts.append((starts[some], stops[some], again[some]))
        first, end, at = (np.concatenate(x) for x in zip(*parts))
    # minima are small numbers; ranges need them spread evenly again
    h = h[at] * np.uint64(0xC2B2AE3D27D4EB4F)
    return (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B185EBCA87), at, first, end - 1


def anchor_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int
                ) -> Iterator[pa.RecordBatch]:
    """key, text -> key, hash and lists at, far, near: the places of a string that is an anchor in the
    text, and how far before each the first and the last window that picked it begin.

    Texts of a batch are worked on together, in chunks of windows, so a long text needs no more
    memory than many short ones."""
    for rows in rows_in(batches, BATCH_ROWS, BATCH_BYTES):
        texts = rows["text"].combine_chunks().cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:][:len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0]:ends[-1]]
        ends = ends - ends[0]
        keys = rows["key"].to_numpy()
        edge = np.zeros(len(data) + 1, np.int32)
        long = np.diff(ends) >= length
        edge[ends[:-1][long]] += 1
        edge[ends[1:][long] - length + 1] -= 1
        valid = np.cumsum(edge[:-1]).astype(bool)
        for c in range(0, len(data) - length + 1, CHUNK):
            piece = data[c:c + CHUNK + length - 1]
            ok = valid[c:c + len(piece) - length + 1]
            if not ok.any():
                continue
            h, at, first, last = anchors(piece, ok, length, gram)
            doc = np.searchsorted(ends, at + c, side="right") - 1
            order = np.lexsort((h, doc))
            h, doc, at, first, last = (x[order] for x in (h, doc, at, first, last))
            head = np.flatnonzero(np.diff(h, prepend=h[:1] + np.uint64(1)) | np.diff(doc, prepend=-1)
                                  .astype(np.uint64))
            cuts = pa.array(np.append(head, len(h)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[doc[head]]), pa.array(h[head].view(np.int64)),
                 pa.ListArray.from_arrays(cuts, pa.array(at + c - ends[doc])),
                 pa.ListArray.from_arrays(cuts, pa.array((at - first).astype(np.int32))),
                 pa.ListArray.from_arrays(cuts, pa.array((at - last).astype(np.int32)))],
                names=["key", "hash", "at", "far", "near"])


def common_prefixes(strings: list[bytes], width: int) -> np.ndarray:
    """Length of the prefix that each string shares with the one before."""
    out = np.zeros(len(strings), np.int32)
    for a in range(1, len(strings), 20_000):
        part = strings[a - 1:a + 20_000]
        wide = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in part), np.uint8)
        same = wide.reshape(-1, width)
        differ = same[1:] != same[:-1]
        sizes = np.fromiter(map(len, part), np.int32, len(part))
        n = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        out[a:a + len(part) - 1] = np.minimum(n, np.minimum(sizes[1:], sizes[:-1]))
    return out


def front_coded(strings: list[bytes], width: int) -> tuple[bytes, bytes, bytes]:
    """Shared prefix lengths, lengths of the rest, and the rests of sorted strings."""
    shared = common_prefixes(strings, width)
    sizes = np.fromiter(map(len, strings), np.int32, len(strings)) - shared
    return (shared.astype("<u2").tobytes(), sizes.astype("<u2").tobytes(),
            b"".join([s[n:] for s, n in zip(strings, shared.tolist())]))


def decoded(shared: bytes, sizes: bytes, rest: bytes) -> Iterator[tuple[bytes, int]]:
    """The strings again, each with the prefix length it shares with the one before."""
    last, at = b"", 0
    for n, size in zip(np.frombuffer(shared, "<u2").tolist(), np.frombuffer(sizes, "<u2").tolist()):
        last = last[:n] + bytes(rest[at:at + size])
        at += size
        yield last, n


def prefix_from(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of two strings that agree before `start`."""
    end = min(len(a), len(b))
    for i in range(start, end, 64):
        x, y = a[i:min(i + 64, end)], b[i:min(i + 64, end)]
        if x != y:
            differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return i + len(x) - (differ.bit_length() + 7) // 8
    return end


def merged(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[int, bytes, int]]:
    """Merge sorted runs: the run, the string, and the prefix it shares with the string before.

    A node keeps the run that lost there and the prefix its string shares with the last winner that
    passed. Against the same winner a longer shared prefix means a smaller string, so only equal
    lengths look at characters, and only at those behind the prefix."""
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    heads: list[bytes | None] = [next(r, (None, 0))[0] for r in runs] + [None] * (leaves - len(runs))
    shared = [0] * leaves
    loser = [0] * leaves

    def play(x: int, y: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix is set to what it shares with the winner."""
        a, b = heads[x], heads[y]
        if a is None or b is None:
            return (y, x) if a is None else (x, y)
        if shared[x] != shared[y]:
            return (x, y) if shared[x] > shared[y] else (y, x)
        n = prefix_from(a, b, shared[x])
        if n == len(a) or (n < len(b) and a[n] < b[n]):
            shared[y] = n
            return x, y
        shared[x] = n
        return y, x

    winner = list(range(leaves)) * 2
    for node in range(leaves - 1, 0, -1):
        winner[node], loser[node] = play(winner[2 * node] if 2 * node < leaves else 2 * node - leaves,
                                         winner[2 * node + 1] if 2 * node < leaves
                                         else 2 * node + 1 - leaves)
    best = winner[1] if leaves > 1 else 0
    while heads[best] is not None:
        yield best, heads[best], shared[best]
        heads[best], shared[best] = next(runs[best], (None, 0))
        node = (best + leaves) // 2
        while node:
            best, loser[node] = play(best, loser[node])
            node //= 2


def run_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int, ranges: int
             ) -> Iterator[pa.RecordBatch]:
    """row_id, text, found -> runs (per range), records' places (rec, row_id, at), and digests of
    the windows of hot strings (rec, far, digest)."""
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 40
    known: dict[tuple, dict[int, list]] = {}

    def copies(record):
        return min(sum(map(len, known[record].values())), 2)

    def out(**columns):
        n = max(len(v) for v in columns.values())
        return pa.RecordBatch.from_arrays(
            [pa.array(columns.get(f.name) if f.name in columns else [None] * n, type=f.type)
             for f in RUN_SCHEMA], schema=RUN_SCHEMA)

    def flush():
        nonlocal base
        order = sorted(known)
        ids = {record: base + i for i, record in enumerate(order)}
        base += len(order)
        for a in range(0, len(order), RUN_ROWS):
            some = order[a:a + RUN_ROWS]
            yield out(rec=[ids[r] for r in some for _ in known[r]],
                      row_id=[row for r in some for row in known[r]],
                      at=[places for r in some for places in known[r].values()])
        cold = [r for r in order if not r[4]]
        where = [int.from_bytes(r[0][:_HEAD], "big") * ranges >> 64 for r in cold]
        cuts = np.flatnonzero(np.diff(where, prepend=-1, append=ranges)).tolist()
        for a, b in zip(cuts, cuts[1:]):
            part = cold[a:b]
            right = front_coded([r[0] for r in part], length + _HEAD)
            left = front_coded([r[1] for r in part], length)
            numbers = np.array([[ids[r], r[2], r[3], copies(r)] for r in part], "<i8")
            yield out(range=[where[a]], right=[list(right)], left=[list(left)],
                      numbers=[numbers.T.tobytes()])
        for r in order:
            if r[4]:
                # the text around the anchor; the windows are those the anchor was picked by
                around = r[1][::-1] + r[0][_HEAD:]
                far = list(range(r[3], r[2] + 1))
                yield out(rec=[ids[r]] * len(far), far=far, copies=[copies(r)] * len(far),
                          digest=[hashlib.blake2b(around[r[2] - d:r[2] - d + length],
                                                  digest_size=16).digest() for d in far])
        known.clear()

    for rows in rows_in(batches, BATCH_ROWS, BATCH_BYTES):
        for row, text, found in zip(rows["row_id"].to_pylist(), rows["text"].to_pylist(),
                                    rows["found"].to_pylist()):
            text = text.encode()
            for f in found:
                # as unsigned, so the order is that of the bytes
                head = (f["hash"] & 0xFFFFFFFFFFFFFFFF).to_bytes(_HEAD, "big")
                for at, far, near in zip(f["at"], f["far"], f["near"]):
                    if at < far or at - near + length > len(text):
                        continue  # another text with the same key
                    record = (head + text[at:at + length - near], text[at - far:at][::-1], far, near,
                              f["hot"])
                    known.setdefault(record, {}).setdefault(row, []).append(at)
            if len(known) >= RUN_ROWS:
                yield from flush()
    yield from flush()


_CODED = pa.list_(pa.binary())
RUN_SCHEMA = pa.schema([
    ("range", pa.int32()), ("right", _CODED), ("left", _CODED), ("numbers", pa.binary()),
    ("rec", pa.int64()), ("row_id", pa.int64()), ("at", pa.list_(pa.int64())),
    ("far", pa.int32()), ("copies", pa.int32()), ("digest", pa.binary())])
_RUNS = ("range int, right array<binary>, left array<binary>, numbers binary, rec long, row_id long, "
         "at array<long>, far int, copies int, digest binary")


def repeated_in_range(right: np.ndarray, lefts: list[bytes], far: np.ndarray, near: np.ndarray,
                      copies: np.ndarray, length: int) -> np.ndarray:
    """For records in merged order, which windows (row, bytes before the anchor) occur again.

    `right` is the prefix each suffix shares with the one before, hash included."""
    n, width = len(lefts), int(far.max()) + 1
    heads = np.cumsum(right < _HEAD + 1)  # other hash: other string
    order = sorted(range(n), key=lambda i: (heads[i], lefts[i]))
    left = common_prefixes([lefts[i] for i in order], max(1, width))
    left[np.flatnonzero(np.diff(heads[order], prepend=0))] = -1
    order = np.array(order)
    out = np.zeros((n, width), bool)
    klass = np.empty(n, np.int64)
    for d in range(width):
        inside = np.flatnonzero((near <= d) & (d <= far))
        if not len(inside):
            continue
        klass[order] = np.cumsum(left < d)
        pair = klass[inside] * n + np.cumsum(right < _HEAD + length - d)[inside]
        _, at = np.unique(pair, return_inverse=True)
        out[inside, d] = np.bincount(at, weights=copies[inside])[at] > 1
    return out


def merge_rows(key, table: pa.Table, length: int) -> pa.Table:
    """All runs of a range -> rec, low, high: the last and the first repeated window, by the bytes
    that they begin before the anchor. Windows of one anchor overlap, so these two bound what goes.

    Runs stay front-coded. The merge decodes a string of each at a time, and records are worked on in
    groups of whole anchor strings, so memory is the runs and a group."""
    runs = [[b.as_buffer() for b in r] for r in table["right"]]
    lefts = [decoded(*[b.as_buffer() for b in r]) for r in table["left"]]
    numbers = [np.frombuffer(b.as_buffer(), "<i8").reshape(4, -1) for b in table["numbers"]]
    places = [0] * len(runs)
    out = []
    right: list[int] = []
    left: list[bytes] = []
    every: list[tuple] = []

    def close():
        out.append(repeated_windows(np.array(right), left, np.array(every), length))
        right.clear()
        left.clear()
        every.clear()

    for run, _, shared in merged([decoded(*r) for r in runs]):
        if shared < _HEAD and len(right) >= GROUP_ROWS:
            close()
        right.append(shared)
        left.append(next(lefts[run])[0])
        every.append(numbers[run][:, places[run]])
        places[run] += 1
    if right:
        close()
    return pa.concat_tables(out) if out else SPAN_SCHEMA.empty_table()


def repeated_windows(right: np.ndarray, lefts: list[bytes], every: np.ndarray, length: int
                     ) -> pa.Table:
    # strings of one record and one copy have nothing to meet
    heads = np.cumsum(right < _HEAD + 1)
    several = np.bincount(heads, weights=every[:, 3])[heads] > 1
    some = np.flatnonzero(several)
    if not len(some):
        return SPAN_SCHEMA.empty_table()
    # leaving out whole strings keeps the prefixes of the others, whose first shares no string
    found = repeated_in_range(right[some], [lefts[i] for i in some], every[some, 1], every[some, 2],
                              every[some, 3], length)
    hit = np.flatnonzero(found.any(axis=1))
    low = found[hit].argmax(axis=1)
    high = found.shape[1] - 1 - found[hit][:, ::-1].argmax(axis=1)
    return pa.table({"rec": every[some, 0][hit], "low": low.astype(np.int32),
                     "high": high.astype(np.int32)}, schema=SPAN_SCHEMA)


SPAN_SCHEMA = pa.schema([("rec", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])


def cut_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """text, spans -> the text's digest and what is left of it."""
    for rows in rows_in(batches, BATCH_ROWS, BATCH_BYTES):
        whole, removed, runs, kept = [], [], [], []
        for text, spans in zip(rows["text"].to_pylist(), rows["spans"].to_pylist()):
            text = text.encode()
            gone = merged_spans(spans, length)
            left = hashlib.sha256()
            end = 0
            for start, stop in gone:
                left.update(text[end:start])
                end = stop
            left.update(text[end:])
            whole.append(hashlib.sha256(text).digest())
            removed.append(sum(stop - start for start, stop in gone))
            runs.append(len(gone))
            kept.append(left.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(whole, pa.binary()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
             pa.array(kept, pa.string())], names=["whole", "n_removed", "n_spans", "kept_sha256"])


def merged_spans(spans: list[dict], length: int) -> list[tuple[int, int]]:
    """Disjoint byte ranges, in order, of the windows around anchors; touching ones are one."""
    at = [np.array(s["at"], np.int64) for s in spans]
    start = np.concatenate([a - s["high"] for a, s in zip(at, spans)])
    stop = np.concatenate([a - s["low"] + length for a, s in zip(at, spans)])
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    first = np.flatnonzero(np.append(True, start[1:] > stop[:-1]))
    return list(zip(start[first].tolist(), stop[np.append(first[1:], len(stop)) - 1].tolist()))


def spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """text, spans (anchors' places, and how far before them the last and the first repeated window
    begins): the texts that hold repeated windows. Equal texts may come more than once, each time with
    all their spans."""
    texts = docs.select(F.xxhash64("text").alias("key"), "text").filter(
        F.octet_length("text") >= length)
    found = stored(texts.mapInArrow(lambda b: anchor_rows(b, length, gram),
                                    "key long, hash long, at array<long>, far array<int>, "
                                    "near array<int>"),
                   "suffix-anchors")
    again = found.groupBy("hash").agg(F.sum(F.size("at")).alias("n")).filter("n > 1")
    flagged = found.join(again, "hash").groupBy("key").agg(F.collect_set(F.struct(
        "hash", "at", "far", "near", (F.col("n") > hot).alias("hot"))).alias("found"))
    picked = stored(numbered(texts.hint("merge").join(flagged.hint("merge"), "key")
                             .select("text", "found")), "suffix-texts")
    n = picked.agg(F.sum(F.aggregate("found", F.lit(0), lambda n, f: n + F.size(f["at"])))).first()[0]
    ranges = 1 + min((n or 0) // RANGE_ROWS, 2 * int(docs.sparkSession.conf.get(
        "spark.sql.shuffle.partitions")))
    runs = stored(picked.select("row_id", "text", "found").mapInArrow(
        lambda b: run_rows(b, length, gram, ranges), _RUNS), "suffix-runs")
    cold = (runs.filter("range is not null").select("range", "right", "left", "numbers")
            .repartition(ranges, "range").groupBy("range").applyInArrow(lambda k, t: merge_rows(k, t, length),
                                           "rec long, low int, high int"))
    windows = runs.filter("digest is not null").select("rec", "far", "copies", "digest")
    twice = windows.groupBy("digest").agg(F.sum("copies").alias("n")).filter("n > 1")
    warm = windows.join(twice, "digest").groupBy("rec").agg(F.min("far").alias("low"),
                                                            F.max("far").alias("high"))
    places = runs.filter("row_id is not null").select("rec", "row_id", "at")
    each = places.join(cold.unionByName(warm), "rec").groupBy("row_id").agg(
        F.collect_list(F.struct("at", "low", "high")).alias("spans"))
    return picked.select("row_id", "text").join(each, "row_id").select("text", "spans")


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                 hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("whole"))
    cut = spans(docs, length, gram, hot).mapInArrow(
        lambda b: cut_rows(b, length), "whole binary, n_removed long, n_spans long, kept_sha256 string")
    cut = cut.dropDuplicates(["whole"])
    zero = F.lit(0).cast("long")
    return whole.join(cut, "whole", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", F.lower(F.hex("whole"))).alias("kept_sha256"))
