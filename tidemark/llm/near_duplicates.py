"""Near-duplicates by order MinHash, verified by banded alignment.

The items of a text are its words, labelled with how often the same word came before. Each hash
function of a tier picks the smallest items; their order in the text goes into the sketch, so two
texts agree on a sketch if they share the items in the same order. An edit touches one item whatever
stands beside it: texts at the limit of 20 % edits share two thirds of the items of both wherever the
edits are, and a tier (`TIERS`) has enough hash functions to find such a pair in more than 99 of 100
cases. Texts near the border of two tiers have the sketches of both. Texts that share a
sketch are candidates. A candidate pair becomes a link if the word edit distance, aligned inside a
band no wider than the allowed edits, is at most 20 % of the longer text.

Equal texts (same words) are one node from the start. Each text is first compared with one leader of
its buckets, which joins most of a large group. Where a bucket still holds several classes, all its
pairs of different classes are candidates, in blocks of `BLOCK` by `BLOCK` texts that Spark shuffles;
what the numbers of words, or of words in each of `BINS` bins, show to be too far apart is left out,
as no alignment can bring it back; long texts, which fill those bins evenly, are also compared by about
`FINE` times as many bins as they have words. Of buckets with the same texts one is used, and a pair
comes from one bucket only. The `NEAREST` of each text are aligned before the rest, so that
most pairs of the last round are in one class by then and need no alignment. No bucket is capped.
Classes are the connected components, found by contracting edges.

Defined results: texts without words (null, empty) are linked to nothing and each is its own class;
repeated rows and equal texts share a class; a null id is kept as a row but never names a class
that has another id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, numbered, rows_in, rows_of_files, stored
from .decontaminate import words_of

#: words of the longer text from which a tier holds, items picked, hash functions
TIERS = ((0, 3, 40), (40, 4, 56))
SIMILARITY = 0.8
BLOCK, BINS, FINE, NEAREST = 256, 256, 1, 1
BATCH_ROWS, BATCH_BYTES = 1_000, 1 << 20
#: words whose hashes a task remembers
KNOWN = 100_000
#: words that a round of comparisons may move, in terms of those of all texts
MOVED = 1.5
#: share of all words from which texts that share a bucket are not stored apart from the others
MOST = 0.5

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> _SHIFT)) * _M1
    x = (x ^ (x >> _SHIFT)) * _M2
    return x ^ (x >> _SHIFT)


SEEDS = [mixed_bits(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(t << 32))
         for t, (_, _, n) in enumerate(TIERS)]
#: a hash function of 32-bit items: what they are crossed with, and the odd number they are multiplied by
CROSSED = [s.astype(np.uint32) for s in SEEDS]
FACTORS = [(s >> np.uint64(32)).astype(np.uint32) | np.uint32(1) for s in SEEDS]
LAST = np.uint32(0xFFFFFFFF)


def occurrence_labels(values: np.ndarray) -> np.ndarray:
    """How often each value came before in the array."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    places = np.arange(len(values))
    labels = np.empty(len(values), dtype=np.uint64)
    labels[order] = places - np.maximum.accumulate(np.where(head, places, 0))
    return labels


def sketches(words: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """One 64-bit number per hash function of its tiers for the word hashes of a text that has
    words. A tier holds every text whose longer partner may be in it."""
    items = mixed_bits(words.astype(np.uint64) + np.uint64(1))
    labelled = items + occurrence_labels(items) * np.uint64(0xD6E8FEB86659FD93)
    labelled = (labelled >> np.uint64(32)).astype(np.uint32)
    out = []
    for t, (start, picked, _) in enumerate(TIERS):
        end = TIERS[t + 1][0] if t + 1 < len(TIERS) else len(items) + 1
        if not start * similarity - 1e-9 <= len(items) < end:
            continue
        picked = min(picked, len(items))
        step = max(1, (1 << 16) // len(items))  # hash functions at a time: bounded memory
        for a in range(0, len(SEEDS[t]), step):
            key = SEEDS[t][a:a + step]
            values = (labelled ^ CROSSED[t][a:a + step, None]) * FACTORS[t][a:a + step, None]
            least = np.empty((len(key), picked), np.int64)
            for column in range(picked):
                least[:, column] = at = values.argmin(axis=1)
                values[np.arange(len(key)), at] = LAST
            least.sort(axis=1)  # the order in the text
            for column in range(picked):
                key = mixed_bits(key + items[least[:, column]])
            out.append(key)
    return np.concatenate(out)


def bag_of(words: np.ndarray) -> np.ndarray:
    """How many words fall into each of BINS bins by their hashes, at most 255."""
    bins = (words.astype(np.uint64) * np.uint64(2654435761) & np.uint64(0xFFFFFFFF)) * \
        np.uint64(BINS) >> np.uint64(32)
    return np.minimum(np.bincount(bins.astype(np.int64), minlength=BINS), 255).astype(np.uint8)


def fine_bag_of(words: np.ndarray) -> bytes:
    """How many words, at most 255, fall into each of about `FINE` bins a word, compressed, as most are
    empty; nothing for a text that `bag_of` tells apart as well."""
    if len(words) <= BINS:
        return b""
    bits = min((FINE * len(words) - 1).bit_length(), 18)
    bins = (words.astype(np.uint64) * np.uint64(2654435761) & np.uint64(0xFFFFFFFF)) >> \
        np.uint64(32 - bits)
    counts = np.bincount(bins.astype(np.int64), minlength=1 << bits)
    return bytes([bits]) + pa.compress(np.minimum(counts, 255).astype(np.uint8).tobytes(), "zstd",
                                       asbytes=True)


def fine_bins(bag: bytes) -> np.ndarray:
    if not bag:
        return np.zeros(0, np.uint8)
    return np.frombuffer(pa.decompress(bag[1:], 1 << bag[0], "zstd"), np.uint8)


def folded(bins: np.ndarray, size: int) -> np.ndarray:
    """The same text's counts in fewer bins."""
    bins = bins.astype(np.int16)
    while len(bins) > size:
        bins = np.minimum(bins[::2] + bins[1::2], 255)
    return bins


def fine_apart(x: np.ndarray, y: np.ndarray) -> int:
    """The edits that fine bins need at least."""
    size = min(len(x), len(y))
    d = folded(x, size) - folded(y, size)
    more = int(np.maximum(d, 0).sum(dtype=np.int64))
    return max(more, more - int(d.sum(dtype=np.int64)))


def sketch_rows(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, int] = {}
    for rows in rows_in(batches, BATCH_ROWS, BATCH_BYTES):
        digest, signs, bags, fine, sequence, size = [], [], [], [], [], []
        if len(known) > KNOWN:
            known.clear()
        for text in rows["text"].to_pylist():
            words = words_of(text)
            for w in set(words).difference(known):
                known[w] = zlib.crc32(w)
            hashed = np.fromiter(map(known.__getitem__, words), dtype=np.uint32, count=len(words))
            digest.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest()
                          if words else None)
            signs.append(sketches(hashed, similarity).view(np.int64) if words else None)
            size.append(len(words))
            bags.append(bag_of(hashed).tobytes())
            fine.append(fine_bag_of(hashed))
            sequence.append(packed(hashed))
        yield pa.RecordBatch.from_arrays(
            [rows["row_id"].combine_chunks(), rows["doc_id"].combine_chunks(),
             pa.array(digest, type=pa.binary()), pa.array(signs, type=pa.list_(pa.int64())),
             pa.array(size, type=pa.int32()), pa.array(bags, type=pa.binary()),
             pa.array(fine, type=pa.binary()), pa.array(sequence, type=pa.binary())],
            names=["row_id", "doc_id", "digest", "signs", "size", "bag", "fine", "words"])


def packed(words: np.ndarray) -> bytes:
    """Words of a text for a shuffle: half the bytes of the numbers."""
    return len(words).to_bytes(4, "little") + pa.compress(words.tobytes(), "zstd", asbytes=True)


def unpacked(column) -> list[np.ndarray]:
    """Each text of a run of equal ones is unpacked once."""
    out, last, words = [], None, None
    for value in column:
        raw = value.as_buffer()
        if last is None or raw != last:
            last = raw
            n = int.from_bytes(raw[:4].to_pybytes(), "little")
            words = np.frombuffer(pa.decompress(raw[4:], 4 * n, "zstd"), np.uint32)
        out.append(words)
    return out


def shared_words(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the common multiset of two sequences."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(n[i], m[j]).sum())


def banded_distance(a: list[int], b: list[int], limit: int) -> int:
    """The word edit distance if it is at most `limit`, else some number above it.

    Row by row of b, the differences between neighbouring cells of the alignment table are the bits
    of two integers (one step up, one step down), so a row costs a few integer operations. Only
    cells at most `limit` off the diagonal are kept: beyond its edges the table is taken to rise,
    which no alignment of at most `limit` edits notices. Lengths differ by at most `limit`.
    """
    low, high, top = 0, min(len(a), limit), 0  # rows low < i <= high; value at row low
    rise, fall = (1 << high) - 1, 0
    places: dict[int, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    for j, w in enumerate(b, 1):
        if j - limit > low + 1 and low < high:
            top += (rise & 1) - (fall & 1)
            rise, fall, low = rise >> 1, fall >> 1, low + 1
        if high < len(a) and high < j + limit:
            rise |= 1 << (high - low)
            high += 1
        inside = (1 << (high - low)) - 1
        equal = places.get(w, 0) >> low & inside
        level = equal | fall
        across = (((equal & rise) + rise) ^ rise) | equal
        up = (fall | ~(across | rise)) << 1 | 1
        down = (rise & across) << 1
        rise = (down | ~(level | up)) & inside
        fall = up & level & inside
        top += 1
    return top + rise.bit_count() - fall.bit_count()


def edits_within(a: np.ndarray, b: np.ndarray, limit: int) -> bool:
    """Whether at most `limit` inserted, deleted or replaced words turn a into b.

    Equal beginnings and ends are cut off first. Few words replaced in place, or too few words in
    common, decide without an alignment.
    """
    if abs(len(a) - len(b)) > limit:
        return False
    n = min(len(a), len(b))
    if not n:
        return True
    differ = np.flatnonzero(a[:n] != b[:n])
    if len(differ) + abs(len(a) - len(b)) <= limit:
        return True
    if max(len(a), len(b)) - shared_words(a, b) > limit:
        return False
    a, b = a[differ[0]:], b[differ[0]:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
    end = int(differ[0]) if len(differ) else n
    a, b = a[:len(a) - end], b[:len(b) - end]
    return banded_distance(a.tolist(), b.tolist(), limit) <= limit


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    longest = max(len(a), len(b))
    return edits_within(a, b, int(longest * (1 - similarity) + 1e-9))


def verify_rows(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [similar(x, y, similarity) for x, y in zip(
            unpacked(batch.column("words_a")), unpacked(batch.column("words_b")))]
        keep = pa.array(keep, type=pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])


def by_key(df: DataFrame) -> DataFrame:
    """A side that grows with the data: shuffled by the key of the join."""
    return df.hint("merge")


def near_in_size(x: Column, y: Column, similarity: float) -> Column:
    """Whether the numbers of words leave room for the similarity: each word more is an edit."""
    return F.abs(x - y) <= F.floor(F.greatest(x, y) * F.lit(1 - similarity) + F.lit(1e-9))


def pair(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def first_pairs(keys: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Each node with one leader, the one that leads most of its buckets: that joins most groups.

    Leaders are the least nodes by a hash, the same order in every bucket, so the buckets of one
    large group lead to the same few pairs; they are aggregated before the shuffle.
    """
    leader = F.col("leader")
    leaders = keys.groupBy("key").agg(F.count("*").alias("n"), F.min_by(
        F.struct("node", "size"), F.xxhash64(F.lit(0), "node")).alias("leader")).filter("n > 1")
    met = keys.join(leaders, "key").filter(
        (F.col("node") != leader["node"]) & near_in_size(F.col("size"), leader["size"], similarity)
    ).groupBy("node", F.col("leader.node").alias("leader")).agg(F.count("*").alias("n"))
    pairs = met.groupBy("node").agg(F.max_by("leader", F.struct(
        "n", F.xxhash64(F.lit(1), "leader"))).alias("leader")).select(
        *pair(F.col("node"), F.col("leader"))).distinct()
    a, b = (texts.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"),
                         F.col("bag").alias(f"bag_{c}")) for c in "ab")
    return pairs.join(a, "a").join(b, "b").mapInArrow(
        lambda batches: near_in_bags(batches, similarity), "a long, b long")


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The edits that bags (rows of int16) need at least."""
    d = x - y
    more = np.maximum(d, 0).sum(axis=1, dtype=np.int64)
    return np.maximum(more, more - d.sum(axis=1, dtype=np.int64))


def bags_in(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16)


def bags_of(bags: list[bytes | None], fine: list[bytes]) -> np.ndarray:
    """Bags as rows of int16; a text with fine bins is sent without its bag, which they fold to."""
    out = np.empty((len(bags), BINS), np.int16)
    for i, (bag, bins) in enumerate(zip(bags, fine)):
        out[i] = np.frombuffer(bag, np.uint8) if bag is not None else folded(fine_bins(bins), BINS)
    return out


def near_in_bags(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        longest = np.maximum(*(batch.column(f"size_{c}").to_numpy() for c in "ab"))
        keep = pa.array(apart(*(bags_in(batch.column(f"bag_{c}")) for c in "ab"))
                        <= np.floor(longest * (1 - similarity) + 1e-9))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])


def block_pairs(block: dict[str, np.ndarray], same: bool, nearest: int | None, similarity: float
                ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Nodes of the pairs of different classes that the words in the bins leave room for.

    Inside one salt (`same`) each pair once, else each node of the lower salt with each of the
    higher. With `nearest`, only so many of each node, those that differ least in the bins; without,
    a pair comes from the block of the least key that both have, and from no other.
    """
    keys, shared = block.get("keys"), {}

    def starts_here(i: int, j: int) -> bool:
        for k in (i, j):
            if k not in shared:
                shared[k] = frozenset(keys[k])
        return min(shared[i] & shared[j]) == block["key"]

    root, size, node, salt = (block[c] for c in ("root", "size", "node", "salt"))
    bags, fine = block["bag"], {}

    def near_in_fine(i: int, j: int, limit: float) -> bool:
        for k in (i, j):
            if k not in fine:
                fine[k] = fine_bins(block["fine"][k])
        return not (len(fine[i]) and len(fine[j])) or fine_apart(fine[i], fine[j]) <= limit

    left = np.arange(len(node)) if same else np.flatnonzero(salt == salt.min())
    right = left if same else np.flatnonzero(salt != salt.min())
    for at in range(0, len(left), 64):
        some = left[at:at + 64]
        limit = np.floor(np.maximum(size[some, None], size[right]) * (1 - similarity) + 1e-9)
        open_ = (root[some, None] != root[right]) & \
            (np.abs(size[some, None] - size[right]) <= limit)
        if same and nearest is None:
            open_ &= right > some[:, None]
        x, y = np.nonzero(open_)
        if not len(x):
            continue
        edits = np.empty(len(x), np.int64)
        for k in range(0, len(x), 8192):
            edits[k:k + 8192] = apart(bags[some[x[k:k + 8192]]], bags[right[y[k:k + 8192]]])
        near = edits <= limit[x, y]
        x, y, edits = x[near], y[near], edits[near]
        if nearest is not None and len(x):
            order = np.lexsort((y, edits, x))
            x, y = x[order], y[order]
            first = np.flatnonzero(np.diff(x, prepend=-1))
            rank = np.arange(len(x)) - np.repeat(first, np.diff(first, append=len(x)))
            x, y = x[rank < nearest], y[rank < nearest]
        elif keys is not None:
            once = np.array([starts_here(some[i], right[j]) for i, j in zip(x, y)], bool)
            x, y = x[once], y[once]
        near = np.array([near_in_fine(some[i], right[j], limit[i, j]) for i, j in zip(x, y)], bool)
        yield node[some[x[near]]], node[right[y[near]]]


def pair_rows(batches: Iterator[pa.RecordBatch], nearest: int | None, similarity: float
              ) -> Iterator[pa.RecordBatch]:
    """key, low, high, salt, node, root, size, bag, fine, keys sorted by block (key, low, high) -> a, b."""
    def pairs_of(block: pa.Table) -> Iterator[pa.RecordBatch]:
        if block.num_rows < 2:
            return
        held = {c: block[c].to_numpy() for c in ("salt", "node", "root", "size")}
        if held["root"].min() == held["root"].max():
            return
        same = block["low"][0].as_py() == block["high"][0].as_py()
        if not same and held["salt"].min() == held["salt"].max():
            return
        held["fine"] = block["fine"].to_pylist()
        held["bag"] = bags_of(block["bag"].to_pylist(), held["fine"])
        if nearest is None:
            held["key"], held["keys"] = block["key"][0].as_py(), block["keys"].to_pylist()
        for a, b in block_pairs(held, same, nearest, similarity):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    held: list[pa.RecordBatch] = []  # rows of the block at hand
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([batch.column(c).to_numpy() for c in ("key", "low", "high")])
        starts = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1).tolist()]
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            block = tuple(at[:, start].tolist())
            if block != last and held:
                yield from pairs_of(pa.Table.from_batches(held))
                held = []
            last = block
            held.append(batch.slice(start, end - start))
    if held:
        yield from pairs_of(pa.Table.from_batches(held))


def other_pairs(keys: DataFrame, roots: DataFrame, texts: DataFrame, similarity: float,
                nearest: int | None = None) -> DataFrame:
    """The pairs left to align in buckets that hold several classes so far: all of different
    classes that sizes and bags leave room for, or with `nearest` only that many of each node in a
    block."""
    rooted = keys.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # buckets of the same texts give the same pairs: one of them is enough
    mixed = rooted.groupBy("key").agg(
        F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"),
        F.bit_xor(F.xxhash64("node")).alias("one"), F.bit_xor(F.xxhash64(F.lit(9), "node")).alias("two")
    ).filter("low < high").groupBy("n", "one", "two").agg(F.min("key").alias("key")).select(
        "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("salts"))
    # a text has at most as many keys as hash functions
    member = rooted.join(mixed, "key").groupBy("node").agg(
        F.first("root").alias("root"), F.first("size").alias("size"),
        F.collect_list(F.struct("key", "salts")).alias("places")).join(
        texts.select("node", F.when(F.length("fine") == 0, F.col("bag")).alias("bag"), "fine"),  # as `bags_of`
        "node").withColumn("keys", F.col("places.key")).withColumn(
        "place", F.explode("places")).select("*", "place.key", "place.salts").withColumn(
        "salt", F.pmod(F.xxhash64(F.lit(7), "node"), F.col("salts")).cast("int"))
    blocks = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select(
        "key", F.least("salt", "other").alias("low"), F.greatest("salt", "other").alias("high"),
        "salt", "node", "root", "size", "bag", "fine", *(["keys"] if nearest is None else []))
    return blocks.repartition("key", "low", "high").sortWithinPartitions(
        "key", "low", "high").mapInArrow(
        lambda batches: pair_rows(batches, nearest, similarity), "a long, b long").distinct()


def linked(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose texts (node, words) are similar, stored.

    Texts are compared where the second join has put them: each pair moves one text, once. Many pairs of
    long texts would move far more than there is, so the pairs are taken in rounds of at most about
    `MOVED` times the words of all texts; a round's shuffle files go with it. A round has the pairs of
    some first texts, and only those texts are moved to them."""
    a, b = (texts.select(F.col("node").alias(c), F.col("words").alias(f"words_{c}")) for c in "ab")
    moved = pairs.groupBy("a").count().join(texts.select(F.col("node").alias("a"), "size"), "a").agg(
        F.sum(F.col("count") * F.col("size"))).first()[0]
    held = texts.agg(F.sum("size")).first()[0]
    rounds = 1 + int((moved or 0) // (MOVED * max(1, held or 0)))
    out = None
    for i in range(rounds):
        # in a single round both sides are all texts, which are then shuffled once for both
        some, firsts = (x.filter(F.pmod(F.xxhash64(F.lit(2), "a"), F.lit(rounds)) == i) if rounds > 1
                        else x for x in (pairs, a))
        found = stored(by_key(by_key(some).join(by_key(firsts), "a")).join(by_key(b), "b").mapInArrow(
            lambda batches: verify_rows(batches, similarity), "a long, b long"), "near-links")
        out = found if out is None else out.union(found)
    return out


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of an edge list (a, b): the smallest node of its component.

    Every node points to its smallest neighbour, pointers are followed twice, and the edges between
    different roots remain; their number at least halves each time and a star takes one step.
    """
    spark = edges.sparkSession
    made = Scratch(spark)  # of the step before
    with made:
        left = stored(edges.select("a", "b").filter("a <> b").distinct(), "near-edges")
        roots = stored(left.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn(
            "root", F.col("node")), "near-roots")
    while not left.isEmpty():
        with Scratch(spark) as now, Scratch(spark) as hooks:
            left, roots = contracted(left, roots)
        hooks.clear()
        made.clear()
        made = now
    out = stored(roots, "near-roots")
    made.clear()
    return out


def contracted(left: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One step: the edges between roots that are left, and every node's root."""
    both = left.union(left.select("b", "a"))
    hook = both.groupBy("a").agg(F.min("b").alias("to")).select(
        F.col("a").alias("from"), F.least("a", "to").alias("to"))
    hook = stored(hook, "near-hooks")
    for _ in range(2):
        ahead = hook.select(F.col("from").alias("to"), F.col("to").alias("next"))
        hook = hook.join(ahead, "to", "left").select(
            "from", F.coalesce("next", "to").alias("to"))
    hook = stored(hook, "near-hooks")
    roots = stored(roots.join(hook, F.col("root") == F.col("from"), "left").select(
        "node", F.coalesce("to", "root").alias("root")), "near-roots", temporary=False)
    at = [hook.select(F.col("from").alias(c), F.col("to").alias(f"{c}_to")) for c in "ab"]
    left = stored(left.join(at[0], "a").join(at[1], "b").select(
        F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).filter(
        "a <> b").distinct(), "near-edges", temporary=False)
    return left, roots


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", row_id: str | None = None,
            similarity: float = SIMILARITY) -> DataFrame:
    """row_id, doc_id, class_row, class_id for every row.

    class_row is the smallest row_id of the class, class_id its smallest document id. row_id names
    a stable row number of `docs`; without it rows are numbered here.
    """
    rows = docs.select(*([F.col(row_id).alias("row_id")] if row_id else []),
                       F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    with Scratch(docs.sparkSession) as made:
        placed = placed_rows(rows if row_id else numbered(rows), similarity)
    made.clear()
    named = placed.groupBy("class_row").agg(F.min("doc_id").alias("class_id"),
                                            F.count("*").alias("n_rows"))
    return placed.join(named, "class_row")


def placed_rows(rows: DataFrame, similarity: float) -> DataFrame:
    """row_id, doc_id, class_row of rows (row_id, doc_id, text), stored."""
    with Scratch(rows.sparkSession) as sketched:  # as large as the documents
        signed = stored(rows.select("row_id", "doc_id", "text").mapInArrow(
            lambda batches: sketch_rows(batches, similarity),
            "row_id long, doc_id long, digest binary, signs array<long>, size int, bag binary, "
            "fine binary, words binary"), "near-sketches")
    every = stored(signed.select("row_id", "doc_id", "digest"), "near-rows")
    copies = every.filter("digest is not null").groupBy("digest").agg(
        F.min("row_id").alias("node"))
    copies = stored(copies, "near-copies")
    # a node is the row number of one of its texts
    texts = signed.select(F.col("row_id").alias("node"), "signs", "size", "bag", "fine", "words")
    keys = texts.join(copies.select("node"), "node", "left_semi").select(
        "node", "size", F.explode("signs").alias("key"))
    # only texts that share a bucket are compared, and only those keys are stored
    keys = stored(keys.join(keys.groupBy("key").count().filter("count > 1").select("key"), "key",
                            "left_semi"), "near-shared")
    # the joins of pairs below shuffle texts: only those that can be in a pair, unless these are most
    # of the words, as choosing them moves all texts once and stores them again
    nodes = keys.select("node", "size").distinct()
    texts = texts.select("node", "bag", "fine", "size", "words")
    paired, held = (x.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] for x in (nodes, texts))
    if paired < MOST * held:
        texts = stored(by_key(texts).join(by_key(nodes.select("node")), "node", "left_semi"),
                       "near-texts")
        sketched.clear()
    tried = stored(first_pairs(keys, texts, similarity), "near-pairs")
    links = linked(tried, texts, similarity)
    roots = components(links)
    for nearest in (NEAREST, None):
        pairs = stored(other_pairs(keys, roots, texts, similarity, nearest).join(
            tried, ["a", "b"], "left_anti"), "near-pairs")
        tried = tried.union(pairs)
        more = linked(pairs, texts, similarity)
        if not more.isEmpty():
            links = links.union(more)
            roots = components(links)
    node = copies.join(roots, "node", "left").select(
        "digest", F.coalesce("root", "node").alias("root"))
    placed = every.join(node, "digest", "left").select(
        "row_id", "doc_id", F.coalesce("root", "row_id").alias("class_row"))
    placed = stored(placed, "near-classes", temporary=False)
    sketched.clear()
    return placed


def repeated_rows(placed: DataFrame) -> DataFrame:
    """row_id of all rows but one per class; the smallest document id stays (nulls last), then the
    smallest row number."""
    best = placed.groupBy("class_row").agg(F.min_by("row_id", F.struct(
        F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_id"))).alias("best"))
    return placed.join(best, "class_row").filter("row_id <> best").select("row_id")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text",
                similarity: float = SIMILARITY, in_files: bool = False) -> DataFrame:
    """The rows of `docs` without near-duplicates, all columns.

    in_files: `docs` is a table read from files, the same each time; its rows are not copied then."""
    rows = rows_of_files(docs) if in_files else None
    if rows is None:
        rows = stored(numbered(docs.select(F.struct("*").alias("row"))), "near-documents")
    flat = rows.select("row_id", F.col(f"row.{id}").alias("doc_id"),
                       F.col(f"row.{text}").alias("text"))
    with Scratch(docs.sparkSession) as made:
        repeated = repeated_rows(classes(flat, "doc_id", "text", "row_id", similarity))
        repeated = stored(repeated, "near-repeated", temporary=False)
    made.clear()
    return rows.join(repeated, "row_id", "left_anti").select("row.*")
