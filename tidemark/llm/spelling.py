"""Spelling variants: words one edit apart, found by probing edits against Bloom filters.

The vocabulary is counted by Spark. Which words are near each other is found without comparing
words: every word's neighbourhood of single edits is generated and probed against blocked Bloom
filters of the vocabulary, one filter per word length. A probe touches one block of 512 bits. Only
edits that the filter knows leave the task; a join with the vocabulary removes those that it knows
by mistake. Each pair is generated from one side: of two words of one length by the one with the
smaller code point at the edit, else by the longer one, which loses a code point.

The filters have `BITS` bits a word. A broadcast holds at most `ROUND_BLOCKS` blocks; a larger
vocabulary is probed in several rounds, so what is broadcast does not grow with it. Neighbourhoods are
hashed, not spelled: a polynomial over the code points changes by one term per replaced place.

Defined results: null texts have no words; a null id counts as an empty one; repeated rows count
again; words of any length are probed in bounded pieces; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

LEAST_LENGTH, LEAST_COUNT, FORM_RATIO, DELETE_EVERY = 7, 2, 10, 31
BITS, PROBES = 20, 5
#: blocks of 64 bytes in a broadcast (32 MB) and in a piece that one task fills
ROUND_BLOCKS, PIECE_BLOCKS = 1 << 19, 1 << 14
#: edits that are hashed at a time
STEP = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def occurring_words(docs: DataFrame) -> DataFrame:
    """One row per word that occurs, damaged as the rule says: every so many runs lose a letter.

    Shorter runs cannot become words, so only those of LEAST_LENGTH on leave the text."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(
        "text", F.lit(f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"))
    # only A-Z: where all letters are ASCII, lower() does that faster
    low = F.when(F.octet_length("run") == F.char_length("run"), F.lower("run")).otherwise(
        F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    runs = runs.select("doc_id", low.alias("run"))
    turn = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                            F.col("run")))
    runs = runs.select("run", turn.alias("turn"))
    at = (F.col("turn") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at),
                       F.substring(F.col("run"), at + 2, F.char_length("run")))
    words = runs.select(F.when(F.col("turn") % DELETE_EVERY == 0, shorter).otherwise(
        F.col("run")).alias("word"))
    return words.filter(F.char_length("word") >= LEAST_LENGTH)


def mixed_bits(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    p = np.full(n, _BASE, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


def code_points(words: list[str]) -> np.ndarray:
    """A row of code points per word; all of one length."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return flat.reshape(len(words), -1).astype(np.uint64)


def spelled(points: np.ndarray) -> np.ndarray:
    """The polynomial of each row."""
    return (points * powers(points.shape[1])).sum(axis=1, dtype=np.uint64)


def block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    """Mixed hashes to blocks, evenly and in order of the upper half."""
    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def place_of(g: np.ndarray, probe: int) -> tuple[np.ndarray, np.ndarray]:
    """Word of the block and bit of the word, from nine bits of a second hash."""
    place = (g >> np.uint64(9 * probe)) & np.uint64(511)
    return (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))


class Shard:
    """Blocks `low` to `high` of the filter for the words of one length."""

    def __init__(self, blocks: int, low: int, high: int):
        self.blocks, self.low, self.high = blocks, low, high
        self.bits = np.zeros((high - low) * 8, np.uint64)

    def add(self, h: np.ndarray) -> None:
        at, g = (block_of(h, self.blocks) - self.low) * 8, mixed_bits(h + np.uint64(1))
        for i in range(PROBES):
            word, bit = place_of(g, i)
            np.bitwise_or.at(self.bits, at + word, bit)

    def knows(self, polynomials: np.ndarray) -> np.ndarray:
        """Indices of those that may be words of the vocabulary."""
        h = mixed_bits(polynomials)
        block = block_of(h, self.blocks)
        left = np.flatnonzero((self.low <= block) & (block < self.high))
        at, g = (block[left] - self.low) * 8, mixed_bits(h[left] + np.uint64(1))
        for i in range(PROBES):
            word, bit = place_of(g, i)
            hit = self.bits[at + word] & bit != 0
            left, at, g = left[hit], at[hit], g[hit]
        return left


def hashed_rows(batches: Iterator[pa.RecordBatch], blocks: dict[int, int]
                ) -> Iterator[pa.RecordBatch]:
    """word -> length, piece of the filter, mixed hash."""
    for batch in batches:
        for length, words in by_length(batch.column("word").to_pylist()):
            h = mixed_bits(spelled(code_points(words)))
            piece = block_of(h, blocks[length]) // PIECE_BLOCKS
            yield pa.RecordBatch.from_arrays(
                [pa.array([length] * len(words), pa.int32()), pa.array(piece, pa.int32()),
                 pa.array(h.view(np.int64))], names=["length", "piece", "hash"])


def by_length(words: list[str]) -> Iterator[tuple[int, list[str]]]:
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    yield from groups.items()


def filled(table: pa.Table, blocks: dict[int, int]) -> pa.Table:
    """The bits of one piece."""
    length, piece = table["length"][0].as_py(), table["piece"][0].as_py()
    low = piece * PIECE_BLOCKS
    shard = Shard(blocks[length], low, min(low + PIECE_BLOCKS, blocks[length]))
    shard.add(table["hash"].to_numpy().view(np.uint64))
    return pa.table({"length": pa.array([length], pa.int32()), "piece": pa.array([piece], pa.int32()),
                     "bits": pa.array([shard.bits.tobytes()], pa.binary())})


def known_edits(words: list[str], shards: dict[int, list[Shard]], alphabet: np.ndarray
                ) -> Iterator[tuple[int, str]]:
    """Index of a word of one length, and an edit of it that a shard knows."""
    length = len(words[0])
    power = powers(length)
    rows = max(1, STEP // (length * len(alphabet)))
    wide = max(1, STEP // len(alphabet))  # places at a time, for very long words
    for a in range(0, len(words), rows):
        points = code_points(words[a:a + rows])
        terms = points * power
        whole = terms.sum(axis=1, dtype=np.uint64)
        for shard in shards.get(length, ()):
            for p in range(0, length, wide):
                old = points[:, p:p + wide, None]
                edits = whole[:, None, None] + (alphabet - old) * power[p:p + wide][None, :, None]
                greater = np.flatnonzero((alphabet > old).ravel())
                for x in greater[shard.knows(edits.ravel()[greater])].tolist():
                    i, rest = divmod(x, old.shape[1] * len(alphabet))
                    at, c = divmod(rest, len(alphabet))
                    w = words[a + i]
                    yield a + i, w[:p + at] + chr(int(alphabet[c])) + w[p + at + 1:]
        for shard in shards.get(length - 1, ()):
            before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
            edits = before + (whole[:, None] - before - terms) * _INVERSE
            # of a letter that stands several times in a row, the first is enough
            first = np.flatnonzero(np.pad(points[:, 1:] != points[:, :-1], ((0, 0), (1, 0)),
                                          constant_values=True).ravel())
            for x in first[shard.knows(edits.ravel()[first])].tolist():
                i, at = divmod(x, length)
                w = words[a + i]
                yield a + i, w[:at] + w[at + 1:]


def edit_rows(batches: Iterator[pa.RecordBatch], shards, alphabet: np.ndarray
              ) -> Iterator[pa.RecordBatch]:
    """word, n -> word, n, edit for the edits that may be words."""
    for batch in batches:
        n = dict(zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()))
        for _, words in by_length(list(n)):
            for a in range(0, len(words), 4096):
                part = words[a:a + 4096]
                found = list(known_edits(part, shards.value, alphabet))
                yield pa.RecordBatch.from_pydict(
                    {"word": [part[i] for i, _ in found], "n": [n[part[i]] for i, _ in found],
                     "edit": [e for _, e in found]}, schema=EDIT_SCHEMA)


EDIT_SCHEMA = pa.schema([("word", pa.string()), ("n", pa.int64()), ("edit", pa.string())])


def rounds_of(blocks: dict[int, int]) -> list[list[tuple[int, int, int]]]:
    """Length and first and last piece of the filters that are broadcast together."""
    out: list[list[tuple[int, int, int]]] = [[]]
    room = most = ROUND_BLOCKS // PIECE_BLOCKS
    for length in sorted(blocks):
        pieces, at = -(-blocks[length] // PIECE_BLOCKS), 0
        while at < pieces:
            if not room:
                out.append([])
                room = most
            n = min(room, pieces - at)
            out[-1].append((length, at, at + n))
            at, room = at + n, room - n
    return out


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """word, n, near, near_n: every pair of words one edit apart, in both directions."""
    spark = vocabulary.sparkSession
    sizes = vocabulary.groupBy(F.char_length("word").alias("length")).agg(F.count("*").alias("n"))
    # one row per word length and one per letter that occurs
    blocks = {r["length"]: -(-r["n"] * BITS // 512) for r in sizes.collect()}
    letters = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).filter(
        "c <> ''").distinct().collect()
    alphabet = np.array(sorted(ord(r["c"]) for r in letters), np.uint64)
    hashes = vocabulary.select("word").mapInArrow(
        lambda b: hashed_rows(b, blocks), "length int, piece int, hash long")
    pieces = stored(hashes.groupBy("length", "piece").applyInArrow(
        lambda t: filled(t, blocks), "length int, piece int, bits binary"), "spelling-filters")
    edits = None
    for together in rounds_of(blocks):
        shards: dict[int, list[Shard]] = {}
        inside = F.lit(False)
        for length, low, high in together:
            inside |= (F.col("length") == length) & (F.col("piece") >= low) & (F.col("piece") < high)
            at = low * PIECE_BLOCKS, min(high * PIECE_BLOCKS, blocks[length])
            shards.setdefault(length, []).append(Shard(blocks[length], *at))
        # at most ROUND_BLOCKS blocks
        for row in pieces.filter(inside).toLocalIterator():
            shard = shards[row["length"]][0]
            at = (row["piece"] * PIECE_BLOCKS - shard.low) * 8
            bits = np.frombuffer(row["bits"], np.uint64)
            shard.bits[at:at + len(bits)] = bits
        sent = spark.sparkContext.broadcast(shards)
        found = stored(vocabulary.mapInArrow(lambda b, s=sent: edit_rows(b, s, alphabet),
                                             "word string, n long, edit string"), "spelling-edits")
        sent.unpersist()
        edits = found if edits is None else edits.unionByName(found)
    exact = vocabulary.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    pairs = edits.join(exact, "edit")
    return pairs.select(F.inline(F.array(
        F.struct(F.col("word"), F.col("n"), F.col("edit").alias("near"),
                 F.col("edit_n").alias("near_n")),
        F.struct(F.col("edit").alias("word"), F.col("edit_n").alias("n"), F.col("word").alias("near"),
                 F.col("n").alias("near_n")))))


def last_forms(forms: DataFrame) -> DataFrame:
    """word, root: the end of each chain of forms. Counts grow tenfold along a chain, so doubling the
    stretch that each word has followed ends after a few rounds."""
    links = stored(forms.select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        # a root may be that of very many words, but stands once on the other side
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = stored(links.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")), "spelling-links")
        links = joined.select("word", "root")
        if not joined.filter("moved").limit(1).count():
            return links


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    counts = occurring_words(docs).groupBy("word").agg(F.count("*").alias("n"))
    vocabulary = stored(counts.filter(F.col("n") >= LEAST_COUNT), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near"))
    near = near_pairs(vocabulary).groupBy("word", "n").agg(
        F.count("*").alias("n_near"), best.alias("best"))
    taken = -F.col("best.n") >= FORM_RATIO * F.col("n")
    near = stored(near.select("word", "n_near", F.when(taken, F.col("best.near")).alias("form"),
                              F.when(taken, -F.col("best.n")).alias("form_n")), "spelling-near")
    roots = last_forms(near.filter("form is not null"))
    return (vocabulary.join(near, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
