"""Language-model scores by logistic mixing of bit predictors.

A text is spelled as its lower-cased words, each with a closing space, and one end; eight yes/no
decisions per byte. Predictors of a bit: what training texts had after the last two, three and five
bytes, after the beginning of the word, and after that beginning and the word before it. All
contexts reach back over the whole text, so a score depends on the order of the words, and every byte
is mixed, however long the word. Per context and bit there are counts in hashed tables; their log odds
are combined with weights that a gate selects by how sure the two word contexts are at the half byte's
first bit and by the place in the byte, and the mixed probability is refined by a table of how often bits came true at that confidence.

Training texts are dealt into two parts by their content: one fills the tables and the other, whose
texts the tables have not seen, teaches weights and refinement; then its counts are added. So every
training text is learned from. Weights are learned block by block while each task walks over its texts,
and averaged. With tables and weights fixed, a text's probability is a product over its bits, and
the probabilities of all texts are at most 1 in total.

What is gathered are token counts for the base score (one row per distinct token, growing with the
corpus) and the tables of fixed size 5 * 2^20, summed by segment and sent to the tasks.

Defined results: null and empty texts are one end token; a null id trains; repeated rows count as
often as they occur; with no training text every bit has probability 1/2; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, rows_in, stored
from .frequencies import document_sums, frequencies

END = b"\n"  # no word has it
SPACE = 0x20
#: contexts of the last bytes; the beginning of the word, and with the word before, come after them
ORDERS = (2, 3, 5)
PAD = max(ORDERS)
CONTEXTS = len(ORDERS) + 2
TABLE_BITS = 20
SLOTS = CONTEXTS << TABLE_BITS
#: slots of a row that is shuffled; 16 follow one another for the half bytes after one context
SEGMENT = 1 << 14
#: bytes that are worked on at once; a longer text goes on where its last block ended
BLOCK = 1 << 13
LEVELS, GATES = 33, 16
SURE = (0.5, 2.0, 4.0)  # borders of what a word context's log odds say
RATE = 0.3
#: one in so many training texts teaches the weights before it is counted
TEACHES = 10
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_POWERS = np.full(BLOCK + PAD + 2, 0x2545F4914F6CDD1D, np.uint64)
_POWERS[0] = 1
_POWERS = np.multiply.accumulate(_POWERS)
_INVERSE = np.full(len(_POWERS), pow(0x2545F4914F6CDD1D, -1, 1 << 64), np.uint64)
_INVERSE = np.multiply.accumulate(_INVERSE)  # one power ahead


def tokens_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words between white space, then one end."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    words.append(END)
    return words


def spelled_text(text: str | None) -> bytes:
    return b" ".join(tokens_of(text))


def spelled_word(word: bytes) -> bytes:
    return word + b" "


class Block:
    """Bytes of several texts, or of a part of one long text, with their contexts.

    data: the bytes that are predicted; owner: the number of the text of each; bases: per half byte
    and context where the slots of its four bits begin.
    """

    def __init__(self, parts: list[tuple[int, bytes]], before: tuple[bytes, int, int] | None):
        """before: last bytes, hash of the word so far and of the word before it, of the text that
        the only part goes on with."""
        lead = before[0] if before else bytes(PAD)
        flat = np.frombuffer(b"".join([x for _, p in parts for x in (lead, p)]), np.uint8)
        real = np.ones(len(flat), bool)
        sizes = np.array([len(p) for _, p in parts])
        starts = np.cumsum(sizes + PAD) - sizes
        real[(starts[:, None] - np.arange(1, PAD + 1)).ravel()] = False
        wide = flat.astype(np.uint64)
        # the word's beginning as a polynomial, from sums over all bytes
        breaks = (flat == SPACE) | ~real
        sums = np.cumsum(np.where(breaks, np.uint64(0), wide + np.uint64(1)) * _INVERSE[:len(flat)])
        last = np.maximum.accumulate(np.where(breaks, np.arange(len(flat)), 0))
        last = np.concatenate([[0], last[:-1]])  # the break before each byte
        total = np.concatenate([[np.uint64(0)], sums[:-1]])
        word = (total - sums[last]) * _POWERS[:len(flat)]
        word[~real] = 0
        if before:
            first = np.flatnonzero(real & (last == starts[0] - 1))
            word[first] += np.uint64(before[1]) * _POWERS[first - starts[0]]
        previous = word[last]
        if before:
            previous[first] = np.uint64(before[2])
        keep = np.flatnonzero(real)
        context, history = np.zeros(len(keep), np.uint64), {}
        for back in range(1, PAD + 1):
            context |= wide[keep - back] << np.uint64(8 * back - 8)
            if back in ORDERS:
                history[back] = context.copy()
        word_, previous_ = word[keep], previous[keep]
        keys = [*history.values(), word_, word_ * _MIX + previous_ * _ODD + np.uint64(1)]
        self.data = flat[keep]
        self.owner = np.repeat([i for i, _ in parts], sizes)
        high = (self.data >> 4).astype(np.uint64) + np.uint64(1)
        self.bases = [[], []]
        for k, key in enumerate(keys):
            mixed = (key + np.uint64(k + 1)) * _ODD
            mixed ^= mixed >> np.uint64(29)
            for half, at in enumerate((mixed, mixed + high * np.uint64(0xD6E8FEB86659FD93))):
                at = at * _MIX
                at >>= np.uint64(64 - TABLE_BITS)
                at &= np.uint64((1 << TABLE_BITS) - 16)
                self.bases[half].append(at.view(np.int64) + (k << TABLE_BITS))
        # what a part that goes on must know
        w = int(word[-1])
        if flat[-1] == SPACE:
            self.after = (flat[-PAD:].tobytes(), 0, w)
        else:
            grown = (w * 0x2545F4914F6CDD1D + int(flat[-1]) + 1) % (1 << 64)
            self.after = (flat[-PAD:].tobytes(), grown, int(previous[-1]))

    def halves(self) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """The high and the low half of each byte, and where its slots begin by context."""
        yield (self.data >> 4).astype(np.int64), self.bases[0]
        yield (self.data & 15).astype(np.int64), self.bases[1]


def blocks(texts: list[bytes]) -> Iterator[Block]:
    held: list[tuple[int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) + PAD > BLOCK:
            yield Block(held, None)
            held, size = [], 0
        if len(text) + PAD <= BLOCK:
            held.append((i, text))
            size += len(text) + PAD
            continue
        before = None
        for at in range(0, len(text), BLOCK):
            block = Block([(i, text[at:at + BLOCK])], before)
            yield block
            before = block.after
    if held:
        yield Block(held, None)


def texts_in(batches: Iterator[pa.RecordBatch], spell: Callable) -> Iterator[tuple]:
    """Tables of rows, their texts as bytes, and how often each counts."""
    for rows in rows_in(batches, 4_096, 1 << 20):
        texts = [spell(x) for x in rows["text"].to_pylist()]
        yield rows, texts, rows["c"].to_numpy().astype(np.float64)


def count_rows(batches: Iterator[pa.RecordBatch], spell: Callable) -> Iterator[pa.RecordBatch]:
    """How often the texts of a task had each half byte after each context, by segments."""
    n = np.zeros(SLOTS, np.float32)
    for _, texts, counts in texts_in(batches, spell):
        for block in blocks(texts):
            weight = counts[block.owner].astype(np.float32)
            for value, bases in block.halves():
                for base in bases:
                    np.add.at(n, base + value, weight)
    n = n.reshape(-1, SEGMENT)
    for segment in np.flatnonzero(n.any(axis=1)):
        yield pa.RecordBatch.from_arrays(
            [pa.array([segment], type=pa.int32()), pa.array([n[segment].tobytes()])],
            names=["segment", "counts"])


def add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the segments that come to a task, and the log odds of their bits."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, counts in zip(batch.column("segment").to_pylist(), batch.column("counts")):
            n = np.frombuffer(counts.as_buffer(), np.float32)
            if segment in held:
                held[segment] += n
            else:
                held[segment] = n.astype(np.float64)
    for segment, n in held.items():
        # of 16 half bytes, node 1 is the first bit, and node m is followed by 2m and 2m + 1
        tree = np.concatenate([np.zeros((SEGMENT // 16, 16)), n.reshape(-1, 16)], axis=1)
        odds = np.zeros((SEGMENT // 16, 16), np.float32)
        for node in range(15, 0, -1):
            zeros, ones = tree[:, 2 * node], tree[:, 2 * node + 1]
            tree[:, node] = zeros + ones
            odds[:, node] = np.log((ones + 0.1) / (zeros + 0.1))
        yield pa.RecordBatch.from_arrays(
            [pa.array([segment], type=pa.int32()), pa.array([n.astype(np.float32).tobytes()]),
             pa.array([odds.tobytes()])], names=["segment", "counts", "odds"])


def added(counts: DataFrame) -> DataFrame:
    return counts.repartition("segment").mapInArrow(
        add_rows, "segment int, counts binary, odds binary")


def odds_of(sums: DataFrame) -> np.ndarray:
    """The tables, which have a fixed size."""
    odds = np.zeros((SLOTS // SEGMENT, SEGMENT), np.float32)
    for row in sums.select("segment", "odds").toLocalIterator():
        odds[row["segment"]] = np.frombuffer(row["odds"], np.float32)
    return odds.ravel()


def start_weights() -> np.ndarray:
    """The same weight for all contexts, at every gate and place."""
    w = np.full((GATES * 8, CONTEXTS + 1), 0.4, np.float32)
    w[:, -1] = 0
    return w


class Mixer:
    """Predicts the bits of blocks, and learns from them if `learn`."""

    def __init__(self, odds: np.ndarray, weights: np.ndarray, refine: np.ndarray, learn: bool):
        self.odds, self.weights, self.learn = odds, weights.astype(np.float32), learn
        self.refine = refine.astype(np.float32)
        self.mass = np.zeros(len(weights))
        self.seen = np.zeros((2, GATES * LEVELS))

    def bits(self, block: Block, counts: np.ndarray | None = None) -> np.ndarray:
        """Bits that each byte costs."""
        size = len(block.data)
        cost = np.zeros(size, np.float32)
        x = np.empty((CONTEXTS + 1, size), np.float32)
        x[-1] = 0.3
        b = 0
        for value, bases in block.halves():
            node = np.ones(size, np.int64)
            right = np.ones(size, np.float32)
            for shift in (3, 2, 1, 0):
                bit = (value >> shift) & 1
                for k, base in enumerate(bases):
                    self.odds.take(base + node, out=x[k], mode="clip")
                if shift == 3:
                    gate = np.zeros(size, np.int64)
                    for k, step in ((-3, 4), (-2, 1)):
                        odds = np.abs(x[k])
                        for border in SURE:
                            gate += (odds > border) * step
                table = np.ascontiguousarray(self.weights[b::8].T)
                mixed = table[0].take(gate) * x[0]
                for k in range(1, CONTEXTS + 1):
                    mixed += table[k].take(gate) * x[k]
                np.clip(mixed, -12, 12, out=mixed)
                p = 1 / (1 + np.exp(-mixed))
                mixed += 12
                mixed *= (LEVELS - 1) / 24
                near = (mixed + np.float32(0.5)).astype(np.int64)
                near += gate * LEVELS
                if self.learn:
                    self._step(x, bit, p, gate * 8 + b, near, counts)
                else:
                    p += self.refine.take(near)
                    p *= 0.5
                    np.clip(p, 2.0 ** -20, 1 - 2.0 ** -20, out=p)
                    # 1 - p where the bit is 0
                    right *= np.abs(p - (1 - bit).astype(np.float32))
                node = (node << 1) | bit
                b += 1
            cost -= np.log2(right)
        return cost

    def _step(self, x, bit, p, chosen, near, counts) -> None:
        error = (bit - p) * counts
        curve = np.maximum(p * (1 - p), 1e-4) * counts
        size = len(self.weights)
        for i in range(len(x)):
            up = np.bincount(chosen, weights=error * x[i], minlength=size)
            by = np.bincount(chosen, weights=curve * x[i] * x[i], minlength=size)
            self.weights[:, i] += np.clip(RATE / len(x) * up / (by + 1.0), -0.2, 0.2)
        self.mass += np.bincount(chosen, weights=counts, minlength=size)
        for value in (0, 1):
            self.seen[value] += np.bincount(
                near, weights=counts * (bit == value), minlength=GATES * LEVELS)


def learn_rows(batches: Iterator[pa.RecordBatch], spell: Callable, sent) -> Iterator[pa.RecordBatch]:
    """What a task learned, one number per row: key, value, mass."""
    weights = start_weights()
    mixer = Mixer(sent.value[0], weights, np.zeros(GATES * LEVELS), True)
    for _, texts, counts in texts_in(batches, spell):
        for block in blocks(texts):
            mixer.bits(block, counts[block.owner])
    mass = np.concatenate([np.repeat(mixer.mass, weights.shape[1]), np.ones(mixer.seen.size)])
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(mass), dtype=np.int32)),
         pa.array(np.concatenate([mixer.weights.ravel(), mixer.seen.ravel()]).astype(np.float64)),
         pa.array(mass)], names=["key", "value", "mass"])


def score_rows(batches: Iterator[pa.RecordBatch], spell: Callable, sent) -> Iterator[pa.RecordBatch]:
    mixer = Mixer(*sent.value, False)
    for rows, texts, _ in texts_in(batches, spell):
        bits = np.zeros(len(texts))
        for block in blocks(texts):
            bits += np.bincount(block.owner, weights=mixer.bits(block), minlength=len(texts))
        yield from rows.drop_columns(["text", "c"]).append_column(
            "bits", pa.array(bits)).to_batches()


def numbers(rows: DataFrame, columns: list[str]) -> list[np.ndarray]:
    """Columns of a table of fixed size."""
    got = rows.select(*columns).toArrow()
    return [got[c].combine_chunks().to_numpy(zero_copy_only=False) for c in columns]


def text_bits(texts: DataFrame, spell: Callable) -> DataFrame:
    """The rows of a stored table of text, c (how often it is learned from) and further columns; bits
    instead of text and c."""
    context = texts.sparkSession.sparkContext
    learned = texts.filter("c > 0").select("text", F.col("c").cast("double").alias("c"))
    teaches = F.pmod(F.xxhash64("text"), F.lit(TEACHES)) == 0

    def counted(rows: DataFrame) -> DataFrame:
        return rows.mapInArrow(lambda b: count_rows(b, spell), "segment int, counts binary")

    base = stored(added(counted(learned.filter(~teaches))), "mixing-counts")
    first = context.broadcast((odds_of(base),))
    weights = start_weights()
    key, value, mass, plain = numbers(learned.filter(teaches).mapInArrow(
        lambda b: learn_rows(b, spell, first), "key int, value double, mass double"
    ).groupBy("key").agg(
        F.sum(F.col("value") * F.col("mass")).alias("value"), F.sum("mass").alias("mass"),
        F.sum("value").alias("plain")), ["key", "value", "mass", "plain"])
    numbers_ = np.concatenate([weights.ravel(), np.zeros(2 * GATES * LEVELS)]).astype(np.float64)
    is_weight = key < weights.size
    use = is_weight & (mass > 0)
    numbers_[key[use]] = value[use] / mass[use]
    numbers_[key[~is_weight]] = plain[~is_weight]
    weights = numbers_[:weights.size].reshape(weights.shape)
    seen = numbers_[weights.size:].reshape(2, -1)
    prior = 1 / (1 + np.exp(-np.tile(np.linspace(-12, 12, LEVELS), GATES)))
    refine = (seen[1] + 10 * prior) / (seen.sum(axis=0) + 10)
    whole = added(base.select("segment", "counts").unionByName(
        counted(learned.filter(teaches))))
    second = context.broadcast((odds_of(whole), weights, refine))
    kept = [f for f in texts.schema.fields if f.name not in ("text", "c")]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "bits double"])
    return texts.select("text", F.col("c").cast("double").alias("c"), *[f.name for f in kept]
                        ).mapInArrow(lambda b: score_rows(b, spell, second), schema)


def token_bits(tokens: DataFrame) -> DataFrame:
    """The rows of a stored table of word, c (occurrences in training) with the bits of each word as
    a text's only word."""
    return text_bits(tokens.select("*", F.col("word").alias("text")), spelled_word).join(
        tokens.select("word", "c"), "word")


def scored(docs: DataFrame, trains: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte per row.

    trains: whether a row's text is learned from.
    """
    rows = stored(numbered(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"),
                                       F.when(trains, 1).otherwise(0).alias("c"))), "mixing-texts")
    table = frequencies(rows, tokens_of, "row_id", "text", F.when(F.col("c") > 0, 0), 1)
    tokens = stored(table.filter("word is not null").groupBy("word").agg(
        F.sum("c0").alias("c")), "mixing-tokens")
    n, v = tokens.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    values = tokens.select(
        "word", (F.col("c") > 0).cast("double").alias("n_known"),
        F.log10((F.col("c") + 1) / F.lit(float(n + v + 1))).alias("base_score"))
    sums = document_sums(table, values, ["n_known", "base_score"]).withColumnRenamed(
        "doc_id", "row_id")
    out = sums.join(text_bits(rows, spelled_text), "row_id")
    return out.select(
        "doc_id", "n_bytes", F.col("n_words").alias("n_tokens"),
        F.col("n_known").cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), "base_score",
        (F.col("bits") * -math.log10(2)).alias("score"),
        F.try_divide("bits", "n_bytes").alias("bits_per_byte"))
