"""Toxicity scores from the nearest labelled examples.

Examples are labelled documents, at most `MAX_EXAMPLES`, chosen by a hash of the id. Terms are words
and beginnings of words (four to six bytes, for inflected forms); those that go with the label in the
examples (chi-square) are the vocabulary, at most `MAX_TERMS`. A document is a TF-IDF vector over it
of length 1, and its nearest examples are those with the highest cosine.

The examples' vectors are kept as an inverted index in blocks of examples with the largest weight
of each term and block. A query adds up these maxima to a bound for every block, opens the
blocks from the highest bound down, and stops when no bound reaches the k-th best cosine found, so
the neighbours are exact. Votes are weighted by closeness and mapped to rates seen when each
example is scored by the others. The neighbours are returned as evidence.

The index and vocabulary are bounded by the two parameters; that is why they can be sent to tasks.

Defined results: a text without vocabulary terms (null and empty too) gets the rate of such
examples; several labels of one id count as toxic if one does; labels without a document and null
ids or labels are not learned from; repeated rows are scored alike; without any example every score
is 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import rows_in, stored
from .decontaminate import words_of

MAX_EXAMPLES, MAX_TERMS = 20_000, 4_000
#: what a term needs: chi-square, the same as a share of the examples (a group of copies alone does not
#: reach it), and documents
LEAST_CHI, LEAST_SHARE, LEAST_DOCUMENTS = 30.0, 0.01, 4
PREFIXES = (4, 5, 6)
NEIGHBOURS, BLOCK = 15, 64
THRESHOLD = 0.7
BATCH_ROWS, BATCH_BYTES = 4_000, 8 << 20


def terms_of(word: bytes) -> list[bytes]:
    """The word, and its beginnings marked by a star."""
    return [word, *[word[:n] + b"*" for n in PREFIXES if len(word) >= n]]


def term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, toxic -> term, toxic documents, other documents; one row per term and batch."""
    for rows in rows_in(batches, BATCH_ROWS, BATCH_BYTES):
        found = (Counter(), Counter())
        for text, toxic in zip(rows["text"].to_pylist(), rows["toxic"].to_pylist()):
            found[toxic].update({t for w in set(words_of(text)) for t in terms_of(w)})
        terms = list(found[0] | found[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, type=pa.binary()),
             *[pa.array([found[y][t] for t in terms], type=pa.int64()) for y in (1, 0)]],
            names=["term", "pos", "neg"])


class Vocabulary:
    """Terms that go with the label, and their inverse document frequencies."""

    def __init__(self, terms: list[bytes], frequencies: list[int], examples: int):
        self.number = {t: i for i, t in enumerate(terms)}
        self.idf = np.log((1 + examples) / (1 + np.array(frequencies, np.float64))) + 1
        #: how a word with any term begins
        self.stems = {t.rstrip(b"*")[:PREFIXES[0]] for t in terms}

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers, and weights of length 1 (none if the text has no term)."""
        number, stems = self.number, self.stems
        n: Counter = Counter()
        words = [w for w in words_of(text) if w[:PREFIXES[0]] in stems]
        for word, count in Counter(words).items():
            for t in terms_of(word):
                if t in number:
                    n[number[t]] += count
        terms = np.array(sorted(n), np.int64)
        weights = (1 + np.log(np.array([n[t] for t in terms.tolist()], np.float64))) * \
            self.idf[terms] if len(terms) else np.zeros(0)
        return terms, weights / np.linalg.norm(weights) if len(terms) else weights


def spread(low: np.ndarray, high: np.ndarray, values: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of some ranges, and the value of the range that each comes from."""
    n = high - low
    shift = low - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else low
    return np.repeat(shift, n) + np.arange(int(n.sum())), np.repeat(values, n)


class BlockMaxIndex:
    """Inverted lists of examples in blocks, with the largest weight of each term in each block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray,
                 ids: np.ndarray, terms: int):
        self.labels, self.ids = labels, ids
        self.blocks = -(-len(vectors) // BLOCK)
        example = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        term = np.concatenate([t for t, _ in vectors] or [np.zeros(0, np.int64)])
        weight = np.concatenate([w for _, w in vectors] or [np.zeros(0)])
        order = np.lexsort((example, term))
        self.example, self.weight, term = example[order], weight[order], term[order]
        # one list per (term, block): its place in the postings, and its largest weight
        key = term * max(1, self.blocks) + self.example // BLOCK
        heads = np.flatnonzero(np.diff(key, prepend=-1))
        self.starts = np.concatenate([heads, [len(key)]])
        self.block = (self.example // BLOCK)[heads]
        self.highest = np.maximum.reduceat(self.weight, heads) if len(heads) else np.zeros(0)
        self.lists = np.searchsorted(term[heads], np.arange(terms + 1))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, without: int = -1
                ) -> tuple[np.ndarray, np.ndarray]:
        """The NEIGHBOURS examples with the highest cosine above 0, ties by place, and the cosines."""
        lists, w = spread(self.lists[terms], self.lists[terms + 1], weights)
        block = self.block[lists]
        bound = np.bincount(block, weights=w * self.highest[lists], minlength=self.blocks)
        order = np.argsort(-bound, kind="stable")[:int((bound > 0).sum())]
        turn = np.empty(self.blocks, np.int64)
        turn[order] = np.arange(len(order))
        turn = turn[block]
        found, cosine = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 2
        while at < len(order):
            if len(found) == NEIGHBOURS and bound[order[at]] < cosine[-1] - 1e-12:
                break
            open_ = (turn >= at) & (turn < at + step)
            places, value = spread(self.starts[lists[open_]], self.starts[lists[open_] + 1],
                                   w[open_])
            sums = np.bincount(self.example[places], weights=value * self.weight[places])
            hit = np.flatnonzero(sums > 0)
            hit = hit[hit != without]
            found = np.concatenate([found, hit])
            cosine = np.concatenate([cosine, np.round(sums[hit], 12)])
            best = np.lexsort((found, -cosine))[:NEIGHBOURS]
            found, cosine = found[best], cosine[best]
            at, step = at + step, 2 * step
        return found, cosine


def vote(labels: np.ndarray, cosine: np.ndarray, rate: float) -> float:
    """Share of toxic neighbours weighted by closeness; one vote of the overall rate is added with
    little weight, so few far neighbours say little."""
    closeness = cosine ** 2 / (1.02 - np.minimum(cosine, 1.0))
    return float((closeness @ labels + 0.5 * rate) / (closeness.sum() + 0.5))


def rising_rates(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A non-decreasing map from votes to rates (pooling neighbours that fall), as points."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []  # toxic, examples, lowest and highest vote
    for v, y in zip(votes[order].tolist(), labels[order].tolist()):
        pools.append([y, 1, v, v])
        while len(pools) > 1 and (pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]
                                  or pools[-2][3] == pools[-1][2]):
            y1, n1, low, high = pools.pop()
            pools[-1] = [pools[-1][0] + y1, pools[-1][1] + n1, pools[-1][2], high]
    rates = [(p[0] + 0.5) / (p[1] + 1) for p in pools]
    x = [e for p in pools for e in (p[2], p[3])]
    return np.array(x), np.maximum.accumulate(np.repeat(rates, 2)) if rates else np.zeros(0)


class Model:
    """What a task needs to score texts."""

    def __init__(self, vocabulary: Vocabulary, examples: list[tuple]):
        """examples: id, toxic, term numbers, weights."""
        examples = sorted(examples)
        self.vocabulary = vocabulary
        vectors = [(np.array(t, np.int64), np.array(w, np.float64)) for *_, t, w in examples]
        labels = np.array([x[1] for x in examples], np.float64)
        ids = np.array([x[0] for x in examples], np.int64)
        some = np.array([len(t) > 0 for t, _ in vectors], bool)
        self.rate = float(labels.mean()) if len(labels) else 0.0
        none = labels[~some]
        self.without_terms = float((none.sum() + self.rate) / (len(none) + 1)) \
            if len(labels) else 0.0
        used = [v for v, s in zip(vectors, some) if s]
        self.index = BlockMaxIndex(used, labels[some], ids[some], len(vocabulary.number))
        votes = np.array([self.voted(*v, without=i)[0] for i, v in enumerate(used)])
        self.points, self.rates = rising_rates(votes, labels[some])

    def voted(self, terms, weights, without=-1) -> tuple[float, np.ndarray, np.ndarray]:
        found, cosine = self.index.nearest(terms, weights, without)
        return vote(self.index.labels[found], cosine, self.rate), found, cosine

    def score(self, text: str | None) -> tuple[float, list[int], list[float]]:
        terms, weights = self.vocabulary.vector(text)
        if not len(terms):
            return self.without_terms, [], []
        raw, found, cosine = self.voted(terms, weights)
        score = float(np.interp(raw, self.points, self.rates)) if len(self.points) else raw
        return score, self.index.ids[found].tolist(), cosine.tolist()


def vector_rows(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    vocabulary = sent.value
    for rows in rows_in(batches, BATCH_ROWS, BATCH_BYTES):
        vectors = [vocabulary.vector(t) for t in rows["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [rows["doc_id"].combine_chunks(), rows["toxic"].combine_chunks(),
             pa.array([t for t, _ in vectors], type=pa.list_(pa.int64())),
             pa.array([w for _, w in vectors], type=pa.list_(pa.float64()))],
            names=["doc_id", "toxic", "terms", "weights"])


def score_rows(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    model = sent.value
    for rows in rows_in(batches, BATCH_ROWS, BATCH_BYTES):
        scores = [model.score(t) for t in rows["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [rows["doc_id"].combine_chunks(), pa.array([s for s, *_ in scores], type=pa.float64()),
             pa.array([i for _, i, _ in scores], type=pa.list_(pa.int64())),
             pa.array([c for *_, c in scores], type=pa.list_(pa.float64()))],
            names=["doc_id", "score", "neighbours", "cosines"])


def examples_of(docs: DataFrame, labels: DataFrame, learns: Column, limit: int = MAX_EXAMPLES
                ) -> DataFrame:
    """doc_id, text, toxic of at most `limit` labelled documents, chosen by a hash of the id.

    Labels are chosen first: that small table meets the documents, whose texts are not shuffled.
    """
    chosen = labels.filter("doc_id is not null and toxic is not null").filter(learns).groupBy(
        "doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(limit)
    # bounded by `limit`
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fitted(examples: DataFrame) -> Model:
    """The model of a stored table of examples; terms and vectors reach the driver, both bounded."""
    totals = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(
        F.count("*").alias("n")).collect()}
    p, n = max(1, totals.get(1, 0)), max(1, totals.get(0, 0))
    a, b = F.col("pos"), F.col("neg")
    chi = (p + n) * F.pow(a * (n - b) - b * (p - a), F.lit(2.0)) / (
        (a + b) * F.lit(float(p) * n) * (p + n - a - b))
    terms = examples.select("text", "toxic").mapInArrow(
        term_rows, "term binary, pos long, neg long").groupBy("term").agg(
        F.sum("pos").cast("double").alias("pos"), F.sum("neg").cast("double").alias("neg")).filter(
        (a + b >= LEAST_DOCUMENTS) & (a + b < p + n)).withColumn("chi", chi).filter(
        F.col("chi") >= max(LEAST_CHI, LEAST_SHARE * (p + n))).orderBy(F.desc("chi"), "term").limit(MAX_TERMS).collect()
    vocabulary = Vocabulary([bytes(r["term"]) for r in terms],
                            [int(r["pos"] + r["neg"]) for r in terms], p + n)
    sent = examples.sparkSession.sparkContext.broadcast(vocabulary)
    vectors = examples.select("doc_id", "text", "toxic").mapInArrow(
        lambda b: vector_rows(b, sent),
        "doc_id long, toxic int, terms array<long>, weights array<double>")
    return Model(vocabulary, [tuple(r) for r in vectors.collect()])


def scored(docs: DataFrame, examples: DataFrame) -> DataFrame:
    """doc_id, score, neighbours, cosines for every row."""
    model = docs.sparkSession.sparkContext.broadcast(fitted(stored(examples, "toxic-examples")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda b: score_rows(b, model),
        "doc_id long, score double, neighbours array<long>, cosines array<double>")


