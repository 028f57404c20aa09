"""Repeated passages, whitening and spelling variants against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import TINY
from llm.conftest import ODD

from tidemark.llm import spelling, suffix_runs, whitening
from tidemark.llm.queries import queries


def passages_cut(rows, length):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 by counting every string of `length` bytes."""
    texts = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(b[i:i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for (doc, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(x and not y for x, y in zip(gone, b"\0" + gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def mixed_passages(seed, n=150):
    r = random.Random(seed)
    known = ["".join(r.choice("abcdé ") for _ in range(r.randint(20, 200))) for _ in range(8)]

    def piece():
        return r.choice([r.choice(known), r.choice(known)[r.randint(0, 30):],
                         "".join(r.choice("abcdefgh é") for _ in range(r.randint(1, 60)))])

    rows = [(i, "".join(piece() for _ in range(r.randint(0, 6)))) for i in range(n)]
    return rows + [(500, None), (None, "a" * 300), (501, "ab" * 200), (502, rows[3][1]),
                   (502, rows[3][1]), (503, ""), (504, "x" * 45)] + ODD


@pytest.mark.parametrize("gram,hot", [(13, 20_000), (40, 20_000), (32, 5)])
def test_passages(documents, gram, hot):
    rows = mixed_passages(gram)
    got = suffix_runs.deduplicated(documents(rows), 40, gram, hot)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == passages_cut(rows, 40)


def test_passages_over_ranges(documents, monkeypatch):
    rows = mixed_passages(5) + [(900, mixed_passages(6)[0][1] * 30)]
    monkeypatch.setattr(suffix_runs, "RANGE_ROWS", 50)
    got = suffix_runs.deduplicated(documents(rows), 40, 13)
    assert sorted(map(tuple, got.collect()), key=str) == passages_cut(rows, 40)


def test_every_window_has_one_anchor(monkeypatch):
    """Also over chunks, and where the least string occurs again and again."""
    texts = [t or "" for _, t in mixed_passages(7)] + ["a" * 100, "abc" * 90]
    batch = pa.RecordBatch.from_pydict({"key": list(range(len(texts))), "text": texts})
    picked = []
    for chunk in (1 << 20, 64):
        monkeypatch.setattr(suffix_runs, "CHUNK", chunk)
        windows = {}
        for rows in suffix_runs.anchor_rows(iter([batch]), 40, 13):
            for key, h, *places in zip(*(c.to_pylist() for c in rows.columns)):
                for at, far, near in zip(*places):
                    for d in range(near, far + 1):
                        assert (key, at - d) not in windows
                        windows[key, at - d] = (h, d)
        picked.append(windows)
    assert picked[0] == picked[1]
    assert set(picked[0]) == {(k, i) for k, t in enumerate(texts)
                              for i in range(len(t.encode()) - 39)}
    hashes = np.array([h for h, _ in set(picked[0].values())], np.int64).view(np.uint64)
    assert 0.4 < np.mean(hashes < np.uint64(1 << 63)) < 0.6, "spread evenly over ranges"
    # equal windows pick equal anchors
    by_bytes = {}
    for (k, i), choice in picked[0].items():
        assert by_bytes.setdefault(texts[k].encode()[i:i + 40], choice) == choice


def test_merge_of_front_coded_runs():
    r = random.Random(3)
    for k in (1, 2, 3, 5, 8, 13):
        runs = [sorted(bytes(r.choice(b"ab") for _ in range(r.randint(0, 70)))
                       for _ in range(r.randint(0, 40))) for _ in range(k)]
        got = list(suffix_runs.merged([suffix_runs.decoded(*suffix_runs.front_coded(x, 70))
                                       for x in runs]))
        every = sorted(s for x in runs for s in x)
        assert [s for _, s, _ in got] == every
        for (_, a, _), (_, b, n) in zip(got, got[1:]):
            assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])


def test_passages_empty_and_query(spark, documents):
    assert suffix_runs.deduplicated(documents([(1, "a")]).limit(0)).count() == 0
    docs = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()
    got = queries()["op11_suffix_runs"](spark, TINY).collect()
    assert sorted(map(tuple, got), key=str) == passages_cut([tuple(x) for x in docs], 400)
    assert any(x.n_removed for x in got)


def spelling_by_pairs(rows):
    """word, form, root, n, n_near, form_n by deleting and replacing in dictionaries."""
    counts = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    near = {w: set() for w in n}
    holes = collections.defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[w[:i] + "?" + w[i + 1:]].add(w)
            if w[:i] + w[i + 1:] in n:
                near[w].add(w[:i] + w[i + 1:])
                near[w[:i] + w[i + 1:]].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def misspelled(seed, n=300):
    r = random.Random(seed)
    stems = ["".join(r.choice("abcdeé") for _ in range(r.randint(7, 11))) for _ in range(12)]
    text = []
    for i, w in enumerate(stems):
        for _ in range(2000 // (1 + i * i) + 2):
            v = w
            while r.random() < 0.15:
                at = r.randrange(len(v))
                v = v[:at] + r.choice(["", "a", "bb", "é", "\u00ff", "\u00d7"]) + v[at + r.randint(0, 1):]
            text.append(v.upper() if r.random() < 0.1 else v)
    r.shuffle(text)
    rows = [(i, r.choice([" ", ", ", "-", "1"]).join(text[i::n])) for i in range(n)]
    for word, docs, times in (("longchained", 20, 20), ("longchaine", 15, 2), ("longchain", 1, 2)):
        rows += [(1000 * len(word) + i, f"{word} " * times) for i in range(docs)]
    return rows + ODD + [(70, "Ångström ÅNGSTRÖM ångström " * 3), (70, "y" * 9000 + " " + "y" * 9000),
                         (71, "y" * 8999 + " " + "y" * 8999)]


@pytest.mark.parametrize("small", [False, True])
def test_spelling_variants(documents, monkeypatch, small):
    if small:  # many rounds of small filters
        monkeypatch.setattr(spelling, "ROUND_BLOCKS", 2 * spelling.PIECE_BLOCKS)
    rows = misspelled(1)
    got = spelling.variants(documents(rows))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = spelling_by_pairs(rows)
    assert sorted(map(tuple, got.collect())) == want
    assert any(w[1] and w[2] != w[1] for w in want), "a chain of forms"


def test_spelling_filters_know_their_words():
    words = [f"word{i:05d}" for i in range(3000)]
    points = spelling.spelled(spelling.code_points(words))
    blocks = -(-len(words) * spelling.BITS // 512)
    halves = [spelling.Shard(blocks, 0, 50), spelling.Shard(blocks, 50, blocks)]
    h = spelling.mixed_bits(points)
    block = spelling.block_of(h, blocks)
    for s in halves:
        s.add(h[(s.low <= block) & (block < s.high)])
    assert sorted(i for s in halves for i in s.knows(points)) == list(range(3000))
    other = spelling.spelled(spelling.code_points([f"other{i:05d}" for i in range(30_000)]))
    assert sum(len(s.knows(other)) for s in halves) < 300


def test_spelling_empty_and_query(spark, documents):
    assert spelling.variants(documents([(1, "a")]).limit(0)).count() == 0
    docs = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()
    got = queries()["op13_bloom_variants"](spark, TINY).collect()
    assert sorted(map(tuple, got)) == spelling_by_pairs([tuple(x) for x in docs])


def whitened_by_numpy(rows, k):
    """vec_id with deviation, absolute whitened numbers, explained shares, from a full eigensolver."""
    good = [(i, v) for i, v in rows if v is not None and len(v) == len(rows[0][1])
            and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(64 * np.array([v for _, v in good], np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, int((values > 1e-9 * values[0]).sum()))
    z = np.abs(c @ vectors[:, :k] / np.sqrt(values[:k]))
    out = {}
    for j, (i, _) in enumerate(good):
        deviation = sum(int(d)**2 for d in n * x[j] - s)
        out.setdefault(i, []).append((n, deviation, z[j], values[:k] / values.sum()))
    return out


def check_whitened(got, rows, k=32):
    want = whitened_by_numpy(rows, k)
    by_row = collections.defaultdict(list)
    for r in got:
        by_row[r.vec_id].append(r)
    assert set(by_row) == set(want)
    for i, copies in want.items():
        size = len(copies[0][2])
        assert len(by_row[i]) == size * len(copies)
        for n, deviation, z, explained in copies:
            mine = [r for r in by_row[i] if r.deviation == deviation]
            for j in range(size):
                at = [r for r in mine if r.component == j + 1]
                assert at and {r.n for r in at} == {n}
                assert min(abs(abs(r.whitened) - z[j]) for r in at) < 1e-6
                assert abs(at[0].explained - explained[j]) < 1e-9
                assert at[0].identity_error < 1e-8
    signs = {}
    for r in got:  # whitened numbers of a component have mean 0 and deviation 1
        signs.setdefault(r.component, []).append(r.whitened)
    for numbers in signs.values():
        assert abs(np.mean(numbers)) < 1e-8 and abs(np.mean(np.square(numbers)) - 1) < 1e-8


EMBEDDINGS = "vec_id long, embedding array<float>, n string, component string"


def vector_table(spark, rows, parts=5):
    return spark.createDataFrame([(i, v, "x", "x") for i, v in rows], EMBEDDINGS).repartition(parts)


@pytest.mark.parametrize("size,parts", [(6, 5), (40, 40), (1, 2)])
def test_whitening(spark, size, parts):
    r = np.random.default_rng(size)
    mix = r.standard_normal((size, size))
    rows = [(i, [float(v) for v in np.float32(r.standard_normal(size) @ mix)]) for i in range(300)]
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1])]
    bad = [(901, None), (902, []), (903, [None] * size), (904, [float("nan")] + [1.0] * (size - 1)),
           (905, [float("-inf")] * size), (906, [1.0] * (size + 1))]
    got = whitening.whitened(vector_table(spark, rows + bad, parts))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"]
    check_whitened(got.collect(), rows)


def test_whitening_without_variance(spark):
    for rows in ([], [(1, None)], [(1, [2.0, 3.0])], [(1, [2.0, 3.0]), (2, [2.0, 3.0])]):
        assert whitening.whitened(vector_table(spark, rows, 2)).count() == 0
    flat = [(i, [float(i), 7.0, float(2 * i)]) for i in range(10)]  # one direction only
    got = whitening.whitened(vector_table(spark, flat)).collect()
    assert {x.component for x in got} == {1} and abs(got[0].explained - 1) < 1e-12
    check_whitened(got, flat)


def test_directions_of_hard_triangles():
    r = np.random.default_rng(4)
    for n, size in ((90, 30), (20, 30)):
        for kind in range(5):
            a = r.standard_normal((n, size))
            if kind == 1:
                a *= 10.0**-r.uniform(0, 6, size)
            elif kind == 2:
                a[:, 15:] = a[:, :15]
            elif kind == 3:
                a = np.linalg.qr(a)[0] if n > size else np.linalg.qr(a.T)[0].T
            elif kind == 4:
                a[:, ::2] = 0
            values, v = whitening.directions(np.linalg.qr(a, mode="r"), size)
            exact = np.square(np.linalg.svd(a, compute_uv=False))
            assert np.allclose(values, exact[:len(values)], rtol=1e-9, atol=0)
            assert (exact[len(values):] < 1e-20 * exact[0]).all()
            z = a @ (v / np.sqrt(values))
            assert np.abs(z.T @ z - np.eye(len(values))).max() < 1e-8
            assert np.abs(v.T @ v - np.eye(len(values))).max() < 1e-12


def test_qd_values_of_graded_bidiagonals():
    """Small values keep their digits, which products of rows would lose."""
    for size in (2, 5, 30):
        diagonal, upper = 10.0**-np.arange(0, size / 2, 0.5), 0.3 * 10.0**-np.arange(0.5, size / 2, 0.5)
        got = np.sqrt(whitening.squared_singular_values(diagonal, upper[:size - 1]))
        b = np.diag(diagonal) + np.diag(upper[:size - 1], 1)
        assert np.isclose(got.prod(), np.abs(diagonal).prod(), rtol=1e-12, atol=0)
        assert np.isclose(got[0], np.linalg.norm(b, 2), rtol=1e-13)
        assert np.isclose(1 / got[-1], np.linalg.norm(np.linalg.inv(b), 2), rtol=1e-11)


def test_whitening_query(spark):
    rows = spark.read.parquet(f"{TINY}/embeddings.parquet").select("vec_id", "embedding").collect()
    check_whitened(queries()["op12_qd_whitening"](spark, TINY).collect(), [tuple(x) for x in rows])
