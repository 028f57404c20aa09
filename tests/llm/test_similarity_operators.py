"""Near-duplicates, toxicity, wrappers, fixity, language-model scores and the pipeline."""

import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import TINY
from llm.conftest import ODD
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import context_mixing, fixity, near_duplicates, toxicity, wrappers
from tidemark.llm.common import stored
from tidemark.llm.queries import held_out, queries, tokenizer_path
from tidemark.llm.sql import ORACLES
from tidemark.session import shared_dir


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edits_within():
    r = random.Random(1)
    for _ in range(2000):
        a = [r.randrange(6) for _ in range(r.randint(0, 25))]
        b = list(a)
        for _ in range(r.randint(0, 8)):
            i = r.randint(0, len(b))
            b[i:i + r.randint(0, 1)] = [r.randrange(6)] * r.randint(0, 1)
        limit = r.randint(0, 9)
        assert near_duplicates.edits_within(np.array(a, np.uint32), np.array(b, np.uint32), limit) \
            == (edit_distance(a, b) <= limit)


def near_copies(seed, groups, size, words=80, edits=4):
    r = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"g{g}w{r.randrange(300)}" for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(r.randint(0, edits)):
                copy[r.randrange(len(copy))] = f"new{r.randrange(10**6)}"
            out.append((g, " ".join(copy)))
    return out


@pytest.mark.parametrize("groups,size", [(20, 3), (2, 60)])
def test_classes_of_near_copies(documents, groups, size):
    copies = near_copies(2, groups, size)
    rows = [(10 + i, t) for i, (_, t) in enumerate(copies)] + ODD[:1] + ODD[1:2] + ODD[3:5] + [
        (None, copies[0][1]), (2000, copies[0][1].upper() + "!")]
    got = near_duplicates.classes(documents(rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    for g in range(groups):
        assert {by_id[10 + i] for i, (h, _) in enumerate(copies) if h == g} == {10 + g * size}
    assert by_id[2000] == 10 and by_id[1] == 1 and by_id[2] == 2 and by_id[3] == 3
    assert [r.class_id for r in got if r.doc_id is None] == [10]
    kept = near_duplicates.one_of_each(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, *range(10, 10 + groups * size, size)]


def test_order_matters(documents):
    words = [f"w{i}" for i in range(100)]
    moved = words[50:] + words[:50]
    got = near_duplicates.classes(documents([(1, " ".join(words)), (2, " ".join(moved))])).collect()
    assert {r.class_id for r in got} == {1, 2}
    assert near_duplicates.classes(documents([])).count() == 0


def test_links_against_all_pairs(spark):
    import duckdb

    rows = duckdb.sql(f"select doc_id, text from '{TINY}/documents.parquet'").fetchall()
    words = {i: near_duplicates.words_of(t) for i, t in rows}
    root = {i: i for i in words}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(words)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = (np.array([zlib.crc32(w) for w in words[k]], np.uint32) for k in (i, j))
            if near_duplicates.similar(a, b) and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    got = {r.doc_id: r.class_id for r in queries()["op7_order_minhash"](spark, TINY).collect()}
    want = {i: find(i) for i in ids}
    assert all(got[i] in (want[i], i) for i in ids)  # nothing is joined that should not be
    linked = [i for i in ids if want[i] != i]
    assert sum(got[i] == want[i] for i in linked) >= 0.95 * len(linked)


def brute_classes(texts):
    """The smallest id of the class of each id, with all pairs aligned."""
    words = {i: np.array([zlib.crc32(w) for w in near_duplicates.words_of(t)], np.uint32)
             for i, t in texts}
    root = {i: i for i in words}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(words)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            if find(i) != find(j) and near_duplicates.similar(words[i], words[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in ids}


def family(seed, size):
    """Chains of heavily edited variants of one text: a variant is a copy of an earlier one with up
    to a fifth of its words replaced in one run, or words added at the end."""
    r = random.Random(seed)
    out = [[f"w{r.randrange(400)}" for _ in range(70)]]
    while len(out) < size:
        v = list(r.choice(out))
        if r.random() < 0.3:
            v += [f"n{r.randrange(10**6)}" for _ in range(r.randint(1, len(v) // 5))]
        else:
            n = r.randint(len(v) // 8, len(v) // 4)
            at = r.randrange(10, len(v) - n)
            v[at:at + n] = [f"n{r.randrange(10**6)}" for _ in range(n)]
        out.append(v)
    r.shuffle(out)
    return [(i, " ".join(v)) for i, v in enumerate(out)]


def test_family_of_edited_variants(documents):
    rows = family(12, 500)
    want = brute_classes(rows)
    got = {r.doc_id: r.class_id for r in near_duplicates.classes(documents(rows)).collect()}
    assert 20 < len(set(want.values())) < 480
    assert got == want


def edited_pairs(seed, pairs=6):
    """Pairs of texts with a fifth of the words replaced, every fifth word or at random places."""
    r = random.Random(seed)
    out = []
    for n in (5, 7, 9, 10, 14, 19, 31, 32, 39, 40, 41, 60, 100, 300, 1000):
        for k in range(pairs):
            a = [f"p{n}x{k}w{r.randrange(400)}" for _ in range(n)]
            b = list(a)
            for at in range(4, n, 5) if k % 2 else r.sample(range(n), n // 5):
                b[at] = f"n{r.randrange(10**9)}"
            out.append((" ".join(a), " ".join(b)))
    return out


def test_every_link_at_the_limit_is_found(documents):
    pairs = edited_pairs(31)
    rows = [(2 * i + side, t) for i, p in enumerate(pairs) for side, t in enumerate(p)]
    got = {r.doc_id: r.class_id for r in near_duplicates.classes(documents(rows)).collect()}
    assert [i for i in range(len(pairs)) if got[2 * i + 1] != 2 * i] == []


def test_all_links_of_the_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in queries()["op7_order_minhash"](spark, TINY).collect()}
    assert got == brute_classes([(i, t) for i, t in rows if near_duplicates.words_of(t)]) | {
        i: i for i, t in rows if not near_duplicates.words_of(t)}


def test_fine_bins_leave_out_long_texts_and_never_a_link():
    rng = np.random.default_rng(3)
    common = 1 + rng.zipf(1.3, 200_000) % 20_000
    for n in (300, 1000, 4000, 40_000, 90_000):
        x, y = (rng.choice(common, n).astype(np.uint32) for _ in "ab")
        near = x.copy()
        near[rng.choice(n, n // 5, replace=False)] = rng.integers(0, 1 << 32, n // 5, dtype=np.uint32)
        near = np.delete(near, slice(0, n // 50)) if n % 3 else near
        for a, b in ((x, y), (x, near)):
            fine = [near_duplicates.fine_bins(near_duplicates.fine_bag_of(w)) for w in (a, b)]
            assert near_duplicates.fine_apart(*fine) <= n - near_duplicates.shared_words(a, b)
    # texts of 4000 words of which half are of their own fill 256 bins alike, but not 4096
    x, y = (np.concatenate([np.arange(2000), rng.integers(0, 1 << 32, 2000)]).astype(np.uint32)
            for _ in "ab")
    bags = [near_duplicates.bag_of(w)[None].astype(np.int16) for w in (x, y)]
    assert near_duplicates.apart(*bags)[0] <= 800
    block = {"root": np.arange(2), "size": np.full(2, 4000), "node": np.arange(2), "salt": np.zeros(2),
             "bag": np.concatenate(bags), "fine": [near_duplicates.fine_bag_of(w) for w in (x, y)]}
    for nearest in (1, None):
        assert sum(len(a) for a, _ in near_duplicates.block_pairs(block, True, nearest, 0.8)) == 0


def test_fine_bins_leave_out_texts_of_frequent_words():
    """Variants of one text of common words, over a fifth apart: they fill 256 bins alike, and as many bins
    as words with counts to 3."""
    rng = np.random.default_rng(5)
    common = 1 + rng.zipf(1.3, 200_000) % 2_000
    base = rng.choice(common, 800).astype(np.uint32)
    texts = [base.copy() for _ in range(40)]
    for t in texts:
        t[rng.choice(800, 130, replace=False)] = rng.integers(2000, 4000, 130)
    block = {"root": np.arange(40), "size": np.full(40, 800), "node": np.arange(40), "salt": np.zeros(40),
             "bag": np.stack([near_duplicates.bag_of(w) for w in texts]).astype(np.int16),
             "fine": [near_duplicates.fine_bag_of(w) for w in texts]}
    left = [p for a, b in near_duplicates.block_pairs(block, True, None, 0.8) for p in zip(a, b)]
    links = [(i, j) for i in range(40) for j in range(i) if near_duplicates.similar(texts[i], texts[j])]
    exact = sum(800 - near_duplicates.shared_words(texts[i], texts[j]) <= 160
                for i in range(40) for j in range(i))
    print(f"{len(links)} links, {exact} of {40 * 39 // 2} pairs by words, {len(left)} by bins")
    assert {tuple(sorted(p, reverse=True)) for p in left} >= set(links)
    assert len(left) <= 0.75 * 40 * 39 // 2


def test_a_pair_comes_from_one_bucket_and_long_texts_without_bags():
    rng = np.random.default_rng(6)
    words = [rng.integers(0, 4000, n).astype(np.uint32) for n in (300, 700, 5000, 70_000)]
    fine = [near_duplicates.fine_bag_of(w) for w in words]
    assert (near_duplicates.bags_of([None] * 4, fine) == np.stack(
        [near_duplicates.bag_of(w) for w in words])).all()
    block = {"root": np.arange(3), "size": np.full(3, 10), "node": np.arange(3), "salt": np.zeros(3),
             "bag": np.ones((3, near_duplicates.BINS), np.int16), "fine": [b""] * 3,
             "keys": [[4, 7], [7, 4], [7, 1]]}
    two = {c: v[:2] for c, v in block.items()}  # the bucket of key 4
    got = [[(int(a), int(b)) for x, y in near_duplicates.block_pairs(
        held | {"key": key}, True, None, 0.8) for a, b in zip(x, y)] for held, key in ((two, 4), (block, 7))]
    assert got == [[(0, 1)], [(0, 2), (1, 2)]]


def test_sketches_are_gone_when_texts_move(documents, monkeypatch):
    """Aligning moves texts as large as the documents; the sketches of all rows are not kept beside it."""
    seen, linked = [], near_duplicates.linked

    def watched(pairs, texts, similarity):
        base = os.path.dirname(texts.inputFiles()[0].removeprefix("file:"))
        seen.append([n for n in os.listdir(os.path.dirname(base)) if n.startswith("near-sketches")])
        return linked(pairs, texts, similarity)

    def found():
        return {r.doc_id: r.class_id for r in near_duplicates.classes(documents(rows)).collect()}

    rows = [(i, " ".join(f"w{i // 5}x{j}" for j in range(30)) + f" e{i}") for i in range(60)]
    before = set(os.listdir(os.path.dirname(shared_dir(documents([]).sparkSession, "x"))))
    monkeypatch.setattr(near_duplicates, "linked", watched)
    assert found() == {i: i // 5 * 5 for i in range(60)}
    assert seen and not any(set(s) - before for s in seen)
    monkeypatch.setattr(near_duplicates, "MOVED", 0.1)  # many rounds
    assert found() == {i: i // 5 * 5 for i in range(60)}


def test_components(spark):
    r = random.Random(3)
    path = list(range(400))
    r.shuffle(path)
    edges = list(zip(path, path[1:])) + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    got = dict(near_duplicates.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(400)) and all(got[1000 + i] == 1000 for i in range(50))


TOXIC = ["grobian", "scoundrel", "vermin"]


def toxic_rows(n, seed):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"word{r.randrange(400)}" for _ in range(r.randint(5, 80))]
        bad = i % 5 == 0
        for _ in range(r.randint(1, 4) if bad else 0):
            words[r.randrange(len(words))] = r.choice(TOXIC) + r.choice(["", "s", "ish"])
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxicity_on_held_out(spark, documents):
    rows = toxic_rows(600, 4)
    labels = spark.createDataFrame(
        [(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (3, 1, None), (5, 1, 0), (99999, 0, 1)],
        "doc_id long, quality int, toxic int")
    docs = documents([(i, t) for i, t, _ in rows] + [(7000, None), (7001, ""), (None, "vermin vermin")])
    examples = toxicity.examples_of(docs, labels, ~held_out(3, 1))
    got = {r.doc_id: r for r in toxicity.scored(docs, examples).collect()}
    assert len(got) == 603 and all(0 <= r.score <= 1 for r in got.values())
    held = [(got[i].score >= toxicity.THRESHOLD, bool(y)) for i, _, y in rows
            if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(a == b for a, b in held) >= 0.98 * len(held)
    assert got[7000].score == got[7001].score < 0.1 and got[None].score > 0.7
    trained = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    assert all(set(r.neighbours) <= trained for r in got.values())
    none = toxicity.scored(docs, toxicity.examples_of(docs, labels.limit(0), ~held_out(3, 1)))
    assert {r.score for r in none.collect()} == {0.0}
    assert toxicity.scored(documents([]), examples).count() == 0


def test_neighbours_are_exact():
    r = np.random.default_rng(5)
    vectors = []
    for _ in range(900):
        terms = np.sort(r.choice(30, r.integers(1, 5), replace=False))
        w = r.integers(1, 4, len(terms)).astype(float)
        vectors.append((terms, w / np.linalg.norm(w)))
    dense = np.zeros((900, 30))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    index = toxicity.BlockMaxIndex(vectors, np.zeros(900), np.arange(900), 30)
    for q in range(0, 900, 9):
        cosine = np.round(dense @ dense[q], 12)
        cosine[q] = 0
        want = [i for i in np.lexsort((np.arange(900), -cosine)) if cosine[i] > 0]
        found, values = index.nearest(*vectors[q], without=q)
        assert values.tolist() == pytest.approx(cosine[want[:toxicity.NEIGHBOURS]].tolist())
        assert found.tolist() == want[:toxicity.NEIGHBOURS] or np.allclose(
            cosine[found], cosine[want[:toxicity.NEIGHBOURS]])


SHELL = """<!DOCTYPE html><html><head><title>t {i}</title><style>p{{x}}</style></head>
<body class="has-sidebar"><header class="site"><h1>Site</h1></header><nav><ul><li><a>Home {i}</a></ul></nav>
<div class="ad">Buy {i}</div><div class="layout"><div class="page"><article><h2>Title &amp; {i}</h2>
<p>First  paragraph\n{i}.<p>Second <b>bold{i}</b> &eacute;<br>line <script>var x="</p>";</script>end
<div class="box">Same words for everybody</div><form><p>Mail</p></form>
<ul><li>point one {i}</li><li>two</ul></article></div><aside>Side {i}</aside>
<section id="comments"><p>Reader says {i}</p></section></div><div role="dialog">Accept {i}</div></div>
<footer>&copy; {i}</footer></body></html>"""


def pages_table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_main_text(spark):
    want = "Title & {i}\n\nFirst paragraph {i}.\n\nSecond bold{i} é line end\n\npoint one {i}\n\ntwo"
    rows = [(i, f"https://Host.example/{i}", SHELL.format(i=i)) for i in range(6)]
    plain = [(10, "https://one.example/", SHELL.format(i=10)), (11, None, None), (12, "odd", ""),
             (13, "odd", "no <b>markup</b> at all & so on"), (None, "https://host.example/n", SHELL.format(i=99)),
             (14, "https://host.example/other", "<body><div><p>no article here</div></body>"),
             (15, "https://host.example/cut", "<article><p>never closed"), (3, rows[3][1], rows[3][2])]
    got = wrappers.extracted(pages_table(spark, rows + plain)).collect()
    assert len(got) == len(rows) + len(plain)
    text = {r.page_id: r.text for r in got}
    assert all(r.n_chars == len(r.text) for r in got)
    for i in range(6):
        assert text[i] == want.format(i=i)
    # a page that is alone on its host has nothing to tell the template by
    assert text[10] == want.format(i=10).replace("\n\npoint", "\n\nSame words for everybody\n\npoint")
    assert text[11] == text[12] == "" and text[13] == "no markup at all & so on"
    assert text[None] == want.format(i=99) and text[14] == "no article here"
    assert text[15] == "never closed"
    assert wrappers.extracted(pages_table(spark, [])).count() == 0


def test_copies_of_a_page_are_no_template(spark):
    page = ("<body><article><p>A first paragraph of the article.</p><ul><li>one point</li></ul>"
            "<section><p>A part of the article</p></section></article></body>")
    other = "<body><article><p>Other words {i}.</p></article></body>"
    want = "A first paragraph of the article.\n\none point\n\nA part of the article"
    rows = [(i, "https://copies.example/a", page) for i in range(5)]
    rows += [(10 + i, "https://mixed.example/a", page) for i in range(5)]
    rows += [(20 + i, f"https://mixed.example/{i}", other.format(i=i)) for i in range(3)]
    text = {r.page_id: r.text for r in wrappers.extracted(pages_table(spark, rows)).collect()}
    assert {text[i] for i in range(5)} == {text[10 + i] for i in range(5)} == {want}
    assert [text[20 + i] for i in range(3)] == [f"Other words {i}." for i in range(3)]


def test_pages_against_their_articles(spark):
    from html import unescape

    got = queries()["op2_wrapper_text"](spark, TINY).collect()
    source = {r.page_id: r.html for r in spark.read.parquet(f"{TINY}/pages.parquet").collect()}
    assert len(got) == len(source)
    for r in got:
        article = re.search("<article>(.*?)</article>", source[r.page_id], re.S)[1]
        blocks = [re.sub(r"\s+", " ", unescape(re.sub("<[^>]+>", "", b.replace("<br>", "\n")))).strip()
                  for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b)


def test_tree_matching():
    a = "(r(a(x)(y))(b)(c))"
    b = "(r(a(y))(d)(c))"
    # nodes in text order: r a x y b c / r a y d c
    assert wrappers.alignment(a, b) == (0, 1, -1, 2, -1, 4)
    assert wrappers.alignment("(p)", "(q)") == (-1,)


def warc(pages, damage=()):
    out = b""
    for i, body in pages:
        body = body if i not in damage else body[::-1]
        out += (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\n"
                f"Content-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"
    return out


@pytest.mark.parametrize("packed", [False, True])
def test_fixity_of_files(spark, tmp_path, packed):
    import gzip

    pages = [(i, f"page {i} ".encode() * (i % 50 + 1)) for i in range(400)]
    for side, damage in (("a", ()), ("b", (7, 399))):
        (tmp_path / side).mkdir()
        for part in range(2):
            rows = pages[200 * part:200 * part + 200]
            content = b"".join(gzip.compress(warc([r], damage), mtime=0) for r in rows) \
                if packed else warc(rows, damage)
            if part == 1 and side == "b" and not packed:
                content += warc([(500, b"added")])
            (tmp_path / side / f"{part}.warc").write_bytes(content)
    got = fixity.audit(*(fixity.file_records(spark, f"{tmp_path}/{s}") for s in "ab")).collect()
    found = {(r.page_id, r.kind) for r in got}
    if packed:  # compressed sizes may move what follows
        assert {7, 399} <= {r.page_id for r in got}
    else:
        assert found == {(7, "changed"), (399, "changed"), (500, "extra")}


def test_fixity_of_pages(spark):
    rows = [(i, f"https://h{i % 3}.example/{i}", "text " * (i % 40)) for i in range(300)]
    rows += [(None, None, None), (5, "https://h2.example/5", "again"), (5, "https://h2.example/5", "again")]
    pages = pages_table(spark, rows)
    from pyspark.sql import functions as F

    def damage(page_id, record):
        return F.when(page_id == 17, F.lit(b"")).when(page_id == 18, F.lit(None).cast("binary")
                                                      ).otherwise(record)

    got = fixity.audit(fixity.page_records(pages), fixity.page_records(pages, damage)).collect()
    assert {(r.page_id, r.kind) for r in got} == {(17, "changed"), (18, "missing")}
    back = fixity.audit(fixity.page_records(pages, damage), fixity.page_records(pages)).collect()
    assert {(r.page_id, r.kind) for r in back} == {(17, "changed"), (18, "extra")}
    whole = fixity.page_records(pages)
    assert fixity.audit(whole, whole).count() == 0
    assert fixity.audit(whole.limit(0), whole.limit(0)).count() == 0
    assert fixity.audit(whole, whole.limit(0)).count() == len(rows)


def test_language_model(spark, documents):
    r = random.Random(8)
    stems = ["ka", "lo", "mi", "tun", "ber", "sol"]
    draw = lambda: "".join(r.choice(stems) for _ in range(min(4, 1 + int(r.expovariate(1)))))
    rows = [(i, " ".join(draw() for _ in range(60))) for i in range(400)]
    docs = documents(rows + [(9000, None), (9001, ""), (9002, "Z" * 300 + " qx"), (None, "kalo"),
                             (9003, "kalo kalo"), (9003, "kalo kalo")])
    got = context_mixing.scored(docs, ~held_out(7, 2)).collect()
    assert len(got) == 406
    by = {x.doc_id: x for x in got}
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    train += [t for i, t in ((9000, ""), (9001, ""), (9002, "z" * 300 + " qx"), (9003, "kalo kalo"),
                             (9003, "kalo kalo")) if zlib.crc32(str(i).encode()) % 7 != 2] + ["kalo"]
    count = {}
    for t in train:
        for w in [*t.split(), "\n"]:
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    for i, t in rows[:40]:
        want = sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in [*t.split(), "\n"])
        assert by[i].base_score == pytest.approx(want) and by[i].train_tokens == n
        assert by[i].n_tokens == 61 and by[i].n_known == sum(
            w in count for w in [*t.split(), "\n"])
    assert by[9000].score == by[9001].score and by[9000].n_tokens == 1
    held = [by[i] for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2]
    # spelled far better than eight bits a byte, and near the word counts
    assert sum(x.score for x in held) > 1.3 * sum(x.base_score for x in held)
    assert all(x.bits_per_byte < 4 for x in held)
    assert context_mixing.scored(documents([]), ~held_out(7, 2)).count() == 0


def test_token_probabilities_sum_to_at_most_one(spark):
    import itertools

    words = [bytes(w) for n in (1, 2, 3) for w in itertools.product(b"abc", repeat=n)]
    r = random.Random(9)
    tokens = stored(spark.createDataFrame(
        [(bytearray(w), r.choice([0, 0, 1, 5, 40])) for w in words], "word binary, c long"), "t")
    bits = [x.bits for x in context_mixing.token_bits(tokens).collect()]
    assert 0.5 < sum(2.0 ** -b for b in bits) <= 1 + 1e-9


def test_pipeline(spark):
    out = queries()["pipeline"](spark, TINY)
    rows = out.orderBy("start").collect()
    assert rows and out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    start = 0
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, TINY).columns == docs.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def plain_chain(docs, items):
    """The pipeline's five rules without its operators: (doc_id, text, source) to (doc_id, start,
    n_tokens, ids_crc32)."""
    con = duckdb.connect()

    def by_sql(name):
        con.register("documents", pa.table({
            "doc_id": pa.array([d for d, _, _ in docs], pa.int64()),
            "text": pa.array([t for _, t, _ in docs], pa.string()),
            "source": pa.array([s for _, _, s in docs], pa.string())}))
        cur = con.execute(ORACLES[name])
        names = [c[0] for c in cur.description]
        return {r["doc_id"]: r for r in (dict(zip(names, row)) for row in cur.fetchall())}

    good = by_sql("op5_host_rules")
    docs = [d for d in docs if good[d[0]]["kept"]]

    def words(text):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    group = {d: d for d, _, _ in docs}

    def root(d):
        while group[d] != d:
            d = group[d]
        return d

    said = [(d, np.array([zlib.crc32(w.encode()) for w in words(t)], np.uint32)) for d, t, _ in docs]
    for i, (d, x) in enumerate(said):
        for e, y in said[:i]:
            longest = max(len(x), len(y))
            if len(x) and len(y) and near_duplicates.edits_within(x, y, int(longest * 0.2 + 1e-9)):
                a, b = sorted((root(d), root(e)))
                group[b] = a
    docs = [d for d in docs if root(d[0]) == d[0]]

    windows = set()
    for item in items:
        w = words(item)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}

    def cleaned(text):
        w = words(text)
        hit = [False] * len(w)
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit[i:i + n] = [True] * n
        at = [m.span() for m in re.finditer("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        out, last, i = "", 0, 0
        while i < len(w):
            if hit[i]:
                end = i
                while end < len(w) and hit[end]:
                    end += 1
                out, last, i = out + text[last:at[i][0]], at[end - 1][1], end
            else:
                i += 1
        return out + (text or "")[last:]

    before = docs
    docs = [(d, cleaned(t), s) for d, t, s in docs]
    assert [d[1] for d in docs] != [d[1] for d in before]
    mix = by_sql("op8_source_schedule")
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    out, start = [], 0
    for d, text, _ in sorted(docs):
        times = int(mix[d]["taken"] / mix[d]["size"] + 0.5) if mix[d]["size"] else 0
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for _ in range(times):
            out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    return out


def test_pipeline_equals_a_plain_chain(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text", "source")
    items = [r.text for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    want = plain_chain([tuple(r) for r in docs.collect()], items)
    got = sorted(map(tuple, corpus_pipeline.run(spark, TINY).collect()), key=lambda r: r[1])
    assert len(want) > 50 and got == want


def test_stages_on_odd_tables(spark, documents):
    """Null, empty and repeated rows, a null id, clashing columns, and no rows at all."""
    for docs in (documents(ODD), documents(ODD).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, TINY)
            assert out.count() >= 0, name
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns, name


def test_a_stage_leaves_the_tables_of_other_queries(spark):
    """Results built before, and read after, stages and whole runs."""
    lazy = {n: q(spark, TINY) for n, q in queries().items() if n != "pipeline"}
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, TINY)
    corpus_pipeline.run(spark, TINY)
    for name, df in lazy.items():
        assert df.count() > 0, name


def test_text_scores_depend_on_order_and_mix_every_byte(spark, documents):
    from pyspark.sql import functions as F

    # contexts reach over words: a phrase in its order is likelier than the same words shuffled
    rows = [(i, "alpha beta gamma delta epsilon zeta") for i in range(60)]
    rows += [(1000 + i, t) for i, t in enumerate(
        ["alpha beta gamma delta epsilon zeta", "zeta gamma alpha epsilon beta delta"])]
    got = {x.doc_id: x for x in context_mixing.scored(
        documents(rows), F.col("doc_id") < 1000).collect()}
    assert got[1000].base_score == pytest.approx(got[1001].base_score)
    assert got[1000].score > got[1001].score + 1


def test_long_texts_are_mixed_in_parts_with_all_their_contexts(monkeypatch):
    text = b" ".join([b"abc defgh"] * 900 + [b"x" * 20_000, b"end", b"\n"])
    cut = list(context_mixing.blocks([text]))
    small = list(context_mixing.blocks([text[:5000]]))
    assert len(cut) > 3 and len(small) == 1 and sum(len(b.data) for b in cut) == len(text)
    # the slots of a byte come from what stands before it, wherever a part ends
    for half in (0, 1):
        for k in range(context_mixing.CONTEXTS):
            whole = small[0].bases[half][k]
            assert (cut[0].bases[half][k][:5000] == whole).all()
    # a repeated phrase has the same slots in the first and the second part
    first, later = cut[0], cut[0].after
    assert later[0] == text[context_mixing.BLOCK - context_mixing.PAD:context_mixing.BLOCK]
    at = 10 * 100
    for half in (0, 1):
        for k in range(context_mixing.CONTEXTS):
            period = first.bases[half][k][at:at + 10]
            shift = -context_mixing.BLOCK % 10
            assert (cut[1].bases[half][k][shift:shift + 10] == period).all()


def test_one_of_each_copies_no_files(spark, documents, tmp_path):
    """A table in files is read again by the places of its rows; other frames are copied as before."""
    from pathlib import Path

    from tidemark.llm.common import Scratch, rows_of_files

    copies = near_copies(5, 12, 4)
    rows = [(10 + i, t) for i, (_, t) in enumerate(copies)] + ODD + [(10, copies[0][1]), (10, copies[0][1])]
    documents(rows).repartition(5).write.parquet(str(tmp_path / "documents"))
    docs = spark.read.parquet(str(tmp_path / "documents"))
    with Scratch(spark) as made:
        got = near_duplicates.one_of_each(docs, in_files=True)
        names = [Path(p).name for p in made.paths]
    assert not any(n.startswith("near-documents") for n in names)
    want = near_duplicates.one_of_each(documents(rows))
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    numbers = [r.row_id for r in rows_of_files(docs).select("row_id").collect()]
    assert len(set(numbers)) == len(numbers) == len(rows)
    assert rows_of_files(docs.crossJoin(spark.range(2))) is None and rows_of_files(documents(rows)) is None


def test_texts_are_chosen_only_where_few_are_in_pairs(documents, monkeypatch):
    stored, names = near_duplicates.stored, []
    monkeypatch.setattr(near_duplicates, "stored", lambda df, name, *a, **k: (
        names.append(name), stored(df, name, *a, **k))[1])
    r = random.Random(9)
    alone = [(1000 + i, " ".join(f"s{r.randrange(10**9)}" for _ in range(60))) for i in range(100)]
    copies = [(i, t) for i, (_, t) in enumerate(near_copies(6, 10, 4))]
    for rows, chosen in ((copies, False), (copies + alone, True)):
        del names[:]
        got = {x.doc_id: x.class_id for x in near_duplicates.classes(documents(rows)).collect()}
        assert ("near-texts" in names) == chosen
        assert [got[i] for i, _ in copies] == [i // 4 * 4 for i, _ in copies]
        assert all(got[i] == i for i, _ in rows if i >= 1000)


def test_one_round_shuffles_texts_once(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(near_duplicates, "stored", lambda df, *a, **k: plans.append(df) or df)
    texts = stored(spark.createDataFrame(
        [(i, 4, near_duplicates.packed(np.arange(4, dtype=np.uint32))) for i in range(6)],
        "node long, size int, words binary"), "t")
    pairs = stored(spark.createDataFrame([(0, 1), (2, 5)], "a long, b long"), "p")
    found = near_duplicates.linked(pairs, texts, 0.8)
    assert sorted(map(tuple, found.collect())) == [(0, 1), (2, 5)] and len(plans) == 1
    assert "ReusedExchange" in plans[0]._jdf.queryExecution().executedPlan().toString()
