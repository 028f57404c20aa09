"""Quality rules, decontamination, token counts, ids and mixing against brute force."""

import hashlib
import random
import re
import sys
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import TINY
from llm.conftest import ODD
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, quality, token_counts, token_files
from tidemark.llm.queries import oracle_sql, queries, tokenizer_path
from tidemark.session import shared_dir

WORD = "[^\x20\x09-\x0D]+"


def sentences(seed, n, words=60, vocabulary=40):
    r = random.Random(seed)
    return [(i, " ".join(f"w{r.randrange(vocabulary)}" for _ in range(r.randint(1, words))))
            for i in range(n)]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, name):
    import check

    verdict = check.compare(spark, check.connect(TINY), TINY, queries()[name], oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


def base_counts(text):
    w = re.findall(WORD, text or "")
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    places = {}
    for i, x in enumerate(windows):
        places.setdefault(x, []).append(i)
    hit = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(hit), failed)


def test_quality_counts(documents):
    rows = ODD + [(100 + i, t) for i, t in sentences(1, 40, 200, 3)] + [
        (200, "line # one\nline # one\n\nother & | <b>\nline # one")]
    got = quality.judged(documents(rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((str(r.doc_id), *[r[n] for n in names]) for r in got) == sorted(
        (str(i), *base_counts(t)) for i, t in rows)


def test_host_verdict(documents):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(i, "bad", "spam") for i in range(60)] + [(100 + i, good, "spam") for i in range(4)]
    rows += [(200 + i, good, "fine") for i in range(50)] + [(300, "bad", "fine"), (301, good, None)]
    kept = {r.doc_id: r.kept for r in quality.judged(documents(rows)).collect()}
    assert not any(kept[r[0]] for r in rows[:64]) and all(kept[200 + i] for i in range(50))
    assert not kept[300] and kept[301]
    left = quality.kept_documents(documents(rows))
    assert sorted(r.doc_id for r in left.collect()) == [*range(200, 250), 301]
    assert left.columns == documents(rows).columns


def test_empty_tables(spark, documents):
    none = documents([])
    assert quality.judged(none).count() == 0 and quality.kept_documents(none).count() == 0
    assert mixing.mixed(mixing.sizes_of(none)).count() == 0
    assert token_counts.token_counts(none, tokenizer_path("piece_bpe_32k.model")).count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.digests(decontaminate.occurrences(none, bench)).count() == 0
    some = documents([(1, "a b c")])
    found = decontaminate.digests(decontaminate.occurrences(some, bench)).first()
    assert (found.n_words, found.n_hit, found.contaminated) == (3, 0, False)
    out = shared_dir(spark, "test-ids")
    token_files.write_ids(none, out, tokenizer_path("byte_bpe_50k.json"))
    assert token_files.digests(token_files.read_ids(spark, out)).count() == 0


def brute_finds(documents, items):
    pattern = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: pattern.findall(re.sub(
        "[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(item)
    out = []
    for i, text in documents:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[tuple(w[k:k + size])]
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((str(i), len(w), len(hit), hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("block", [8 << 20, 50])
def test_decontamination(spark, documents, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "PHRASE_BYTES", block)
    rows = ODD + [(100 + i, t.replace("w1", "W1,")) for i, t in sentences(2, 80, 60, 4)]
    long_item = rows[20][1] + " " + rows[21][1]
    items = [(1, long_item), (2, "w1 w2"), (3, None), (4, "--"), (5, long_item), (6, "same row"),
             (None, "w3 w3 w3")] + [(10 + i, t) for i, t in sentences(3, 5, 30, 4)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.digests(decontaminate.occurrences(documents(rows), bench)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.items_sha256) for r in got) == \
        brute_finds(rows, items)


def test_spans_are_cut(spark, documents):
    passage = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Before. {passage.upper()}, after"), (2, "clean text"), (3, None), (4, passage)]
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    out = decontaminate.cleaned(documents(rows), bench)
    got = {r.doc_id: (r.text, r.n_chars, r.n_words) for r in out.collect()}
    assert got == {1: ("Before. , after", 15, "x"), 2: ("clean text", 10, "x"),
                   3: (None, None, "x"), 4: ("", 0, "x")}
    assert out.columns == documents(rows).columns


def test_shards_hold_little_beside_the_texts(spark, documents):
    """A task's index, and one worker per task: an executor holds both once per core."""
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rng.choices(letters, k=5)) for _ in range(20_000)]
    texts = [" ".join(rng.choices(words, k=1000)) for _ in range(1000)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array(texts)],
                                      names=["doc_id", "text"])
    blocks = type("Blocks", (), {"value": [decontaminate.windows_of([("1", texts[3][:600])])]})
    tracemalloc.start()
    found = [x for b in decontaminate.find_in_shards(iter([rows]), blocks, ["doc_id"], "text")
             for x in b.column("item_ids").to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    print(f"peak {peak / 1e6:.0f} MB")
    assert [i for i, x in enumerate(found) if x] == [3] and peak < 180e6
    bench = spark.createDataFrame([(1, texts[3][:600])], "item_id long, text string")
    plan = decontaminate.cleaned(documents([(1, "a")]), bench)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("MapInArrow") == 1


def test_suffix_order_and_ranks():
    r = random.Random(4)
    for n in (1, 2, 7, 60, 300):
        text = np.array([r.randrange(1, 4) for _ in range(n)] + [0])
        want = sorted(range(n + 1), key=lambda i: text[i:].tolist())
        assert decontaminate.suffix_order(text).tolist() == want
        m = decontaminate.WaveletMatrix(text)
        at = np.arange(n + 1)
        value, rank = m.access(at)
        assert value.tolist() == text.tolist()
        assert rank.tolist() == [int((text[:i] == text[i]).sum()) for i in at]


def test_token_counts(documents):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(5)
    bits = ["a", "the", " ", "  ", "\n", "é", "中", "12", "###", "<s>", "</s>", "<0x0A>", "▁", ".", "\t",
            "　", "\x00", "😀"]
    rows = ODD + [(100 + i, "".join(r.choices(bits, k=r.randint(0, 30)))) for i in range(300)]
    rows.append((900, "the " * 700))  # a count above 255
    got = token_counts.token_counts(documents(rows), path).collect()
    assert sorted((str(x.doc_id), x.n_bytes, x.n_tokens) for x in got) == sorted(
        (str(i), len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows)


def test_token_files(spark, documents):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    r = random.Random(6)
    bits = ["a", "the", " ", "  ", "\n", "é", "中", "12", "'s", "don't", "<|endoftext|>", ".", "\t",
            "　", "\x00", "😀", " ", " \n", "\n\n", "\r\n", "'"]
    rows = ODD + [(100 + i, "".join(r.choices(bits, k=r.randint(0, 30)))) for i in range(300)]
    rows += sentences(8, 50)
    out = shared_dir(spark, "test-ids")
    token_files.write_ids(documents(rows), out, path)
    got = token_files.digests(token_files.read_ids(spark, out)).orderBy("start").collect()
    want = sorted((str(i), tuple(library.encode(t or "", add_special_tokens=False).ids) + (0,))
                  for i, t in rows)
    assert sorted((str(x.doc_id), x.n_tokens, x.ids_crc32) for x in got) == sorted(
        (i, len(t), zlib.crc32(np.array(t, "<u4").tobytes())) for i, t in want)
    ids = [x.doc_id for x in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    start = 0
    for x in got:
        assert x.start == start
        start += x.n_tokens
    # a filter on the id reaches the files
    plan = token_files.read_ids(spark, out).filter("doc_id = 105")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,105)" in plan
    assert token_files.read_ids(spark, out).filter("doc_id = 105").count() == 1


def brute_mix(rows):
    """taken per row index, from the closed form of the schedule."""
    size = [len(re.findall(WORD, t or "")) for _, t, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    goal, words = {}, 1.5 * sum(size)
    left = set(names)
    while left:
        level = (words - sum(goal.values())) / sum(weight[s] for s in left)
        full = {s for s in left if level * weight[s] > 2 * total[s]}
        goal |= {s: 2.0 * total[s] for s in full} if full else {s: level * weight[s] for s in left}
        left = left - full if full else set()
    return size, goal


def test_mixing(documents):
    rows = [(i, t, f"s{i % 4}" if i % 3 else "hot") for i, t in sentences(9, 300, 200)]
    rows += [(i, t, None) for i, t in sentences(10, 30)] + [(5, None, "hot"), (None, "a b", "é"),
                                                          (None, "a b", "é"), (1, "", "none")]
    size, goal = brute_mix(rows)
    got = mixing.mixed(mixing.sizes_of(documents(rows))).collect()
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted(
        (str(r[0]), n) for r, n in zip(rows, size))
    taken = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        assert r.target == pytest.approx(goal[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, words in goal.items():
        assert abs(taken[s] - words) <= mixing.BLOCK_WORDS + 1
    again = mixing.mixed(mixing.sizes_of(documents(rows, 7))).collect()
    assert {(r.doc_id, r.taken) for r in got if r.doc_id} == {
        (r.doc_id, r.taken) for r in again if r.doc_id}


def test_schedule_is_even_throughout(spark):
    goals = spark.createDataFrame([(0, 0, 600), (1, 600, 900), (2, 900, 900), (3, 900, 1024)],
                                  "source_no int, first long, past long")
    rows = mixing.slots(goals, 10).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(1024))
    seen = {0: 0, 1: 0, 3: 0}
    for i, r in enumerate(rows, 1):
        assert r["rank"] == seen[r.source_no]
        seen[r.source_no] += 1
        assert abs(seen[0] - i * 600 / 1024) < 6 and abs(seen[3] - i * 124 / 1024) < 6


def test_mixed_documents(documents):
    rows = [(i, t, f"s{i % 3}") for i, t in sentences(11, 90)]
    odd = [(500, "", "s0"), (501, None, None), (None, "a b c", "s1")]
    out = mixing.mixed_documents(documents(rows + odd))
    assert out.columns == documents(rows).columns
    n = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert set(n.values()) <= {1, 2} and 2 in n.values()
    none = mixing.mixed(mixing.sizes_of(documents([(1, None), (2, "")])))
    assert none.agg(F.sum("taken"), F.sum("target")).first() == (0, 0.0)


def test_encoding_holds_little_beside_the_texts(monkeypatch):
    """The numbers that stand for a batch's bytes and pieces are many times its texts; an executor holds
    them once per core."""
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [" ".join("".join(rng.choices(letters, k=6)) for _ in range(300)) for _ in range(1000)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array(texts)],
                                      names=["doc_id", "text"])
    monkeypatch.setattr(token_files, "TaskContext", type("Task", (), {
        "get": staticmethod(lambda: type("Part", (), {"partitionId": lambda self: 0})())}))
    path = tokenizer_path("byte_bpe_50k.json")
    token_files.encoder(path)
    token_files._powers.clear()
    tracemalloc.start()
    n = sum(b.num_rows for b in token_files.encode_rows(iter([rows]), path))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    print(f"peak {peak / 1e6:.0f} MB")
    assert n == 1000 and peak < 80e6


def test_new_pieces_cost_no_calls_of_their_own():
    """Ids of pieces are told apart as arrays: a call for each piece took longer than the library."""
    rng = random.Random(10)
    letters = "abcdefghijklmnopqrstuvwxyz"
    text = " ".join("".join(rng.choices(letters, k=6)) for _ in range(20_000)) + "\nend.\nof it"
    e = token_files.Encoder(tokenizer_path("byte_bpe_50k.json"))
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        ids, sizes = e.encode([text, "", "\n", "of it\nend"])
    finally:
        sys.setprofile(None)
    want = [e.library.encode(t, add_special_tokens=False).ids for t in (text, "", "\n", "of it\nend")]
    assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(x) for x in want]
    print(f"{calls} calls for 20000 pieces")
    assert calls < 10_000
