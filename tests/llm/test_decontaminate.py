import random

import numpy as np
import pyarrow as pa
import pytest

from riskfeat.llm import decontaminate
from tests.llm.helpers import awkward, documents, table


def slow_alignment(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max() / (2 * len(a))


def longest_run(a, b):
    return max((n for n in range(1, len(a) + 1) for i in range(len(a) - n + 1) for j in range(len(b) - n + 1)
                if a[i:i + n] == b[j:j + n]), default=0)


def test_alignment_equals_the_plain_recursion():
    rng = np.random.default_rng(2)
    pairs = [(rng.integers(0, 4, rng.integers(1, 9)).astype(np.uint64), rng.integers(0, 4, rng.integers(0, 14)).astype(np.uint64))
             for _ in range(200)]
    score, rows = decontaminate.align(pairs)
    assert np.allclose(score, [slow_alignment(a, b) for a, b in pairs])
    assert rows.tolist() == [longest_run(a.tolist(), b.tolist()) for a, b in pairs]


def words(rng, n):
    return ["".join(rng.choices("bcdfglmnprst", k=2)) + rng.choice("aeiou") + "".join(rng.choices("lmnrst", k=2)) for _ in range(n)]


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_exact_and_edited_copies_and_clean_texts(spark):
    rng = random.Random(6)
    items = [words(rng, rng.randrange(16, 60)) for _ in range(20)]
    docs, leaks = [], set()
    for k in range(60):
        body = words(rng, 200)
        if k < 40:
            own = list(items[k % 20])
            if k >= 20:  # every sixth word is another, one is lost, one is new
                own = [rng.choice(words(rng, 1)) if p % 6 == 5 else w for p, w in enumerate(own)]
                own[3:4] = []
                own.insert(9, "new")
            body[50:50] = [w.upper() + "," for w in own]
            leaks.add((k, k % 20))
        else:  # single words of items are no copy
            body[::9] = rng.choices(items[k % 20], k=len(body[::9]))
        docs.append((k, " ".join(body)))
    benchmark = bench(spark, [(i, " ".join(w)) for i, w in enumerate(items)])
    r = decontaminate.matches(spark, documents(spark, docs), benchmark).collect()
    assert {(x.doc_id, x.item_id) for x in r} == leaks
    assert all(x.score == 1 for x in r if x.doc_id < 20) and all(0.5 <= x.score < 1 for x in r if x.doc_id >= 20)
    kept = decontaminate.clean(spark, documents(spark, docs), benchmark)
    assert {x.doc_id for x in kept.collect()} == {k for k in range(60) if k >= 40}
    assert "score" in kept.columns


def test_a_passage_in_every_document_is_still_found(spark):
    rng = random.Random(7)
    item = " ".join(words(rng, 30))
    docs = [(k, " ".join(words(rng, 20)) + " " + item) for k in range(100)]
    r = decontaminate.matches(spark, documents(spark, docs), bench(spark, [(1, item)])).collect()
    assert len(r) == 100


def test_documents_that_hold_an_item(spark):
    docs, benchmark = table(spark, "documents"), table(spark, "benchmark")
    r = {(x.doc_id, x.item_id) for x in decontaminate.matches(spark, docs, benchmark).collect()}
    plain = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    items = [(x.item_id, plain(x.text)) for x in benchmark.collect()]
    want = {(d.doc_id, i) for d in docs.collect() for i, t in items if t in plain(d.text)}
    assert want and want <= r
    assert len(r) <= 2 * len(want)


def test_awkward_rows(spark):
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta"), (1, "alpha beta gamma delta epsilon zeta eta theta"),
             (None, "one two three four five six seven eight nine ten"), (3, None), (4, ""), (5, "too short"), (6, "word " * 50)]
    docs = documents(spark, awkward())
    r = {(x.doc_id, x.item_id) for x in decontaminate.matches(spark, docs, bench(spark, items)).collect()}
    assert r == {(None, 1), (1, None), (5, 6)}
    kept = [x.doc_id for x in decontaminate.clean(spark, docs, bench(spark, items)).collect()]
    assert sorted(kept) == [2, 3, 4, 6, 7]
    assert decontaminate.matches(spark, documents(spark, []), bench(spark, items)).count() == 0
    assert decontaminate.matches(spark, docs, bench(spark, [])).count() == 0
    assert decontaminate.clean(spark, docs, bench(spark, [])).count() == len(awkward())


@pytest.mark.parametrize("size", [100, 10_000_000])
def test_parts_of_the_benchmark(spark, monkeypatch, size):
    monkeypatch.setattr(decontaminate, "PART_BYTES", size)
    rng = random.Random(8)
    items = [(k, " ".join(words(rng, 20))) for k in range(10)]
    r = decontaminate.matches(spark, documents(spark, [(k, "intro here " + t) for k, t in items]), bench(spark, items)).collect()
    assert {(x.doc_id, x.item_id) for x in r} == {(k, k) for k in range(10)}


def test_common_seeds_are_taken_in_parts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "HITS", 3)
    monkeypatch.setattr(decontaminate, "JOBS", 2)
    rng = random.Random(9)
    items = decontaminate.Items([" ".join(words(rng, 12)) for _ in range(6)])
    items.choose(np.unique(np.concatenate(items.words)), np.ones(len(np.unique(np.concatenate(items.words))) + 1))
    rng = random.Random(9)
    texts = [" ".join(words(rng, 12)) for _ in range(6)]
    data = np.frombuffer("".join(t + "." for t in texts).encode(), np.uint8)
    off = np.r_[0, np.cumsum([len(t) + 1 for t in texts])]
    assert sorted((r, k) for r, k, *_ in decontaminate.find(items, data, off)) == [(k, k) for k in range(6)]


def hashed(text):
    return decontaminate.word_hashes(*decontaminate.folded(pa.array([text])))[1]


def test_words_of_other_scripts():
    assert (hashed("\u00c9COLE d\u2019\u00c9t\u00e9 \u00ab \u041c\u0418\u0420 \u00bb") == hashed("\u00e9cole d \u00e9t\u00e9, \u043c\u0438\u0440")).all()
    assert len(hashed("\u6f22\u5b57\u3001\u304b\u306a abc\u6f22x\u3002")) == 4 + 3
    assert (hashed("abc\u6f22x") == hashed("abc \u6f22 X")).all()
    assert len(hashed("\ud55c\uad6d\uc5b4 \ub9d0")) == 2 and len(hashed("\U00020000\U00020001")) == 2
    assert len(hashed("\u2026 \u2014 \uff01")) == 0


def test_bytes_that_are_no_text():
    bad = pa.StringArray.from_buffers(2, pa.py_buffer(np.array([0, 4, 7], np.int32)), pa.py_buffer(b"A\xff\xe3Bc d"))
    row, h = decontaminate.word_hashes(*decontaminate.folded(bad))
    assert row.tolist()[-2:] == [1, 1] and (h[-2:] == hashed("c d")).all()
    gap, cut = decontaminate.signs(np.frombuffer(b"a\xf0\xa0", np.uint8))  # a character cut off at the end
    assert len(gap) == len(cut) == 3


def test_copies_in_a_script_without_blanks(spark):
    rng = random.Random(21)
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))
    items = [han(30) for _ in range(5)]
    edited = [t[:10] + han(2) + t[13:] for t in items]
    docs = [(k, han(80) + edited[k] + "\u3002" + han(80)) for k in range(5)] + [(9, han(200))]
    r = decontaminate.matches(spark, documents(spark, docs), bench(spark, list(enumerate(items)))).collect()
    assert {(x.doc_id, x.item_id) for x in r} == {(k, k) for k in range(5)}


def test_every_third_word_replaced(spark):
    rng = random.Random(22)
    items = [words(rng, 36) for _ in range(40)]
    docs = [(k, " ".join(words(rng, 100) + [words(rng, 1)[0] if p % 3 == k % 3 else w for p, w in enumerate(own)] + words(rng, 100)))
            for k, own in enumerate(items)]
    benchmark = bench(spark, [(k, " ".join(own)) for k, own in enumerate(items)])
    r = decontaminate.matches(spark, documents(spark, docs), benchmark).collect()
    # a copy that begins and ends with its own words has a score of 0.5 and more
    want = {k for k, own in enumerate(items) if slow_alignment(own, docs[k][1].split()) >= 0.5}
    assert len(want) >= 13 and {(x.doc_id, x.item_id) for x in r} == {(k, k) for k in want}


def test_a_word_put_in_or_left_out_after_every_second(spark):
    rng = random.Random(23)
    items = [words(rng, 40) for _ in range(10)]
    fewer = [[w for p, w in enumerate(own) if p % 3 != 2] for own in items]
    more = [[x for p, w in enumerate(own) for x in ((w, "zz") if p % 2 else (w,))] for own in items]
    docs = [(k, " ".join(words(rng, 50) + t + words(rng, 50))) for k, t in enumerate(fewer + more)]
    benchmark = bench(spark, [(k, " ".join(own)) for k, own in enumerate(items)])
    r = {(x.doc_id, x.item_id) for x in decontaminate.matches(spark, documents(spark, docs), benchmark).collect()}
    want = {(k, k % 10) for k in range(20) if slow_alignment(items[k % 10], docs[k][1].split()) >= 0.5}
    assert want and r == want


def test_a_part_of_a_long_item(spark):
    rng = random.Random(24)
    items = [words(rng, 101) for _ in range(12)]
    size = [50, 13, 14, 12, 12, 20, 13, 13, 30, 12, 13, 13]  # halves, and runs of 12 words, which are not enough
    docs = []
    for k, own in enumerate(items):
        a = rng.randrange(len(own) - size[k] + 1)
        docs.append((k, " ".join(words(rng, 60) + own[a:a + size[k]] + words(rng, 60))))
    benchmark = bench(spark, [(k, " ".join(own)) for k, own in enumerate(items)])
    r = {(x.doc_id, x.item_id) for x in decontaminate.matches(spark, documents(spark, docs), benchmark).collect()}
    assert r == {(k, k) for k in range(12) if size[k] >= 13}
    kept = {x.doc_id for x in decontaminate.clean(spark, documents(spark, docs), benchmark).collect()}
    assert kept == {k for k in range(12) if size[k] < 13}


def test_seeds_against_the_alignment_of_all_pairs(spark):
    rng = random.Random(25)
    common = words(rng, 400)
    items = [rng.choices(common, k=rng.randrange(16, 60)) for _ in range(12)]
    docs = []
    for k in range(120):
        own = [w if rng.random() > rng.choice([0.1, 0.25, 0.33]) else rng.choice(common) for w in items[k % 12]]
        own = [w for w in own if rng.random() > 0.05]
        docs.append((k, " ".join(rng.choices(common, k=40) + own + rng.choices(common, k=40))))
    benchmark = bench(spark, [(k, " ".join(own)) for k, own in enumerate(items)])
    got = {(x.doc_id, x.item_id): x.score for x in decontaminate.matches(spark, documents(spark, docs), benchmark).collect()}
    pairs = [(d, i) for d, _ in docs for i in range(12)]
    number = {w: n + 1 for n, w in enumerate(common)}
    code = lambda ws: np.array([number[w] for w in ws], np.uint64)
    x, rows = decontaminate.align([(code(items[i]), code(docs[d][1].split())) for d, i in pairs])
    want = {p: v for p, v, n in zip(pairs, x, rows) if v >= 0.5 or n >= 13}
    assert len(want) > 60
    assert set(got) <= set(want) and len(set(want) - set(got)) <= len(want) // 50
    assert all(abs(got[p] - want[p]) < 1e-9 for p in got)
