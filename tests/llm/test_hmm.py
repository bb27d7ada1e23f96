import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from riskfeat.llm import hmm
from tests.llm.helpers import awkward, documents, table


def model(k=3, c=4, seed=0):
    rng = np.random.default_rng(seed)
    start, trans, emit = rng.random(k), rng.random((k, k)), rng.random((c, k))
    return start / start.sum(), trans / trans.sum(1, keepdims=True), emit / emit.sum(0)


def all_paths(seq, start, trans, emit):
    return [(p, start[p[0]] * emit[seq[0], p[0]] * math.prod(trans[a, b] * emit[s, b] for a, b, s in zip(p, p[1:], seq[1:])))
            for p in itertools.product(range(len(start)), repeat=len(seq))]


def test_likelihood_is_the_sum_over_all_paths():
    m = model()
    seqs = [np.array(s) for s in ([0], [1, 2, 3, 0, 1], [3, 3], [2, 0, 1, 1], [0, 1, 2, 3, 3, 2])]
    want = [math.log10(sum(p for _, p in all_paths(s, *m))) for s in seqs]
    assert np.allclose(hmm.log10_likelihood(seqs, *m), want)


def test_expected_counts_are_the_posterior_ones():
    start, trans, emit = m = model(seed=4)
    seqs = [np.array(s) for s in ([1, 2, 3, 0], [3], [2, 0, 1])]
    e_start, e_trans, e_emit = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for s in seqs:
        paths = all_paths(s, *m)
        total = sum(p for _, p in paths)
        for path, p in paths:
            e_start[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                e_trans[a, b] += p / total
            for c, k in zip(s, path):
                e_emit[c, k] += p / total
    for got, want in zip(hmm.expected(seqs, *m), (e_start, e_trans, e_emit)):
        assert np.allclose(got, want)


def reference(rows):
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    c = Counter(w for h, ws in zip(held, tokens) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
            for h, ws in zip(held, tokens)]


def check(spark, rows, **kw):
    r = hmm.score(spark, documents(spark, rows), **kw).collect()
    got = sorted((x.doc_id is None, x.doc_id or 0, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 5)) for x in r)
    want = sorted((i is None, i or 0, *f[:4], round(f[4], 5)) for (i, _), f in zip(rows, reference(rows)))
    assert got == want
    assert all(math.isfinite(x.score) and x.score <= 1e-9 for x in r)
    return r


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    r = check(spark, rows, iterations=3)
    held = [x for x in r if x.held_out]
    assert sum(x.score for x in held) > sum(x.base_score for x in held)


def test_awkward_rows(spark):
    check(spark, awkward() + [(k, "a b c " * k) for k in range(20, 45)], iterations=2)
    assert hmm.score(spark, documents(spark, []), iterations=1).count() == 0


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = hmm.score(spark, documents(spark, [(held, "never seen")]), iterations=1).collect()[0]
    assert (r.n_known, r.train_tokens, r.n_tokens) == (0, 0, 3) and math.isfinite(r.score)


def test_scores_are_a_distribution(spark):
    """All texts of one token and an end, and the rest: no more than 1 together."""
    rows = [(k, w) for k, w in enumerate(["aa", "ab", "bb", "aa ab", "bb bb", ""] * 3)]
    words = ["aa", "ab", "bb", "zz"]
    probe = [(1000 + 7 * k, t) for k, t in enumerate(["", *words, *(f"{a} {b}" for a in words for b in words)])]
    held = [(i, t) for i, t in zip((i for i in range(1000, 9000) if zlib.crc32(str(i).encode()) % 10 == 0), (t for _, t in probe))]
    r = hmm.score(spark, documents(spark, rows + held), iterations=3).where("doc_id >= 1000").collect()
    assert 0 < sum(10 ** x.score for x in r) <= 1 + 1e-9


@pytest.mark.parametrize("word", [b"a", b"ab", b"abc", "é".encode(), b"hello"])
def test_light_class_is_the_same_in_sql(spark, word):
    w = spark.createDataFrame([(word.decode(),)], "word string").selectExpr(
        "pmod(crc32(concat(substring(cast(word as binary), 1, 2), substring(cast(word as binary), -2, 2))), 1024) as k")
    assert w.first().k == hmm.light_class(word)
