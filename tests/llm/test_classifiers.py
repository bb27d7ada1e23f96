import zlib

import numpy as np
import pytest

from riskfeat.llm import quality, toxicity
from tests.llm.helpers import awkward, documents, labels, table


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_linear_time_score_equals_sum_over_pairs():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=quality.SIZE), rng.normal(size=(quality.SIZE, quality.RANK)))
    idx, x = np.array([5, 9, 70, 3]), rng.normal(size=4)
    slow = m.w0 + (m.w[idx] * x).sum() + sum(m.v[idx[i]] @ m.v[idx[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert np.isclose(m.logit(np.zeros(4, int), idx, x, 1)[0], slow)


@pytest.mark.parametrize("name, sf, least", [("quality", "sf0.1", 0.95), ("toxicity", "sf0.1", 0.93)])
def test_held_out_accuracy(spark, name, sf, least):
    label = {"quality": "quality", "toxicity": "toxic"}[name]
    docs, known = (table(spark, t, f"/root/testdata/{sf}") for t in ("documents", "labels"))
    got = {"quality": quality, "toxicity": toxicity}[name].classify(spark, docs, known)
    r = got.join(known, "doc_id").where("held_out").toPandas()
    assert ((r.predicted == r[label]).mean()) > least
    assert got.count() == docs.count()


def test_misspelt_words_share_n_grams():
    texts = ["idiot"] * 20 + ["garden"] * 20
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.r_[0, np.cumsum([len(t) for t in texts])]
    r, j, x = toxicity.bag(data, off)
    m = toxicity.fit(r, j, x, np.repeat([1.0, 0.0], 20).astype(np.float32), 0.5)
    new = "idiiot gardden".split()
    z = m.logit(np.frombuffer("".join(new).encode(), np.uint8), np.array([0, 6, 13]))
    assert z[0] > 0 > z[1]


@pytest.mark.parametrize("op", [quality, toxicity])
def test_awkward_rows(spark, op):
    docs = documents(spark, awkward() + [(i, "good plain text here" if i % 2 else "BAD!! BAD!! idiot") for i in range(20, 60)])
    known = labels(spark, [(i, i % 2, 1 - i % 2) for i in range(20, 60)] + [(20, 1, 0), (None, 1, 1), (21, None, None), (2, 7, 7)])
    r = op.classify(spark, docs, known).toPandas()
    assert len(r) == docs.count()
    assert r.score.between(0, 1).all() and not r.held_out.isna().any()
    for x in r.itertuples():
        assert x.held_out == (False if np.isnan(x.doc_id) else held(int(x.doc_id)))
    assert set(r.columns) >= {"doc_id", "held_out", "score", "predicted"}


@pytest.mark.parametrize("op", [quality, toxicity])
def test_empty_tables(spark, op):
    none = documents(spark, [])
    assert op.classify(spark, none, labels(spark, [])).count() == 0
    r = op.classify(spark, documents(spark, [(1, "a b"), (2, "")]), labels(spark, [])).toPandas()
    assert np.allclose(r.score, 0.5)
