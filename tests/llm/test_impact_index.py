import numpy as np
import pyspark.sql.functions as F
import pytest

from riskfeat.llm import impact_index
from tests.llm.helpers import table


def brute(rows, k=20, every=20):
    """Rows of (vec_id, components); distinct, only those that take part."""
    ok = {(i, tuple(int(np.floor(64 * float(x))) for x in v)) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, q in ok:
        if i % every == 0:
            s = sorted(((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i))[:k]
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return sorted(out)


def got(spark, df, k=20):
    return sorted(map(tuple, impact_index.top_k(spark, df, F.col("vec_id") % 20 == 0, k).select(
        "query_id", "rank", "vec_id", "score").collect()))


def test_embeddings(spark):
    e = table(spark, "embeddings")
    assert got(spark, e) == brute([(r.vec_id, r.embedding) for r in e.collect()])


def test_ties_repeats_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.integers(-2, 3, 4) / 64]) for k in range(300)]
    rows += [(300 + k, [0.5, 0.5, 0.5, 0.5]) for k in range(60)]  # a common vector
    rows += rows[:30] + [(40, [1.0, 2.0, 3.0, 4.0]), (400, [0.1, 0.2])]
    rows += [(None, [1.0] * 4), (420, None), (440, [1.0, None, 1.0, 1.0]), (460, [float("nan")] * 4), (480, [float("inf")] * 4),
             (500, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).withColumn("rid", F.lit(1))
    assert got(spark, df) == brute(rows)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, -1.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert got(spark, df) == brute(rows)
    assert got(spark, df.limit(0)) == []
    assert got(spark, df.where("vec_id = 0")) == []


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(impact_index, "ROWS_A_BLOCK", 50)
    monkeypatch.setattr(impact_index, "QUERIES_A_BLOCK", 4)
    e = table(spark, "embeddings")
    assert got(spark, e) == brute([(r.vec_id, r.embedding) for r in e.collect()])


def test_stops_early_only_on_proof():
    rng = np.random.default_rng(9)
    x = (rng.normal(size=(3000, 16)) ** 3 * 20).astype(np.int64)
    ids = np.arange(3000)
    q, r, s = impact_index.search(x[:40], ids[:40], x, ids, list(impact_index.segments(x)), 10)
    for k in range(40):
        full = x @ x[k]
        order = [j for j in np.lexsort((ids, -full)) if j != k][:10]
        assert r[q == k].tolist() == order and s[q == k].tolist() == full[order].tolist()


def test_large_components_are_exact_or_refused():
    x = np.array([[1 << 29, 1], [1 << 29, 3], [-(1 << 29), 5]], np.int64)
    q, r, s = impact_index.search(x[:1], np.array([0]), x, np.arange(3), list(impact_index.segments(x)), 2)
    assert s.tolist() == [(1 << 58) + 3, -(1 << 58) + 5]
    with pytest.raises(OverflowError):
        impact_index.search(x * 8, np.arange(3), x * 8, np.arange(3), [], 2)
