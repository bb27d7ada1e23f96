"""Medians by rank selection and AUC by rank sums against plain computations."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfeat.functions import ranks
from riskfeat.operators import amount, model


def medians(spark, rows, schema="k string, v double"):
    return {r.k: r.median for r in ranks.exact_median(spark.createDataFrame(rows, schema), ["k"], "v").collect()}


def test_medians_equal_plain_ones(spark):
    rng = random.Random(1)
    rows = []
    for k in ["a", "b", "c", "d", None]:
        for _ in range(rng.randrange(1, 400)):
            rows.append((k, rng.choice([None, 0.0, rng.uniform(-3, 3), rng.expovariate(1) * 1e6, float(rng.randrange(5))])))
    rows += [("nothing", None), ("one", 7.5), ("two", -1.0), ("two", 4.0), ("zeros", 0.0), ("zeros", -0.0)]
    want = {}
    for k, v in rows:
        if v is not None:
            want.setdefault(k, []).append(v)
    got = medians(spark, rows)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(statistics.median(v), abs=1e-12) for k, v in want.items())


def test_infinite_and_nan_come_as_in_spark(spark):
    rows = [("a", float("inf")), ("a", 1.0), ("a", float("-inf")), ("b", float("nan")), ("b", 2.0), ("b", 1.0)]
    assert medians(spark, rows) == {"a": 1.0, "b": 2.0}


def test_a_user_with_a_third_of_all_rows(spark):
    """One group of very many values: its middle is found from one bucket, not by one window over the group."""
    df = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("k"),
                                     (F.xxhash64("id") % 1_000_003 / 7).alias("v"))
    got = {r.k: r.median for r in ranks.exact_median(df, ["k"], "v").collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in want)


def test_buckets_keep_the_order(spark):
    rng = random.Random(2)
    values = sorted([rng.uniform(-1, 1) * 10 ** rng.randrange(-9, 12) for _ in range(2000)] + [0.0, float("inf"), float("-inf")])
    got = [r.b for r in spark.createDataFrame([(v,) for v in values], "v double").select("v", ranks.bucket_of(F.col("v")).alias("b"))
           .orderBy("v").collect()]
    assert got == sorted(got)


def test_conditional_statistics_of_absent_windows(spark):
    df = spark.createDataFrame([(1, 5, 2.0), (1, 30, 9.0), (2, 1, 4.0), (None, 30, 1.0)], "user long, days_diff int, amount double")
    got = {r.user: r for r in amount.conditional_amount_stats(df, amount.day_window_conditions([3, 20])).collect()}
    assert set(got) == {1, None}
    assert (got[1].user_amount_med_3d, got[1].user_amount_med_20d, got[None].user_amount_med_20d) == (5.5, 9.0, 1.0)


def plain_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return float(((pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2))


def test_auc_of_every_round(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 300)
    m = np.round(rng.normal(0, 1, (300, 6)) + y[:, None] * np.linspace(0, 1, 6), 1)  # many ties
    df = spark.createDataFrame([(float(a), [float(v) for v in r]) for a, r in zip(y, m)], "_y double, m array<double>")
    got = {r.round: r.auc for r in model.round_aucs(df).collect()}
    assert got == pytest.approx({j: plain_auc(y, m[:, j]) for j in range(6)}, abs=1e-12)


def test_margins_are_those_of_the_cut_models_and_the_best_is_kept(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (400, 3))
    y = (x[:, 0] + rng.normal(0, 1.5, 400) > 0).astype(float)
    df = spark.createDataFrame([(float(a), [float(v) for v in r]) for a, r in zip(y, x)], "_y double, f array<double>")
    df = df.select("_y", array_to_vector("f").alias("features")).cache()
    fit, held = df.limit(200), df.subtract(df.limit(200))
    gbt = GBTClassifier(featuresCol="features", labelCol="_y", maxIter=12, maxDepth=4, seed=1).fit(fit)
    rows = model.round_margins(gbt, held).collect()
    raw = [r.raw for r in gbt.transform(held).select(vector_to_array("rawPrediction")[1].alias("raw")).collect()]
    assert sorted(r.m[-1] for r in rows) == pytest.approx(sorted(v / 1 for v in raw), abs=1e-9)
    ys, ms = np.array([r._y for r in rows]), np.array([r.m for r in rows])
    aucs = [plain_auc(ys, ms[:, j]) for j in range(ms.shape[1])]
    assert model.best_round(gbt, held).getNumTrees == int(np.argmax(aucs)) + 1
    assert model.best_round(gbt, held.where("_y = 1")).getNumTrees == 12


def test_patience():
    assert model.rounds_kept([.5, .6, .55, .58, .7], 200) == 5
    assert model.rounds_kept([.5, .6, .55, .58, .7], 2) == 2
    assert model.rounds_kept([.5, .5], 1) == 1
