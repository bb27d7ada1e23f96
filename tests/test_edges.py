"""Hand-made edge cases of the null / statistics rules and the skew-safe operators."""

import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskfeat.functions.stats import adjusted_skew, safe_div, sum0
from riskfeat.functions.timeparts import band_of, with_time_parts
from riskfeat.operators import amount, encode, gaps, pairs


def tm(d, h, m=0, s=0):
    return f"{d} days {h:02d}:{m:02d}:{s:02d}.000000000"


def test_skew_std_rules(spark):
    df = spark.createDataFrame(
        [(1, 5.0), (2, 3.0), (2, 3.0), (2, 3.0), (2, 3.0), (3, 1.0), (3, 2.0), (4, None)], "user long, amount double")
    out = {r.user: r for r in amount.user_amount_stats(df).collect()}
    assert out[1].user_amount_std is None and out[1].user_amount_skew is None
    assert out[2].user_amount_std == 0.0 and out[2].user_amount_skew == 0.0
    assert out[3].user_amount_skew is None
    assert out[4].user_amount_sum == 0.0 and out[4].user_amount_mean is None and out[4].user_amount_cnt == 0


def test_adjusted_skew_value(spark):
    xs = [1.0, 2.0, 3.0, 10.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").agg(adjusted_skew("x")).first()[0]
    a = np.array(xs)
    n = len(a)
    m2, m3 = ((a - a.mean()) ** 2).mean(), ((a - a.mean()) ** 3).mean()
    want = m3 / m2 ** 1.5 * np.sqrt(n * (n - 1)) / (n - 2)
    assert abs(got - want) < 1e-12


def test_safe_div_and_sum0(spark):
    df = spark.createDataFrame([(1, 0, None)], "a int, b int, c double")
    assert df.select(safe_div("a", "b")).first()[0] is None
    assert df.agg(sum0("c")).first()[0] == 0


def test_time_parts_and_bands(spark):
    rows = [(1, tm(3, h)) for h in (5, 6, 11, 12, 17, 18, 23)]
    df = with_time_parts(spark.createDataFrame(rows, "user long, tm_diff string"))
    got = [(r.hour, r.band) for r in df.select("hour", "band").collect()]
    assert got == [(5, 0), (6, 1), (11, 1), (12, 2), (17, 2), (18, 3), (23, 3)]
    r = df.select("days_diff", "timestamp", "week").first()
    assert r.days_diff == 3 and r.timestamp == 3 * 86400 + 5 * 3600 and r.week == 3


def test_day_window_boundary(spark):
    df = spark.createDataFrame([(1, 27, 1.0), (1, 28, 2.0)], "user long, days_diff int, amount double")
    r = amount.conditional_amount_stats(df, amount.day_window_conditions([27])).first()
    assert r.user_amount_cnt_27d == 1 and r.user_amount_sum_27d == 2.0


def _brute_gaps(rows, n):
    out = {}
    for u in sorted({r[0] for r in rows}):
        days = sorted(r[1] for r in rows if r[0] == u)
        g = [days[i] - days[i - n] for i in range(n, len(days))]
        out[u] = g
    return out


def test_interevent_gaps_match_brute_force(spark):
    rnd = random.Random(7)
    rows = [(u, rnd.randint(0, 12)) for u in range(6) for _ in range(rnd.choice([1, 2, 3, 5, 9, 20]))]
    df = spark.createDataFrame(rows, "user long, days_diff int")
    got = {r.user: r for r in gaps.interevent_gaps(df).collect()}
    for n, stem in gaps.GAP_LAGS.items():
        for u, g in _brute_gaps(rows, n).items():
            r = got[u].asDict()
            assert r[f"{stem}_sum"] == float(sum(g))
            if g:
                assert abs(r[f"{stem}_mean"] - np.mean(g)) < 1e-9
                assert r[f"{stem}_max"] == max(g) and r[f"{stem}_min"] == min(g)
            else:
                assert r[f"{stem}_mean"] is None
            if len(g) > 1:
                assert abs(r[f"{stem}_std"] - np.std(g, ddof=1)) < 1e-9
            else:
                assert r[f"{stem}_std"] is None


def test_row_lag_stats_match_plain_window(spark):
    rnd = random.Random(3)
    rows = []
    for u in range(5):
        for i in range(rnd.randint(1, 30)):
            d, h = rnd.randint(0, 3), rnd.randint(0, 23)
            v = None if rnd.random() < 0.15 else float(rnd.randint(0, 50))
            rows.append((u, len(rows), d, h, d * 86400 + h * 3600 + rnd.randint(0, 3), v))
    df = spark.createDataFrame(rows, "user long, row_id long, days_diff int, hour int, timestamp long, v double")
    got = {r.user: r for r in gaps.row_lag_stats(df, {"v": "g"}).collect()}
    w = Window.partitionBy("user").orderBy("timestamp", "row_id")
    want = {r.user: r for r in df.withColumn("x", F.col("v") - F.lag("v").over(w)).groupBy("user").agg(
        sum0("x").alias("s"), F.avg("x").alias("m"), F.max("x").alias("mx"), F.min("x").alias("mn"),
        F.stddev_samp("x").alias("sd")).collect()}
    for u, r in want.items():
        g = got[u]
        assert g.g_sum == r.s and g.g_max == r.mx and g.g_min == r.mn
        for a, b in ((g.g_mean, r.m), (g.g_std, r.sd)):
            assert (a is None and b is None) or abs(a - b) < 1e-9


def test_tuple_counts_count_null_tuples(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None), (1, "a", None)], "user long, x string, y string")
    assert pairs.tuple_counts(df, [("x", "y")]).first()["x_y_count_user"] == 2


def test_associated_diversity_all_null_is_zero(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "k", "a"), (3, "k", "b")], "user long, x string, y string")
    got = {r.user: r for r in pairs.associated_diversity(df, ["x", "y"]).collect()}
    assert got[1]["y_of_nunique_x"] == 0 and got[2]["y_of_nunique_x"] == 2


def test_stratified_folds_balanced_and_match_rank(spark):
    rows = [(u, 1 if u % 7 == 0 else 0) for u in range(500)]
    df = spark.createDataFrame(rows, "user long, label int")
    got = encode.stratified_folds(df, 5, 3)
    sizes = got.groupBy("label", "fold").count().collect()
    for lab in (0, 1):
        c = [r["count"] for r in sizes if r.label == lab]
        assert max(c) - min(c) <= 1
    w = Window.partitionBy("label").orderBy(F.md5(F.concat(F.col("user").cast("string"), F.lit("#3"))), "user")
    want = df.withColumn("f2", F.pmod(F.row_number().over(w) - 1, F.lit(5)))
    assert got.join(want, ["user", "label"]).where("fold <> f2").count() == 0


def test_target_encode_never_uses_own_fold(spark):
    rows = [(u, u % 2, f"c{u % 3}") for u in range(60)]
    tr = encode.stratified_folds(spark.createDataFrame(rows, "user long, label int, city string"), 5, 0)
    te = spark.createDataFrame([(100, "c1"), (101, "zz")], "user long, city string")
    out_tr, out_te = encode.target_encode(tr, te, ["city"], 5, 0, folded=tr)
    pdf = tr.toPandas()
    for r in out_tr.collect():
        other = pdf[(pdf.city == r.city) & (pdf.fold != r.fold)]
        assert abs(r.city_label_kfold_mean - other.label.mean()) < 1e-12
    te_rows = {r.user: r.city_label_kfold_mean for r in out_te.collect()}
    assert abs(te_rows[101] - pdf.label.mean()) < 1e-12
    assert abs(te_rows[100] - pdf[pdf.city == "c1"].label.mean()) < 1e-12


def test_band_of_expression(spark):
    got = spark.range(24).select(band_of(F.col("id").cast("int")).alias("b")).collect()
    assert [r.b for r in got] == [h // 6 for h in range(24)]
