"""Values that cannot be read, sequences across days, the cluster's folder, one-pass target means, best round."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfeat import session
from riskfeat.functions.timeparts import require_time_parts
from riskfeat.operators import embedding, encode, model
from riskfeat.sources.readers import BASE_SCHEMA, LABEL_SCHEMA, read_csv

SF = "/root/testdata/sf0.001"


def _csv(text):
    path = os.path.join(tempfile.mkdtemp(prefix="riskfeat-csv-"), "x.csv")
    with open(path, "w") as f:
        f.write(text)
    return path


def test_whole_numbers_with_a_point(spark):
    got = read_csv(spark, _csv("user,card_a_cnt,age\na,3.0,41\nb,,\nc,4,2.5\n"), BASE_SCHEMA).orderBy("user").collect()
    assert [(r.card_a_cnt, r.age) for r in got] == [(3, 41.0), (None, None), (4, 2.5)]


def test_label_with_a_point_stays_a_label(spark):
    assert [r.label for r in read_csv(spark, _csv("user,label\na,1.0\nb,0\n"), LABEL_SCHEMA).orderBy("user").collect()] == [1, 0]


@pytest.mark.parametrize("text, column", [("user,age\na,n/a\nb,3\n", "age"), ("user,level\na,level 2\n", "level"),
                                          ("user,card_a_cnt\na,3.5\n", "card_a_cnt")])
def test_unreadable_values_are_counted_and_refused(spark, text, column):
    with pytest.raises(ValueError, match=f"'{column}': 1"):
        read_csv(spark, _csv(text), BASE_SCHEMA)
    assert read_csv(spark, _csv(text), BASE_SCHEMA, allow_unreadable=True).where(f"{column} is null").count() == 1


def test_type_override(spark):
    got = read_csv(spark, _csv("user,level\na,level 2\n"), BASE_SCHEMA, {"level": T.StringType()}).first()
    assert got.level == "level 2"


def test_unreadable_times_are_refused(spark):
    good = spark.createDataFrame([("3 days 01:02:03.0",)], "tm_diff string")
    assert require_time_parts(good).count() == 1
    with pytest.raises(ValueError, match="1 values of tm_diff"):
        require_time_parts(good.unionByName(spark.createDataFrame([("yesterday",)], "tm_diff string")))


LOG = "user long, days_diff int, hour int, minute int, row_id long, amount double"


def test_sequences_cross_days_and_lose_nothing(spark):
    df = spark.createDataFrame([(1, 0, 23, 59, 7, 1.0), (1, 1, 0, 0, 3, 2.0), (1, 1, 0, 0, 1, None), (2, 5, 1, 1, 1, 9.0)], LOG)
    got = {r.user: r.tokens for r in embedding.sentences(df).collect()}
    assert got == {1: ["1.0", "nan", "2.0"], 2: ["9.0"]}  # 1.0 and what follows meet only across midnight
    cut = embedding.sentences(df, max_len=2).orderBy("user", "run").collect()
    assert [r.tokens for r in cut] == [["1.0", "nan"], ["2.0"], ["9.0"]]


def test_context_pairs_equal_brute_force(spark):
    from riskfeat.plans.common import logs
    _, trans, _ = logs(spark, SF)
    seqs = {}
    for r in trans.select("user", "days_diff", "hour", "minute", "row_id", "amount").collect():
        seqs.setdefault(r.user, []).append(((r.days_diff, r.hour, r.minute, r.row_id), str(r.amount)))
    pairs = sum(max(0, min(5, len(s) - 1 - i)) for s in seqs.values() for i in range(len(s)))
    got = [r.tokens for r in embedding.sentences(trans).collect()]
    assert sum(max(0, min(5, len(s) - 1 - i)) for s in got for i in range(len(s))) == pairs
    assert sorted(got) == sorted([t if t != "None" else "nan" for _, t in sorted(s)] for s in seqs.values())


def test_too_many_values_are_refused_not_trimmed(spark, monkeypatch):
    monkeypatch.setattr(embedding, "MAX_WEIGHTS", 7)
    df = spark.createDataFrame([(1, 0, 1, 1, 1, 1.0), (1, 0, 2, 1, 2, 2.0)], LOG)
    with pytest.raises(ValueError, match="2 distinct values"):
        embedding.user_embedding(df, 4, "e_", num_partitions=1)


class _Elsewhere:
    """A session of a cluster without a checkpoint folder."""

    class conf:
        get = staticmethod(lambda *_: None)

    class sparkContext:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_without_a_shared_folder_is_an_error(monkeypatch):
    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda **_: pytest.fail("a machine-local folder"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(_Elsewhere)
    for master in ("spark://x", "k8s://x", "local-cluster[3,2,1024]"):
        _Elsewhere.sparkContext.master = master
        with pytest.raises(RuntimeError):
            session.checkpoint_dir(_Elsewhere)


def test_partition_counts_are_bounded():
    assert session.cluster_conf(0)["spark.sql.shuffle.partitions"] == "200"
    assert session.cluster_conf(100 * 10 ** 12)["spark.sql.shuffle.partitions"] == "40000"


def test_job_settings(monkeypatch):
    from riskfeat.plans import job
    seen = {}
    monkeypatch.setattr(job, "get_spark", lambda extra: seen.update(extra) or "spark")
    monkeypatch.setattr(job, "run", lambda *a, **k: None)
    monkeypatch.setattr(job, "remove_folder", lambda s, p: seen.update(removed=p))
    job.main(["in", "out", "--checkpoint", "/shared", "--shuffled-gb", "2000"])
    assert seen["spark.checkpoint.dir"].startswith("/shared/job-") and seen["removed"] == seen["spark.checkpoint.dir"]
    assert seen["spark.sql.shuffle.partitions"] == "1000"
    with pytest.raises(SystemExit):
        job.main(["in", "out"])


def test_target_means_take_one_aggregation(spark):
    rows = [(u, u % 2, ["a", "b", None][u % 3], u % 4) for u in range(60)]
    tr = encode.stratified_folds(spark.createDataFrame(rows, "user long, label int, c string, d long"), 5)
    te = spark.createDataFrame([(100, "a", 9), (101, None, 1)], "user long, c string, d long")
    out, scored = encode.target_encode(None, te, ["c", "d"], folded=tr)
    local = [r.asDict() for r in out.collect()]
    for r in local:
        for f in ("c", "d"):
            y = [q["label"] for q in local if q[f] == r[f] and q["fold"] != r["fold"]]
            assert abs(r[f"{f}_label_kfold_mean"] - sum(y) / len(y)) < 1e-12
    s = {r.user: r for r in scored.collect()}
    assert s[100].d_label_kfold_mean == 0.5 and s[101].c_label_kfold_mean == 0.5
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 3  # one for each feature, one that deals the folds


def test_the_best_round_is_kept(spark):
    rows = [(float(u % 7), float(u % 5), float((u % 7 > 3) ^ (u % 11 == 0))) for u in range(220)]
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(rows, "a double, b double, _y double")).withColumn("_w", F.lit(1.0))
    fit, held = df.where("b < 3"), df.where("b >= 3")
    m = GBTClassifier(labelCol="_y", weightCol="_w", maxIter=12, maxDepth=3, seed=1).fit(fit)
    # the rule is held-out AUC: margins from each tree's own predictions, all pairs of rows
    own = held.collect()
    margin, aucs = [0.0] * len(own), []
    for tree, w in zip(m.trees, m.treeWeights):
        margin = [x + w * tree.predict(r.features) for x, r in zip(margin, own)]
        pos, neg = ([x for x, r in zip(margin, own) if r._y == y] for y in (1.0, 0.0))
        aucs.append(sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg)))
    assert [r.auc for r in sorted(model.round_aucs(model.round_margins(m, held)).collect())] == pytest.approx(aucs)
    cut = model.best_round(m, held)
    assert len(cut.treeWeights) == aucs.index(max(aucs)) + 1
    assert cut.transform(held).count() == held.count()
