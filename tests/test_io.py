"""Raw CSV inputs (S1, J2, U1) and the scored output."""

import tempfile

from pyspark.sql import functions as F

from riskfeat.operators import base_features, encode
from riskfeat.plans import common, feature_table, job, scoring
from riskfeat.sources import fixtures
from riskfeat.sources.readers import RAW_FILES, combine, load_raw

SF = "/root/testdata/sf0.001"


def _write_csv(df, path):
    df.coalesce(1).write.option("header", True).csv(path)


def _raw_inputs(spark):
    root = tempfile.mkdtemp(prefix="riskfeat-raw-")
    base = fixtures.base_table(spark, SF).drop("tm_diff")
    op = fixtures.op_log(spark, SF).drop("row_id")
    trans = fixtures.trans_log(spark, SF).drop("row_id")
    half = F.col("user") % 2 == 0
    parts = {
        "label": base.where("label IS NOT NULL").select("user", "label"),
        "train_base": base.where("label IS NOT NULL").drop("label"),
        "test_base": base.where("label IS NULL").drop("label"),
        "train_op": op.where(half), "test_op": op.where(~half),
        "train_trans": trans.where(half), "test_trans": trans.where(~half),
    }
    for k, df in parts.items():
        _write_csv(df, f"{root}/{RAW_FILES[k]}")
    return root, base, op, trans


def test_raw_csv_roundtrip(spark):
    root, base, op, trans = _raw_inputs(spark)
    raw = load_raw(spark, root)
    data, op2, trans2 = combine(raw["label"], raw["train_base"], raw["test_base"],
                                [raw["train_op"], raw["train_trans"]], [raw["test_op"], raw["test_trans"]])
    assert data.count() == base.count() and op2.count() == op.count() and trans2.count() == trans.count()
    assert dict(data.dtypes)["age"] == "double" and dict(trans2.dtypes)["amount"] == "double"
    assert data.where("label IS NULL").count() == base.where("label IS NULL").count()


def _small_input(spark):
    """The user table with two log blocks: enough features to score, quick to build."""
    op, trans, base = common.logs(spark, SF)
    data = (base_features.base_ratios(base.drop("service3_level")).join(feature_table.trans_user_block(trans), "user", "left")
            .join(feature_table.op_user_block(op), "user", "left"))
    return encode.label_encode(data, encode.string_columns(data))


def test_scores_written_as_csv(spark):
    out = tempfile.mkdtemp(prefix="riskfeat-score-") + "/sub"
    data = _small_input(spark)
    result, runs = scoring.score_users(spark, SF, seeds=(0,), k=3, max_iter=3, out=out, data=data)
    back = spark.read.option("header", True).csv(out)
    n_test = fixtures.base_table(spark, SF).where("label IS NULL").count()
    assert back.columns == ["user", "prob"] and back.count() == result.count() == n_test
    probs = [float(r.prob) for r in back.collect()]
    assert all(0.0 <= p <= 1.0 for p in probs)
    oof = runs[0].oof.collect()
    assert len({r.user for r in oof}) == len(oof)


def test_job_from_raw_csv(spark):
    root, base, _, _ = _raw_inputs(spark)
    out = tempfile.mkdtemp(prefix="riskfeat-job-") + "/sub"
    job.run(spark, root + "/", out, seeds=(0,), k=3, rounds=3, embeddings=False, svd=False)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == base.where("label IS NULL").count()
