"""The reference's whole program on its raw inputs: seven CSVs -> features -> scores CSV.

    python -m riskfeat.plans.job DATA_DIR OUT_DIR --checkpoint SHARED_DIR [--shuffled-gb 100] [--seeds 5] [--folds 5] [--rounds 100]

Train and test files are concatenated by name, every log row gets a
tie-break id (``monotonically_increasing_id``: unique, stable for a given
input), time parts are parsed from ``tm_diff``, the feature table is built
once and written, and encoding, training and scoring repeat per seed. Beside the
scores the job writes the out-of-fold scores, the importances and the AUC of
every seed, and removes its intermediate folders at the end.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparts import require_time_parts, with_time_parts
from ..operators import model
from ..session import checkpoint_dir, cluster_conf, get_spark, remove_folder
from ..sources.readers import combine, load_raw, write_table
from .feature_table import build_feature_table
from .scoring import score_users

# The type1 category whose first day is a feature in the reference.
FIRST_DAY_TYPE1 = "45a1168437c708ff"


def prepare_raw(spark: SparkSession, data_path: str, overrides=None,
                allow_unreadable: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(op, trans, base) from the raw CSVs: unioned, time parts added, tie-break id added."""
    raw = load_raw(spark, data_path, overrides, allow_unreadable)
    data, op, trans = combine(raw["label"], raw["train_base"], raw["test_base"],
                              [raw["train_op"], raw["train_trans"]], [raw["test_op"], raw["test_trans"]])
    if not allow_unreadable:
        op, trans = require_time_parts(op), require_time_parts(trans)
    op = with_time_parts(op.withColumn("row_id", F.monotonically_increasing_id()))
    trans = with_time_parts(trans.withColumn("row_id", F.monotonically_increasing_id()))
    return op, trans, data


def run(spark: SparkSession, data_path: str, out: str, seeds=(0, 1, 2, 3, 4), k: int = 5, rounds: int = 100,
        step: float = 0.1, embeddings: bool = True, svd: bool = True,
        first_day_value: str = FIRST_DAY_TYPE1, overrides=None, allow_unreadable: bool = False) -> DataFrame:
    """Build features, score the test users over ``seeds``, write ``user, prob`` as CSV to ``out``.

    Also written, as CSV: ``out``-oof (seed, user, fold, prob), ``out``-importance
    (feature, importance: mean over seeds and folds), ``out``-auc (seed, auc).
    """
    checkpoint_dir(spark)  # fails here, not after hours, if a cluster has no shared folder
    op, trans, base = prepare_raw(spark, data_path, overrides, allow_unreadable)
    features = build_feature_table(spark, op, trans, base, embeddings, svd, first_day_value=first_day_value)
    result, runs = score_users(spark, data_path, seeds=seeds, k=k, max_iter=rounds, step=step, out=out, data=features)
    oof, importance, aucs = None, None, []
    for s, r in zip(seeds, runs):
        own = r.oof.select(F.lit(s).alias("seed"), "user", "fold", "prob")
        oof = own if oof is None else oof.unionByName(own)
        importance = r.importance if importance is None else importance.unionByName(r.importance)
        aucs.append((s, model.auc(r.oof, features.where("label IS NOT NULL"))))
    write_table(oof, f"{out}-oof", fmt="csv")
    write_table(model.mean_importance(importance), f"{out}-importance", fmt="csv")
    write_table(spark.createDataFrame(aucs, "seed int, auc double"), f"{out}-auc", fmt="csv")
    return spark.read.schema(result.schema).option("header", True).csv(out)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("data_dir")
    ap.add_argument("out_dir")
    ap.add_argument("--checkpoint", required=True, help="folder for intermediate tables, shared by driver and executors")
    ap.add_argument("--shuffled-gb", type=int, default=100, help="expected shuffle volume after partial aggregation")
    ap.add_argument("--seeds", type=int, default=5)
    ap.add_argument("--folds", type=int, default=5)
    ap.add_argument("--rounds", type=int, default=100)
    args = ap.parse_args(argv)
    folder = f"{args.checkpoint.rstrip('/')}/job-{uuid.uuid4().hex}"
    spark = get_spark(extra={"spark.checkpoint.dir": folder, **cluster_conf(args.shuffled_gb * 1024 ** 3)})
    try:
        run(spark, args.data_dir, args.out_dir, seeds=tuple(range(args.seeds)), k=args.folds, rounds=args.rounds)
    finally:
        remove_folder(spark, folder)


if __name__ == "__main__":
    main()
