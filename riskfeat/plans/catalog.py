"""Named queries over the test tables: one per operator of the survey.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose fractional
columns are rounded (``finalize``) so that it can be compared with the SQL
oracle of ``oracle_sql.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (amount, base_features, columns, cross, embedding, encode, frequency, gaps, model, pairs,
                         profile, shared_key, text_vectors)
from ..sources import fixtures
from ..sources.readers import combine, parse_as
from . import common, feature_table, scoring
from .common import finalize, logs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: finalize(fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return register


# ---------------------------------------------------------------- T0
@query("user_amount_stats")
def q_user_amount_stats(spark, sf):
    """A1 on the transaction log."""
    _, trans, _ = logs(spark, sf)
    return amount.user_amount_stats(trans)


@query("time_parts")
def q_time_parts(spark, sf):
    """P1-P4 on the operation log."""
    op, _, _ = logs(spark, sf)
    return op.select("user", "row_id", "days_diff", "hour", "minute", "second", "timestamp",
                     "week", "half_month", "band")


@query("base_label_union")
def q_base_label_union(spark, sf):
    """J2 + U1: label joined to the train base, scoring base appended."""
    label, train, test = fixtures.label_and_bases(spark, sf)
    data, = combine(label, train, test)
    return data


# ---------------------------------------------------------------- T1a
def _window_query(w):
    def q(spark, sf):
        _, trans, _ = logs(spark, sf)
        return amount.conditional_amount_stats(trans, amount.day_window_conditions([w]))
    q.__doc__ = f"A2: amount statistics over days > {w}."
    return q


for _w in common.DAY_WINDOWS:
    query(f"amount_window_{_w}")(_window_query(_w))


@query("amount_hours_6_15")
def q_amount_hours(spark, sf):
    """A3: amount statistics over hours 6..15."""
    _, trans, _ = logs(spark, sf)
    return amount.conditional_amount_stats(trans, amount.hour_range_conditions(common.HOUR_RANGE_STARTS))


def _pivot_query(col):
    def q(spark, sf):
        _, trans, _ = logs(spark, sf)
        return amount.amount_pivot(trans, col)
    q.__doc__ = f"A4: amount count / sum pivoted by {col}."
    return q


for _c in common.PIVOT_COLS:
    query(f"amount_pivot_{_c}")(_pivot_query(_c))


@query("user_nunique_trans")
def q_nunique_trans(spark, sf):
    """A5 on the transaction log."""
    _, trans, _ = logs(spark, sf)
    return profile.user_block(trans, profile.nunique_exprs(common.TRANS_NUNIQUE_COLS, "trans"))


@query("user_nunique_op")
def q_nunique_op(spark, sf):
    """A5 on the operation log."""
    op, _, _ = logs(spark, sf)
    return profile.user_block(op, profile.nunique_exprs(common.OP_NUNIQUE_COLS, "op"))


@query("user_nonnull_count")
def q_nonnull(spark, sf):
    """A6 on the transaction log."""
    _, trans, _ = logs(spark, sf)
    return profile.user_block(trans, profile.nonnull_count_exprs(["ip", "type2", "tunnel_out", "amount"], "trans"))


@query("user_row_count")
def q_row_count(spark, sf):
    """A7 + M7: rows per user in both logs and their difference, on every user."""
    op, trans, base = logs(spark, sf)
    o = profile.user_block(op, [profile.row_count_expr("op")])
    t = profile.user_block(trans, [profile.row_count_expr("trans")])
    return (base.select("user").join(o, "user", "left").join(t, "user", "left")
            .withColumn("operation_transaction_count_gap", F.col("user_op_sum") - F.col("user_trans_sum")))


@query("null_profile")
def q_null_profile(spark, sf):
    """Null count / ratio of trans.ip, trans.type2, op.net_type, on every user."""
    op, trans, base = logs(spark, sf)
    t = profile.user_block(trans, profile.null_profile_exprs(["ip", "type2"], "trans"))
    o = profile.user_block(op, profile.null_profile_exprs(["net_type"], "op"))
    return base.select("user").join(t, "user", "left").join(o, "user", "left")


@query("time_profile_trans")
def q_time_profile_trans(spark, sf):
    """A9 on the transaction log."""
    _, trans, _ = logs(spark, sf)
    return profile.user_block(trans, profile.time_profile_exprs(common.TIME_PARTS, "tr"))


@query("time_profile_op")
def q_time_profile_op(spark, sf):
    """A9 on the operation log."""
    op, _, _ = logs(spark, sf)
    return profile.user_block(op, profile.time_profile_exprs(common.TIME_PARTS, "op"))


@query("first_day_of_type")
def q_first_day(spark, sf):
    """A10: first day with type1 = the fixture's category."""
    _, trans, _ = logs(spark, sf)
    return amount.first_day_of_category(trans, "type1", fixtures.FIRST_DAY_TYPE1)


# ---------------------------------------------------------------- T1b
def _select(df: DataFrame, pred) -> DataFrame:
    return df.select("user", *[c for c in df.columns if c != "user" and pred(c)])


@query("op_frequency")
def q_op_frequency(spark, sf):
    """A11-A14 on the operation log."""
    op, _, _ = logs(spark, sf)
    return _select(frequency.activity_frequency(op, "op"), lambda c: "_gap_" not in c)


@query("op_frequency_gap")
def q_op_frequency_gap(spark, sf):
    """W1-W3 on the operation log."""
    op, _, _ = logs(spark, sf)
    return _select(frequency.activity_frequency(op, "op"), lambda c: "_gap_" in c)


_BAND_NAMES = ("morning", "work_time", "afternoon", "night")


def _is_band(c: str) -> bool:
    return any(c.startswith(f"money_frequence_{b}_") for b in _BAND_NAMES)


@query("amount_frequency")
def q_amount_frequency(spark, sf):
    """A15 + A17: hourly and daily amount sums."""
    _, trans, _ = logs(spark, sf)
    return _select(frequency.amount_frequency(trans), lambda c: "_gap_" not in c and not _is_band(c))


@query("amount_band")
def q_amount_band(spark, sf):
    """Daily amount within each hour band."""
    _, trans, _ = logs(spark, sf)
    return _select(frequency.amount_frequency(trans), lambda c: "_gap_" not in c and _is_band(c))


@query("amount_gap")
def q_amount_gap(spark, sf):
    """W4 + W6: change of hourly and daily amount sums."""
    _, trans, _ = logs(spark, sf)
    return _select(frequency.amount_frequency(trans), lambda c: "_gap_" in c and not _is_band(c))


@query("amount_band_gap")
def q_amount_band_gap(spark, sf):
    """Change of the banded daily amount against the band's previous active day."""
    _, trans, _ = logs(spark, sf)
    return _select(frequency.amount_frequency(trans), lambda c: "_gap_" in c and _is_band(c))


# ---------------------------------------------------------------- T1c
@query("interevent_gap_trans")
def q_gap_trans(spark, sf):
    """W10 on the transaction log."""
    _, trans, _ = logs(spark, sf)
    return gaps.interevent_gaps(trans)


@query("interevent_gap_op")
def q_gap_op(spark, sf):
    """W10 on the operation log."""
    op, _, _ = logs(spark, sf)
    return gaps.interevent_gaps(op)


@query("base_ratios")
def q_base_ratios(spark, sf):
    """M1-M5 on the user table."""
    _, _, base = logs(spark, sf)
    return base_features.base_ratios(base).select("user", *base_features.BASE_RATIO_COLUMNS)


@query("base_centred")
def q_base_centred(spark, sf):
    """Age and using_time against whole-table max, min, median, mean."""
    _, _, base = logs(spark, sf)
    cols = [f"{c}_{s}" for c in base_features.CENTRED_COLS for s in ("max", "min", "median", "mean")]
    return base_features.base_centred(base).select("user", *cols)


@query("value_frequency")
def q_value_frequency(spark, sf):
    """A24-A26 on the user table."""
    _, _, base = logs(spark, sf)
    return base_features.value_frequency(base).select("user", *base_features.VALUE_FREQUENCY_COLUMNS)


# ---------------------------------------------------------------- T2a
@query("shared_key_amount")
def q_shared_key_amount(spark, sf):
    """A18-A20 on ip."""
    _, trans, _ = logs(spark, sf)
    return shared_key.shared_key_amount(trans, "ip")


@query("shared_key_amount_gap")
def q_shared_key_amount_gap(spark, sf):
    """W7-W9 on ip."""
    _, trans, _ = logs(spark, sf)
    return shared_key.shared_key_amount_gap(trans, "ip")


# ---------------------------------------------------------------- T2b
def _op_for_pairs(op: DataFrame) -> DataFrame:
    return common.nan_text(op, common.TEXT_COLS)


@query("pair_count")
def q_pair_count(spark, sf):
    """Distinct pairs per user, op and trans logs, on every user."""
    op, trans, base = logs(spark, sf)
    o = pairs.tuple_counts(_op_for_pairs(op), pairs.all_pairs(common.OP_PAIR_COLS))
    t = pairs.tuple_counts(trans, pairs.all_pairs(common.TRANS_PAIR_COLS))
    return base.select("user").join(o, "user", "left").join(t, "user", "left")


@query("triple_count")
def q_triple_count(spark, sf):
    """Distinct triples per user, on every user."""
    op, trans, base = logs(spark, sf)
    t = pairs.tuple_counts(trans, common.TRANS_TRIPLES)
    o = pairs.tuple_counts(_op_for_pairs(op), common.OP_TRIPLES)
    return base.select("user").join(t, "user", "left").join(o, "user", "left")


@query("associated_diversity")
def q_associated(spark, sf):
    """A23 on both logs, on every user."""
    op, trans, base = logs(spark, sf)
    o = pairs.associated_diversity(_op_for_pairs(op), common.OP_PAIR_COLS)
    t = pairs.associated_diversity(trans, common.TRANS_PAIR_COLS)
    return base.select("user").join(o, "user", "left").join(t, "user", "left")


# ---------------------------------------------------------------- T2c
def _cross(spark, sf):
    _, _, base = logs(spark, sf)
    return cross.cross_features(base_features.value_frequency(base))


@query("cross_nunique_entropy")
def q_cross_nunique_entropy(spark, sf):
    """A27 + A28."""
    df = _cross(spark, sf)
    return _select(df, lambda c: c.endswith("_nunique") or c.endswith("_ent"))


@query("cross_count_ratio")
def q_cross_count_ratio(spark, sf):
    """A29 + A30."""
    df = _cross(spark, sf)
    return _select(df, lambda c: c.endswith("_count") or c.endswith("_count_ratio"))


# ---------------------------------------------------------------- T2d
def _opn(spark, sf):
    op, _, _ = logs(spark, sf)
    return op


@query("token_counts")
def q_token_counts(spark, sf):
    """V1 long form over op_mode, op_type, op_device."""
    return text_vectors.token_counts(_opn(spark, sf), common.TEXT_COLS)


@query("tfidf_weights")
def q_tfidf_weights(spark, sf):
    """V2 long form: smooth idf, L2 norm per user and column."""
    return text_vectors.tfidf_weights(_opn(spark, sf), common.TEXT_COLS)


@query("svd_gram")
def q_svd_gram(spark, sf):
    """V3, first half: the Gram matrices of the count matrices."""
    return text_vectors.gram(text_vectors.token_counts(_opn(spark, sf), common.TEXT_COLS), value="count")


@query("svd_tfidf")
def q_svd_tfidf(spark, sf):
    """V3 on TF-IDF weights, 10 components per column (no SQL oracle)."""
    op = _opn(spark, sf)
    scores = text_vectors.svd_scores(text_vectors.tfidf_weights(op, common.TEXT_COLS),
                                     {c: f"svd_tfidf_{c}_op" for c in common.TEXT_COLS}, 10)
    return op.select("user").distinct().join(scores, "user", "left")


@query("svd_countvec")
def q_svd_countvec(spark, sf):
    """V3 on raw counts, 10 components per column (no SQL oracle)."""
    op = _opn(spark, sf)
    scores = text_vectors.svd_scores(text_vectors.token_counts(op, common.TEXT_COLS),
                                     {c: f"svd_countvec_{c}_op" for c in common.TEXT_COLS}, 10, value="count")
    return op.select("user").distinct().join(scores, "user", "left")


# ---------------------------------------------------------------- T3
_ENCODED = ["province", "city", "regist_type", "balance", "balance_avg"]


@query("label_encode")
def q_label_encode(spark, sf):
    """E1 on the user table's text columns."""
    _, _, base = logs(spark, sf)
    return encode.label_encode(base.select("user", *_ENCODED), _ENCODED)


@query("stratified_fold")
def q_stratified_fold(spark, sf):
    """5 folds, seed 0, on the training rows."""
    _, _, base = logs(spark, sf)
    return encode.stratified_folds(base.where("label IS NOT NULL").select("user", "label"), 5, 0)


def _target(spark, sf):
    _, _, base = logs(spark, sf)
    data = base.select("user", "label", "province", "city", "level", "balance_avg").withColumns(
        {n: encode.compound(a, b, n) for n, (a, b) in scoring.COMPOUNDS.items()})
    train, test = scoring.split(data)
    return encode.target_encode(train, test, encode.TARGET_COLS, 5, 0)


_TE_COLS = [f"{c}_label_kfold_mean" for c in encode.TARGET_COLS]


@query("target_encode_train")
def q_target_encode_train(spark, sf):
    """Out-of-fold label means on the training rows."""
    tr, _ = _target(spark, sf)
    return tr.select("user", "fold", *_TE_COLS)


@query("target_encode_test")
def q_target_encode_test(spark, sf):
    """Label means from all training rows on the scoring rows."""
    _, te = _target(spark, sf)
    return te.select("user", *_TE_COLS)


@query("duplicate_columns")
def q_duplicate_columns(spark, sf):
    """U4 on the user table: columns repeating an earlier column."""
    _, _, base = logs(spark, sf)
    return columns.duplicate_columns_df(spark, base.drop("label"))


@query("seq_sentences")
def q_seq_sentences(spark, sf):
    """O3 + F5 + V7: place of every amount in its user's sequence, for the five selections."""
    _, trans, _ = logs(spark, sf)
    parts = []
    for n, cond, _ in embedding.SELECTIONS:
        rows = trans if cond is None else trans.where(cond)
        parts.append(embedding.sequence(rows).select(
            F.lit(n).alias("selection"), "user", "run", "position",
            F.expr("try_cast(nullif(token, 'nan') as double)").alias("token")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("typed_text")
def q_typed_text(spark, sf):
    """Text columns of a log read as numbers, whole numbers also where written as ``3.0``."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    text = li.select(F.col("l_orderkey"), F.col("l_linenumber").cast("string").alias("line"),
                     F.col("l_quantity").cast("double").cast("string").alias("quantity"),
                     F.when(F.col("l_linenumber") > 1, F.col("l_discount").cast("string")).alias("discount"))
    types = {"line": "bigint", "quantity": "bigint", "discount": "double"}
    return text.select("l_orderkey", *[parse_as(c, t).alias(c) for c, t in types.items()])


@query("seq_embedding")
def q_seq_embedding(spark, sf):
    """V5 + V6: 16-dim skip-gram embedding of every user's amount sequence (no SQL oracle)."""
    _, trans, _ = logs(spark, sf)
    return embedding.user_embedding(trans, 16, "1_emb_")


@query("feature_table")
def q_feature_table(spark, sf):
    """The whole feature table of every user (no SQL oracle)."""
    return feature_table.feature_table(spark, sf)


# ---------------------------------------------------------------- T4
# Rounds and seeds of the registered model queries: those of job.py.
_MODEL_ITER = 100
_SEEDS = (0, 1, 2, 3, 4)


@query("cv_scores")
def q_cv_scores(spark, sf):
    """E5 + E6: out-of-fold probabilities of the training rows for each seed (no SQL oracle)."""
    return _stacked([r.oof.select(F.lit(s).alias("seed"), "user", "fold", "prob") for s, r in zip(_SEEDS, _job(spark, sf)[1])])


def _job(spark, sf) -> tuple[DataFrame, list[model.CvResult]]:
    """The documented job on the whole feature table, run anew for each call; the table is written once and read back."""
    return scoring.score_users(spark, sf, seeds=_SEEDS, max_iter=_MODEL_ITER, data=feature_table.feature_table(spark, sf))


def _stacked(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("seed_ensemble")
def q_seed_ensemble(spark, sf):
    """Scoring probabilities averaged over folds and five seeds (no SQL oracle)."""
    return _job(spark, sf)[0]


@query("feature_importance")
def q_feature_importance(spark, sf):
    """A31 + S4: mean importance per feature over the seeds and folds, largest first (no SQL oracle)."""
    return model.mean_importance(_stacked([r.importance for r in _job(spark, sf)[1]]))
