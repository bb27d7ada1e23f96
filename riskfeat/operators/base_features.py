"""Row-wise features of the user table and value-frequency lookups.

Row-wise arithmetic is plain projection (whole-stage codegen, no shuffle).
Whole-table statistics enter as scalar subqueries (``DataFrame.scalar()``):
each is a one-row aggregate computed once and substituted as a constant, with
no join. Value counts of all columns are one long aggregation, looked up by
``lookup.attach``: small columns are broadcast after their size is measured, all
others share one join.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ranks
from ..functions.stats import safe_div
from . import lookup

# The column groups of the reference's user table.
PRODUCT_AMOUNTS = [f"product{i}_amount" for i in range(1, 7)]
CARD_COUNTS = ["card_a_cnt", "card_b_cnt", "card_c_cnt", "card_d_cnt"]
OP_COUNTS = ["op1_cnt", "op2_cnt"]
IP_RATIO_DENOMS = ["login_cnt_period1", "login_cnt_period2", "login_cnt_avg", "login_days_cnt", "login_cnt_period12"]
CENTRED_COLS = ["age", "using_time"]
SHARE_COLS = ["province", "city", "regist_type"]
COUNT_RATIO_COLS = ["age", "using_time", "balance"]
COUNT_COLS = ["product7_fail_cnt", "level", "acc_count", "login_cnt_avg"]


def row_sum(cols: Iterable[str]) -> Column:
    """Sum ignoring nulls; 0 when all are null (M3)."""
    total = None
    for c in cols:
        term = F.coalesce(F.col(c), F.lit(0))
        total = term if total is None else total + term
    return total


def row_max(cols: Iterable[str]) -> Column:
    """Max ignoring nulls; null only when all are null (M4)."""
    return F.greatest(*[F.col(c) for c in cols])


def base_ratios(base: DataFrame) -> DataFrame:
    """M1-M5 and the ip cross ratios (M2), appended to the user table."""
    df = base.withColumns({
        "product7_fail_ratio": safe_div("product7_fail_cnt", "product7_cnt"),
        "product_amount_sum": row_sum(PRODUCT_AMOUNTS).cast("double"),
        "product_amount_max": row_max(PRODUCT_AMOUNTS),
        "card_sum_cnt": row_sum(CARD_COUNTS),
        "card_max_cnt": row_max(CARD_COUNTS),
        "op_sum_cnt": row_sum(OP_COUNTS),
        "login_cnt_period12": F.col("login_cnt_period1") + F.col("login_cnt_period2"),
        "login_cnt": F.col("login_days_cnt") * F.col("login_cnt_avg"),
        "service_sum_cnt": F.col("service1_cnt") + F.col("service2_cnt"),
    })
    df = df.withColumns({
        "card_div_cnt": safe_div("card_a_cnt", "card_sum_cnt"),
        "op_div_cnt": safe_div("op1_cnt", "op2_cnt"),
        "acc_card_ratio": safe_div("acc_count", "card_sum_cnt"),
        "time_age": safe_div("using_time", "age"),
        "card_time": safe_div("card_sum_cnt", "using_time"),
        "op_time": safe_div("op_sum_cnt", "using_time"),
        "service_cnt_time": safe_div("service_sum_cnt", "using_time"),
        "service1_amtt_time": safe_div("service1_amt", "using_time"),
        "agreement_time": safe_div("agreement_total", "using_time"),
        "acc_time": safe_div("acc_count", "using_time"),
        "fail_time": safe_div("product7_fail_cnt", "using_time"),
        "cnt_time": safe_div("product7_cnt", "using_time"),
    })
    return df.withColumns({f"ip_cnt_{d}": safe_div("ip_cnt", d) for d in IP_RATIO_DENOMS})


BASE_RATIO_COLUMNS = [
    "product7_fail_ratio", "product_amount_sum", "product_amount_max", "card_sum_cnt", "card_max_cnt",
    "card_div_cnt", "op_sum_cnt", "op_div_cnt", "login_cnt_period12", "login_cnt", "acc_card_ratio",
    "time_age", "card_time", "op_time", "service_sum_cnt", "service_cnt_time", "service1_amtt_time",
    "agreement_time", "acc_time", "fail_time", "cnt_time"] + [f"ip_cnt_{d}" for d in IP_RATIO_DENOMS]


def base_centred(base: DataFrame, cols: Iterable[str] = CENTRED_COLS) -> DataFrame:
    """``{c}_max = max - c``, ``{c}_min = c - min``, ``{c}_median``, ``{c}_mean`` = c - stat.

    The statistics cover every row of the table (train and scoring rows).
    """
    cols, new = list(cols), {}
    long = base.select(F.explode(F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).cast("double").alias("value"))
                                           for c in cols])).alias("e")).select("e.*")
    medians = ranks.exact_median(long, ["col_name"], "value")
    for c in cols:
        stats = base.select(F.max(c).alias("mx"), F.min(c).alias("mn"), F.avg(c).alias("av"))
        new[f"{c}_max"] = stats.select("mx").scalar() - F.col(c)
        new[f"{c}_min"] = F.col(c) - stats.select("mn").scalar()
        new[f"{c}_median"] = F.col(c) - medians.where(F.col("col_name") == c).select("median").scalar()
        new[f"{c}_mean"] = F.col(c) - stats.select("av").scalar()
    return base.withColumns(new)


def value_frequency(base: DataFrame) -> DataFrame:
    """A24-A26 on the user table.

    * ``{c}_user_count`` (rows sharing the value) and ``{c}_count`` (that count
      over all non-null rows) for province, city, regist_type;
    * ``{c}_count`` (raw count) and ``{c}_count_ratio`` (over all rows) for age,
      using_time, balance; ``{c}_count`` for product7_fail_cnt, level,
      acc_count, login_cnt_avg.

    A null value gets null.
    """
    cols = [*SHARE_COLS, *COUNT_RATIO_COLS, *COUNT_COLS]
    names = [f"{c}_user_count" if c in SHARE_COLS else f"{c}_count" for c in cols]
    table = lookup.value_counts(base, cols)
    # one row for each column
    rows = {r["i"]: r for r in table.groupBy("i").agg(
        F.sum("n").alias("all"), F.sum(F.when(F.col("v").isNotNull(), F.col("n"))).alias("nonnull")).collect()}
    of = lambda c, what: F.lit(rows[cols.index(c)][what] if rows else None).cast("double")
    df = lookup.attach(base, cols, table, "n", names)
    return df.withColumns({
        **{f"{c}_count": F.col(f"{c}_user_count") / of(c, "nonnull") for c in SHARE_COLS},
        **{f"{c}_count_ratio": F.col(f"{c}_count") / of(c, "all") for c in COUNT_RATIO_COLS}})


VALUE_FREQUENCY_COLUMNS = (
    [x for c in SHARE_COLS for x in (f"{c}_user_count", f"{c}_count")]
    + [x for c in COUNT_RATIO_COLS for x in (f"{c}_count", f"{c}_count_ratio")]
    + [f"{c}_count" for c in COUNT_COLS])
