"""Per-user amount statistics (A1-A4, A10).

Each block is one ``groupBy(key).agg(...)``: every aggregate here is
partial-aggregated map-side, so a user holding a large share of the rows sends
one partial row per map task, not its rows. Medians come from rank selection over
(user, value) counts (``functions.ranks``) and are joined to the block.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ranks
from ..functions.stats import stat, sum0

# Statistic order and names of the amount blocks.
STATS9 = ("mean", "std", "max", "min", "sum", "med", "cnt", "skew", "nunique")


def amount_stat_exprs(value: str = "amount", name_fn=None) -> list[Column]:
    """STATS9 of ``value`` but the median; names ``user_amount_{stat}``, nunique as ``user_ampunt_nunique``."""
    if name_fn is None:
        def name_fn(s: str) -> str:
            return "user_ampunt_nunique" if s == "nunique" else f"user_amount_{s}"
    return [stat(s, value).alias(name_fn(s)) for s in STATS9 if s != "med"]


def with_median(block: DataFrame, trans: DataFrame, key: str = "user", value: str = "amount",
                name: str = "user_amount_med") -> DataFrame:
    """``block`` (one row per key) with the exact median of ``value``."""
    return ranks.join_null_safe(block, ranks.exact_median(trans, [key], value, name), [key], "left")


def user_amount_stats(trans: DataFrame, key: str = "user", value: str = "amount") -> DataFrame:
    """A1: mean, std, max, min, sum, median, count, skew, nunique of amount per user."""
    return with_median(trans.groupBy(key).agg(*amount_stat_exprs(value)), trans, key, value)


def conditional_amount_stats(trans: DataFrame, conditions: Mapping[str, Column],
                             key: str = "user", value: str = "amount") -> DataFrame:
    """A2 / A3: STATS9 of amount over rows matching each condition, in one pass.

    ``conditions`` maps a name suffix (``'27d'``, ``'6d'``) to a boolean column.
    Rows matching none are filtered before the shuffle; a user with no row
    under one condition gets nulls for that suffix (as if absent from it).
    Names: ``user_amount_{mean,std,max,min,sum,med,cnt,skew,nun}_{suffix}``.
    """
    any_cond = None
    for c in conditions.values():
        any_cond = c if any_cond is None else (any_cond | c)
    exprs = []
    for suffix, cond in conditions.items():
        v = F.when(cond, F.col(value))
        present = F.count(F.when(cond, F.lit(1))) > 0
        for s in STATS9:
            if s == "med":
                continue
            label = "nun" if s == "nunique" else s
            exprs.append(F.when(present, stat(s, v)).alias(f"user_amount_{label}_{suffix}"))
    rows = trans.where(any_cond)
    # one row per (key, value, conditions met) before it counts for each of them
    met = F.array_compact(F.array(*[F.when(cond, F.lit(suffix)) for suffix, cond in conditions.items()]))
    counts = (rows.where(F.col(value).isNotNull()).select(key, value, met.alias("met")).groupBy(key, value, "met")
              .agg(F.count(F.lit(1)).alias("c")).select(key, value, "c", F.explode("met").alias("suffix"))
              .groupBy(key, "suffix", value).agg(F.sum("c").alias("c")))
    medians = (ranks.median_of_counts(counts, [key, "suffix"], value).groupBy(key)
               .agg(*[F.max(F.when(F.col("suffix") == s, F.col("median"))).alias(f"user_amount_med_{s}") for s in conditions]))
    return ranks.join_null_safe(rows.groupBy(key).agg(*exprs), medians, [key], "left")


def day_window_conditions(windows: Iterable[int], day: str = "days_diff") -> dict[str, Column]:
    """Trailing day windows: rows with ``day > w``, suffix ``'{w}d'``."""
    return {f"{w}d": F.col(day) > F.lit(w) for w in windows}


def hour_range_conditions(starts: Iterable[int], width: int = 9, hour: str = "hour") -> dict[str, Column]:
    """Hour ranges ``[h, h + width]``, suffix ``'{h}d'`` (the reference's naming)."""
    return {f"{h}d": F.col(hour).between(h, h + width) for h in starts}


def category_values(df: DataFrame, col: str) -> list:
    """Sorted distinct non-null values of a category column.

    Only the distinct values reach the driver (bounded by the category's
    cardinality, like the value list Spark's own ``pivot`` collects).
    """
    rows = df.where(F.col(col).isNotNull()).select(col).distinct().collect()
    return sorted(r[0] for r in rows)


def amount_pivot(trans: DataFrame, col: str, values: Iterable | None = None,
                 key: str = "user", value: str = "amount") -> DataFrame:
    """A4: count and sum of amount per user and category value, zero filled.

    Rows with a null category are dropped first, so a user with only null
    categories is absent (null after the left join). Written as conditional
    aggregates: one shuffle, partial aggregation, no second pivot stage.
    Names ``user_{col}_{value}_amount_{count,sum}``.
    """
    if values is None:
        values = category_values(trans, col)
    exprs = []
    for v in values:
        hit = F.col(col) == F.lit(v)
        exprs.append(F.count(F.when(hit, F.col(value))).alias(f"user_{col}_{v}_amount_count"))
        exprs.append(F.coalesce(sum0(F.when(hit, F.col(value))), F.lit(0.0))
                     .alias(f"user_{col}_{v}_amount_sum"))
    return trans.where(F.col(col).isNotNull()).groupBy(key).agg(*exprs)


def first_day_of_category(trans: DataFrame, col: str, value: str, key: str = "user",
                          day: str = "days_diff") -> DataFrame:
    """A10: first day on which the user has a row with ``col == value``."""
    return (trans.where(F.col(col) == F.lit(value))
            .groupBy(key).agg(F.min(day).alias(f"user_{col}_{value}_min_day")))
