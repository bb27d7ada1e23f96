"""Exact medians by rank selection, with no value map of a group in memory.

Rows are reduced to (keys, value, count) first. Values fall into ordered buckets of about 4 % width; bucket totals and
their running sums (a few thousand per group at most) tell which one or two buckets hold the middle ranks. Only those
buckets' values are sorted, each bucket of each group on its own, so a group of very many values is split by bucket and
every step is a hash aggregation, a join or a sort that can spill.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets for each doubling of ``1 + abs(value)``.
STEPS = 16


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with null equal to null; the columns of ``left``, then the others of ``right``."""
    named = right.select(*[F.col(k).alias(f"__{k}") if k in keys else F.col(k) for k in right.columns])
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(named[f"__{k}"]) for k in keys])
    return left.join(named, on, how).drop(*[f"__{k}" for k in keys])


def bucket_of(value: Column) -> Column:
    """An order-preserving bucket number; NaN comes last, as in Spark's order."""
    x = value.cast("double")
    inner = F.signum(x) * F.floor(F.log2(1 + F.abs(x)) * STEPS)
    return (F.when(F.isnan(x), F.lit(1 << 20)).when(F.abs(x) == float("inf"), F.signum(x) * (1 << 19))
            .otherwise(inner).cast("int"))


def value_counts(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, value, c of the non-null values."""
    return rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))


def median_of_counts(counts: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """keys and the exact median of each group of (keys, value, c): the mean of the two middle values.

    Groups of null keys are groups like others; a group without a value is not in the result.
    """
    keys = list(keys)
    by_value = counts.select(*keys, value, "c", bucket_of(F.col(value)).alias("b"))
    totals = by_value.groupBy(*keys, "b").agg(F.sum("c").alias("n"))
    group = Window.partitionBy(*keys)
    upto = F.sum("n").over(group.orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
    middle = (totals.withColumns({"upto": upto, "total": F.sum("n").over(group)})
              .withColumns({"lo": F.expr("(total + 1) div 2"), "hi": F.expr("total div 2 + 1")})
              .where("upto >= lo and upto - n < hi")
              .select(*keys, "b", (F.col("upto") - F.col("n")).alias("before"), "lo", "hi"))
    inside = join_null_safe(by_value, middle, [*keys, "b"])
    running = F.sum("c").over(Window.partitionBy(*keys, "b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    placed = inside.withColumn("at", F.col("before") + running)
    holds = lambda r: F.max(F.when((F.col("at") >= F.col(r)) & (F.col("at") - F.col("c") < F.col(r)),
                                   F.col(value).cast("double")))
    return placed.groupBy(*keys).agg(holds("lo").alias("lo"), holds("hi").alias("hi")).select(
        *keys, ((F.col("lo") + F.col("hi")) / 2).alias(name))


def exact_median(rows: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """keys and the exact median of ``value`` of each group."""
    return median_of_counts(value_counts(rows, keys, value), keys, value, name)
