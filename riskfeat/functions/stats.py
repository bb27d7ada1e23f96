"""Aggregate and scalar expressions shared by the operators.

The null rules of the feature definitions are decided here, once:

* a sum over only nulls is 0 (``sum0``), not null;
* standard deviation is the sample form, null for one value;
* skewness is the bias-adjusted form, null below three values, 0 at zero variance;
* a ratio with a zero or null denominator is null (``safe_div``);
* distinct counts ignore nulls.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Statistic sets by their names in the feature tables.
STATS4 = ("mean", "max", "min", "std")
STATS5 = ("sum", "mean", "max", "min", "std")


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum0(c: str | Column) -> Column:
    """Sum that is 0 (not null) when every input is null."""
    return F.sum(F.coalesce(col_(c), F.lit(0)))


def adjusted_skew(c: str | Column) -> Column:
    """Bias-adjusted sample skewness ``g1 * sqrt(n (n - 1)) / (n - 2)``.

    ``skewness`` is the population moment ratio g1; null when fewer than three
    values, 0 when all values are equal.
    """
    x = col_(c)
    n = F.count(x).cast("double")
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(F.var_pop(x) == 0, F.lit(0.0))
            .otherwise(F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2)))


def safe_div(a: str | Column, b: str | Column) -> Column:
    """``a / b`` as double; null when ``b`` is 0 or null."""
    return F.try_divide(col_(a).cast("double"), col_(b).cast("double"))


_STAT_FUNCS: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "max": F.max,
    "min": F.min,
    "sum": sum0,
    "med": F.median,
    "cnt": F.count,
    "count": F.count,
    "skew": adjusted_skew,
    "nunique": F.count_distinct,
    "nun": F.count_distinct,
    "nu": F.count_distinct,
}


def stat(name: str, c: str | Column) -> Column:
    return _STAT_FUNCS[name](col_(c))
