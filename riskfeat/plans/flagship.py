"""The minimum end-to-end slice: logs -> time parts -> per-user amount block -> user table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import amount
from .common import finalize, logs


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user of the base table with its label and the A1 amount block (null if no transactions)."""
    _, trans, base = logs(spark, sf_dir)
    block = amount.user_amount_stats(trans)
    return finalize(base.select("user", "label", "province", "age").join(block, "user", "left"))
