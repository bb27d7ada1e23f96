"""Inputs of the feature job on the test tables, and output normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeparts import with_time_parts
from ..sources import fixtures

# Column lists of the reference's feature job.
OP_NUNIQUE_COLS = ["op_type", "op_mode", "op_device", "ip", "net_type", "channel", "ip_3"]
TRANS_NUNIQUE_COLS = ["platform", "type1", "type2", "ip"]
OP_PAIR_COLS = ["op_type", "op_mode", "op_device", "ip", "channel", "net_type"]
TRANS_PAIR_COLS = ["platform", "tunnel_out", "type1", "type2", "ip", "amount"]
TRANS_TRIPLES = [("platform", "type1", "tunnel_out"), ("platform", "type2", "tunnel_out"),
                 ("amount", "type2", "ip"), ("amount", "type1", "ip"), ("amount", "tunnel_out", "ip")]
OP_TRIPLES = [("op_type", "op_mode", "op_device"), ("ip", "net_type", "channel"),
              ("ip_3", "net_type", "channel"), ("ip", "op_type", "op_device")]
TEXT_COLS = ["op_mode", "op_type", "op_device"]
TIME_PARTS = ["days_diff", "week", "hour"]
DAY_WINDOWS = [27, 23, 15]
HOUR_RANGE_STARTS = [6]
PIVOT_COLS = ["platform", "type1", "type2"]


def logs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(op, trans, base): the two logs with time parts, and the user table."""
    op = with_time_parts(fixtures.op_log(spark, sf_dir))
    trans = with_time_parts(fixtures.trans_log(spark, sf_dir))
    base = fixtures.base_table(spark, sf_dir)
    return op, trans, base


def nan_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """Category columns as text, null written as ``'nan'``."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in cols})


def finalize(df: DataFrame, digits: int = 6) -> DataFrame:
    """Integral columns as bigint, fractional ones rounded to ``digits`` places.

    Used only where results are compared with another engine: summation order
    differs between engines in the last bits.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)  # + 0.0 turns -0.0 into 0.0
        out.append(c.alias(f.name))
    return df.select(*out)
