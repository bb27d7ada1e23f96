"""Readers and writers for the raw inputs and the outputs.

The raw inputs are seven CSV files: label, train/test base, train/test
operation log, train/test transaction log. They are read with a declared
schema (no ``inferSchema`` pass over the data) and concatenated by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The file names of the raw inputs.
RAW_FILES = {
    "label": "train_label.csv",
    "train_base": "train_base.csv",
    "test_base": "testb_base.csv",
    "train_op": "train_op.csv",
    "train_trans": "train_trans.csv",
    "test_op": "testb_op.csv",
    "test_trans": "testb_trans.csv",
}

S, D, L = T.StringType(), T.DoubleType(), T.LongType()

LABEL_SCHEMA = T.StructType([T.StructField("user", S), T.StructField("label", T.IntegerType())])

OP_SCHEMA = T.StructType([T.StructField(n, S) for n in (
    "user", "op_type", "op_mode", "op_device", "ip", "net_type", "channel", "ip_3", "tm_diff")])

TRANS_SCHEMA = T.StructType([
    T.StructField("user", S), T.StructField("platform", S), T.StructField("tunnel_out", S),
    T.StructField("amount", D), T.StructField("tm_diff", S), T.StructField("type1", S),
    T.StructField("ip", S), T.StructField("type2", S)])

_BASE_FIELDS = [
    ("user", S), ("age", D), ("level", L),
    ("using_time", D), ("regist_type", S), ("card_a_cnt", L), ("card_b_cnt", L), ("card_c_cnt", L),
    ("op1_cnt", L), ("op2_cnt", L), ("card_d_cnt", L), ("agreement_total", L),
    ("service1_cnt", L), ("service1_amt", D), ("service2_cnt", L),
    ("acc_count", L), ("login_cnt_period1", L), ("login_cnt_period2", L), ("ip_cnt", L),
    ("login_cnt_avg", D), ("login_days_cnt", L), ("province", S), ("city", S), ("balance", S),
    ("balance_avg", S),
    ("service3_level", S), ("product1_amount", D), ("product2_amount", D),
    ("product3_amount", D), ("product4_amount", D), ("product5_amount", D), ("product6_amount", D),
    ("product7_cnt", L), ("product7_fail_cnt", L)]
BASE_SCHEMA = T.StructType([T.StructField(n, t) for n, t in _BASE_FIELDS])


def parse_as(col: str, kind: T.DataType | str) -> Column:
    """Text as ``kind``; whole-number kinds also take ``3.0``. Null where the text is no such value."""
    kind = kind.simpleString() if isinstance(kind, T.DataType) else kind
    text = F.trim(F.col(f"`{col}`"))
    plain = text.try_cast(kind)
    if kind not in ("int", "bigint", "smallint", "tinyint"):
        return plain
    number = text.try_cast("double")
    return F.coalesce(plain, F.when(number == F.floor(number), number.try_cast(kind)))


def unreadable(raw: DataFrame, types: dict[str, T.DataType]) -> dict[str, int]:
    """How many values of each typed column are text that is neither empty nor such a value (one pass)."""
    typed = [c for c in raw.columns if c in types and types[c] != S]
    if not typed:
        return {}
    bad = raw.agg(*[F.count(F.when((F.trim(F.col(f"`{c}`")) != "") & parse_as(c, types[c]).isNull(), 1)).alias(c)
                    for c in typed]).first()
    return {c: bad[c] for c in typed if bad[c]}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, overrides: dict[str, T.DataType] | None = None,
             allow_unreadable: bool = False) -> DataFrame:
    """Header CSV; declared columns are typed by *name*, so column order is free.

    Every column is read as text; the declared ones are then typed
    (``parse_as``: ``3.0`` is a whole number), undeclared ones stay text.
    ``overrides`` replaces declared types, e.g. ``{"level": StringType()}``.
    Values that cannot be read are counted and the read fails with column and
    count; with ``allow_unreadable`` they become null.
    """
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    types = {f.name: f.dataType for f in schema.fields} | (overrides or {})
    if not allow_unreadable and (bad := unreadable(raw, types)):
        raise ValueError(f"{path}: unreadable values (column: count) {bad}; give the column another type or allow them")
    return raw.select(*[(parse_as(c, types[c]) if c in types and types[c] != S else F.col(f"`{c}`")).alias(c)
                        for c in raw.columns])


def load_raw(spark: SparkSession, data_path: str, overrides: dict[str, T.DataType] | None = None,
             allow_unreadable: bool = False) -> dict[str, DataFrame]:
    """The seven raw inputs as DataFrames. ``overrides`` holds for every file with such a column."""
    schemas = {"label": LABEL_SCHEMA, "train_base": BASE_SCHEMA, "test_base": BASE_SCHEMA,
               "train_op": OP_SCHEMA, "test_op": OP_SCHEMA, "train_trans": TRANS_SCHEMA,
               "test_trans": TRANS_SCHEMA}
    root = data_path.rstrip("/")
    return {k: read_csv(spark, f"{root}/{f}", schemas[k], overrides, allow_unreadable) for k, f in RAW_FILES.items()}


def combine(label: DataFrame, train_base: DataFrame, test_base: DataFrame,
            train_logs: list[DataFrame] = (), test_logs: list[DataFrame] = ()):
    """J2 + U1: label joined to the train base, test rows appended (label null).

    Returns ``(data, *logs)`` with each train log unioned with its test log.
    """
    data = (label.join(train_base, "user", "left")
            .unionByName(test_base, allowMissingColumns=True))
    logs = [tr.unionByName(te, allowMissingColumns=True) for tr, te in zip(train_logs, test_logs)]
    return (data, *logs)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Write a result or feature block (CSV with header, or Parquet)."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
