"""Views with the column roles of the risk logs over the generic test tables.

The test tables (``events``, ``customer``) carry no risk-log columns, so the
three inputs of the feature job are derived from them with plain SQL
expressions that Spark and DuckDB both accept:

* ``op``    - operation log, one row per event;
* ``trans`` - transaction log, events other than ``error``;
* ``base``  - one row per customer, with a label (null = scoring row).

The same expression lists drive the Spark DataFrames (``selectExpr``) and the
oracle CTEs, so a difference between the two sides can only come from the
operators under test. Everything is a per-row projection: the views scale
with the tables and keep Parquet column pruning and filter pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the fixture definition (column expressions).
K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
DAYS = "(CAST(dayofyear(ts) AS INT) - 1)"

TM_DIFF = (
    "concat(CAST(days AS STRING), ' days ', "
    "lpad(CAST(hour(ts) AS STRING), 2, '0'), ':', "
    "lpad(CAST(minute(ts) AS STRING), 2, '0'), ':', "
    "lpad(CAST(CAST(floor(second(ts)) AS INT) AS STRING), 2, '0'), '.000000000')"
)

OP_COLUMNS = [
    ("user", "user_id"),
    ("row_id", "event_id"),
    ("tm_diff", TM_DIFF),
    ("op_type", "event_type"),
    ("op_mode", "CASE WHEN k % 17 = 0 THEN NULL ELSE concat('mode', CAST(k % 10 AS STRING)) END"),
    ("op_device", "CASE WHEN event_id % 11 = 0 THEN NULL ELSE concat('dev', CAST(event_id % 7 AS STRING)) END"),
    ("ip", "CASE WHEN k % 13 = 0 THEN NULL ELSE concat('ip', CAST(k AS STRING)) END"),
    ("ip_3", "CASE WHEN k % 13 = 0 THEN NULL ELSE concat('net', CAST(CAST(floor(k / 10) AS INT) AS STRING)) END"),
    ("net_type", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('n', CAST(event_id % 3 AS STRING)) END"),
    ("channel", "concat('c', CAST(CAST(floor(event_id / 7) AS BIGINT) % 4 AS STRING))"),
]

TRANS_COLUMNS = [
    ("user", "user_id"),
    ("row_id", "event_id"),
    ("tm_diff", TM_DIFF),
    ("amount", "CASE WHEN event_id % 101 = 0 THEN NULL ELSE value END"),
    ("platform", "concat('p', CAST(event_id % 4 AS STRING))"),
    ("tunnel_out", "CASE WHEN k % 19 = 0 THEN NULL ELSE concat('t', CAST(k % 6 AS STRING)) END"),
    ("type1", "event_type"),
    ("type2", "CASE WHEN event_id % 9 = 0 THEN NULL ELSE concat('y', CAST(k % 5 AS STRING)) END"),
    ("ip", "CASE WHEN k % 13 = 0 THEN NULL ELSE concat('ip', CAST(k AS STRING)) END"),
]
TRANS_FILTER = "event_type <> 'error'"

# The category value standing in for the literal type1 code of the first-day feature.
FIRST_DAY_TYPE1 = "purchase"


def _base_columns() -> list[tuple[str, str]]:
    c = "c_custkey"
    cols = [
        ("user", c),
        ("label", f"CASE WHEN {c} % 5 = 0 THEN NULL WHEN c_acctbal < 0 OR {c} % 7 = 0 THEN 1 ELSE 0 END"),
        ("province", "concat('prov', CAST(c_nationkey AS STRING))"),
        ("city", f"CASE WHEN {c} % 29 = 0 THEN NULL ELSE concat('city', CAST({c} % 40 AS STRING)) END"),
        ("regist_type", "c_mktsegment"),
        ("age", f"CASE WHEN {c} % 23 = 0 THEN NULL ELSE CAST(18 + {c} % 50 AS DOUBLE) END"),
        ("using_time", f"CAST(({c} * 7) % 90 AS DOUBLE)"),
        ("level", f"{c} % 4"),
        ("balance", "concat('level ', CAST(CAST(floor(c_acctbal / 1000) AS INT) AS STRING))"),
        ("balance_avg", "concat('level ', CAST(CAST(floor(c_acctbal / 2500) AS INT) AS STRING))"),
        ("service3_level", f"CASE WHEN {c} % 20 = 0 THEN 'level 1' ELSE NULL END"),
        ("product7_cnt", f"{c} % 9"),
        ("product7_fail_cnt", f"{c} % 4"),
    ]
    for j in range(1, 7):
        cols.append((f"product{j}_amount",
                     f"CASE WHEN {c} % {10 + j} = 0 THEN NULL ELSE CAST(({c} * {2 * j + 3}) % 1000 AS DOUBLE) END"))
    for j, name in enumerate("abcd", start=1):
        cols.append((f"card_{name}_cnt", f"({c} * {j}) % {3 + j}"))
    for j in (1, 2):
        cols.append((f"op{j}_cnt", f"({c} * {j + 4}) % {11 * j}"))
    for j in (1, 2):
        cols.append((f"login_cnt_period{j}", f"({c} * {j + 2}) % {13 * j}"))
    cols += [
        ("login_days_cnt", f"{c} % 31"),
        ("login_cnt_avg", f"CAST({c} % 17 AS DOUBLE) / 2"),
        ("ip_cnt", f"{c} % 12"),
        ("acc_count", f"{c} % 6"),
    ]
    for j in (1, 2):
        cols.append((f"service{j}_cnt", f"({c} * {j + 1}) % {7 + j}"))
    cols += [
        ("service1_amt", f"CAST(({c} * 3) % 500 AS DOUBLE)"),
        ("agreement_total", f"{c} % 8"),
    ]
    return cols


BASE_COLUMNS = _base_columns()


def _select_list(columns: list[tuple[str, str]], quote: str) -> str:
    return ",\n    ".join(f"{expr} AS {quote}{name}{quote}" for name, expr in columns)


def fixture_cte_sql() -> str:
    """``WITH`` clause defining ``op``, ``trans`` and ``base`` for DuckDB oracles."""
    ev = f"SELECT *, {K} AS k, {DAYS} AS days FROM events"
    return (
        "WITH ev AS (" + ev + "),\n"
        "op AS (SELECT\n    " + _select_list(OP_COLUMNS, '"') + "\nFROM ev),\n"
        "trans AS (SELECT\n    " + _select_list(TRANS_COLUMNS, '"') + f"\nFROM ev WHERE {TRANS_FILTER}),\n"
        "base AS (SELECT\n    " + _select_list(BASE_COLUMNS, '"') + "\nFROM customer)\n"
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (read_table(spark, sf_dir, "events")
            .selectExpr("*", f"{K} AS k", f"{DAYS} AS days"))


def _project(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS `{name}`" for name, expr in columns])


def op_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operation log: user, row_id, tm_diff, op_type, op_mode, op_device, ip, ip_3, net_type, channel."""
    return _project(_events(spark, sf_dir), OP_COLUMNS)


def trans_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction log: user, row_id, tm_diff, amount, platform, tunnel_out, type1, type2, ip."""
    return _project(_events(spark, sf_dir).where(TRANS_FILTER), TRANS_COLUMNS)


def base_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user with the profile columns and ``label`` (null = scoring row)."""
    return _project(read_table(spark, sf_dir, "customer"), BASE_COLUMNS)


def label_and_bases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three inputs of the reference layout: label table, train base, test base."""
    base = base_table(spark, sf_dir)
    label = base.where("label IS NOT NULL").select("user", "label")
    train = base.where("label IS NOT NULL").drop("label")
    test = base.where("label IS NULL").drop("label")
    return label, train, test
