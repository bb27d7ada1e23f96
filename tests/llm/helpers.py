"""Fixtures by hand: awkward rows, clashing extra columns, empty tables."""

import pyspark.sql.functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("score", "rid", "n", "key", "node", "component", "h", "pos", "held_out", "length", "rank", "y", "word")


def documents(spark, rows, clash=True):
    """(doc_id, text) rows as documents, with extra columns whose names the operators use inside."""
    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA)
    for c in CLASH if clash else ():
        df = df.withColumn(c, F.lit("x"))
    return df


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def awkward():
    """Null and empty texts, a null id, repeated rows, a very long text."""
    return [(1, "one two three four five six seven eight nine ten"), (1, "one two three four five six seven eight nine ten"),
            (2, None), (3, ""), (4, "  \n\t "), (None, "alpha beta gamma delta epsilon zeta eta theta"),
            (5, "word " * 60_000), (6, "x"), (7, "été 中文 \U0001f600")]


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")
