"""The corpus pipeline: quality, line dedup, near-dedup, decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns what it keeps of ``docs``, with the columns of ``documents``; the
last returns the packed pieces. ``run`` writes each stage's rows as Parquet
under the shared checkpoint folder and reads them back as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.llm import decontaminate, line_dedup, near_dedup, packing, quality
from riskfeat.llm.common import held_out, save, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    model = quality.train(spark, docs, table(spark, sf_dir, "labels"), ~held_out("doc_id", 5))
    return quality.score(spark, docs, model, COLUMNS, "__score").where(
        F.col("__score") >= quality.THRESHOLD).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that repeat an earlier one, exactly or nearly; every document stays, if only its empty text."""
    return line_dedup.clean(spark, docs.select(*COLUMNS))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five words, similarity 0.8)."""
    return near_dedup.clean(spark, docs.select(*COLUMNS), size=5, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a copy of a benchmark item."""
    return decontaminate.clean(spark, docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 4096 tokens: a row for each piece."""
    return packing.pack(spark, docs)


STAGES = [("quality", quality_stage), ("line_dedup", line_stage), ("near_dedup", near_stage),
          ("decontaminate", benchmark_stage), ("packing", packing_stage)]

#: The stages train, hash and pack; SQL does not express them. tests/llm checks them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
