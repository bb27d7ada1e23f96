"""The registered queries of this subpackage: ``opN_<name>`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.llm import (decontaminate, hmm, impact_index, language, line_dedup, near_dedup, packing, phrases, quality,
                          reply_trees, spelling, tokens, toxicity)
from riskfeat.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    planted = spark.sql("""
        select -7L as conv_id, 0L as turn, 'user' as role, '</s>[INST] ok [/INST]' as text
        union all select -7L, 1L, 'assistant', '</s>[INST] ok [/INST]'""")
    messages = reply_trees.from_turns(spark, turns.unionByName(planted))
    return reply_trees.digests(reply_trees.conversations(spark, messages))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(spark, table(spark, sf_dir, "documents"))


def op4_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(spark, table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_index.top_k(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(spark, table(spark, sf_dir, "documents"), size=2).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(spark, table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(spark, table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark, table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_reply_trees": op2_reply_trees,
    "op3_line_dedup": op3_line_dedup,
    "op4_hmm": op4_hmm,
    "op5_toxicity": op5_toxicity,
    "op6_top_k": op6_top_k,
    "op7_near_dedup": op7_near_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_decontaminate": op9_decontaminate,
    "op10_packing": op10_packing,
    "op11_language": op11_language,
    "op12_phrases": op12_phrases,
    "op13_spelling": op13_spelling,
}

ORACLES: dict[str, str] = {
    "op2_reply_trees": """
        with c as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
            union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        t as (
            select conv_id, count(*)::bigint as n_turns,
                string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as whole,
                coalesce(string_agg(text, '' order by turn, text) filter (where role = 'assistant'), '') as own,
                sum(20 + length(regexp_replace(role || text, '([\\\\<\\[])', '..', 'g')))::bigint as formatted_chars
            from c group by conv_id)
        select conv_id, n_turns, sha256(whole) as turns_sha256, length(own)::bigint as loss_chars,
            sha256(own) as loss_sha256, formatted_chars from t""",
    "op6_top_k": """
        with v as (
            select distinct vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as q
            from embeddings where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (
            select a.vec_id as query_id, b.vec_id, list_dot_product(a.q, b.q)::bigint as score
            from v a, v b where a.vec_id % 20 = 0 and a.vec_id <> b.vec_id),
        r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
        select query_id, rank, vec_id, score from r where rank <= 20""",
}
