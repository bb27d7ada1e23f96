"""Spelling variants by reduced-alphabet generation.

Words are made from the runs of letters of whole texts and kept from ``MIN_LENGTH`` code points and ``MIN_COUNT``
occurrences on. Their letters are hashed to ``SYMBOLS`` symbols; of each distinct reduced word the full one-edit
neighbourhood is generated over those few symbols and joined with the reduced vocabulary; the words behind each
joined pair are then verified on their original strings: near is exactly one inserted, deleted or replaced code
point. Two words one edit apart have reduced words at most one edit apart, so no pair is missed. A pair is found from
the smaller reduced word alone.

All of it is DataFrame functions. Nothing is collected: every step is a join or an aggregation on a word or reduced
word, split by Spark where it is skewed.

Defined cases: null and empty texts have no runs; a null doc_id counts as empty text before the colon; rows equal in
all columns are counted each; very long texts are cut to runs like others; ties for the form go to the smaller word
in code-point order; without words the result is empty; other columns are ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.llm.common import save

RUN = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT = 6, 5
SYMBOLS = 6
#: A word's form is written so many times as often, at least.
FACTOR = 5
UPPER = "".join(map(chr, range(65, 91)))
LETTERS = UPPER.lower() + "".join(map(chr, range(0xC0, 0x100)))


def lowered(word: Column) -> Column:
    """A-Z to a-z, nothing else. ``lower`` does the same for words of ASCII letters, and faster."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, UPPER, UPPER.lower()))


def occurrences(docs: DataFrame, every: int = 199) -> DataFrame:
    """word of each run: lower-cased; one code point is deleted where ``every`` divides the crc32 of ``<doc_id>:<run>``."""
    runs = (docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                        F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
            .select("id", lowered(F.col("run")).alias("run"))
            # shorter runs give no word either way
            .where(F.length("run") >= MIN_LENGTH)
            .select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h")))
    at = F.pmod("h", F.length("run").cast("long")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n."""
    return (occurrences(docs).where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def reduced(word: Column, symbols: int = SYMBOLS) -> Column:
    """The word over the reduced alphabet: the digits 0 .. symbols - 1, by a hash of the letter."""
    return F.translate(word, LETTERS, "".join(str(zlib.crc32(c.encode()) % symbols) for c in LETTERS))


def neighbourhood(word: str, symbols: int = SYMBOLS) -> Column:
    """The word, and all strings one inserted, deleted or replaced symbol away, that are not smaller than the word."""
    one = f"sequence(0, {symbols - 1})"
    head, tail = f"substring({word}, 1, i - 1)", f"substring({word}, i + 1)"
    return F.expr(f"""array_distinct(filter(concat(array({word}),
        transform(sequence(1, length({word})), i -> concat({head}, {tail})),
        flatten(transform(sequence(1, length({word})), i -> transform({one}, s -> concat({head}, s, {tail})))),
        flatten(transform(sequence(1, length({word}) + 1), i -> transform({one}, s -> concat({head}, s, substring({word}, i)))))
        ), x -> x >= {word}))""")


def links(spark: SparkSession, vocab: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """word, near, near_n: both directions of each pair of words exactly one edit apart."""
    own = save(spark, vocab.withColumn("r", reduced(F.col("word"), symbols)), "reduced-words")
    around = own.select("r").distinct().select("r", F.explode(neighbourhood("r", symbols)).alias("r2"))
    met = around.join(own.select(F.col("r").alias("r2")).distinct(), "r2")
    a = own.select("r", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = own.select(F.col("r").alias("r2"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    pairs = save(spark, met.join(a, "r").join(b, "r2")
                 .where(((F.col("r") != F.col("r2")) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
                 .select("a", "a_n", "b", "b_n"), "near-words")
    return (pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
            .unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))))


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """word, root of (word, form): forms followed to the last, twice as far with each join.

    A form occurs more often than its word, so there is no cycle, and a chain's length grows with the logarithm of n.
    """
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if at.join(on, "root", "left_semi").isEmpty():
            return at
        at = save(spark, at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")


def variants(spark: SparkSession, docs: DataFrame, symbols: int = SYMBOLS, factor: int = FACTOR) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word."""
    vocab = save(spark, vocabulary(docs), "words")
    best = links(spark, vocab, symbols).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    enough = -F.col("best.n") >= factor * F.col("n")
    known = save(spark, vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.n")).alias("form_n")), "variants")
    ends = roots(spark, known.where("form is not null"))
    return known.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n",
                                                   F.coalesce("root", "word").alias("root"))
