"""Hidden Markov language model with exact word counts.

Tokens are lower-cased words and one end for each text. The model is a hidden
Markov chain over word classes: every frequent word (count >= N / HEAVY, so at
most HEAVY words) and the end are classes of their own, the others fall into
LIGHT classes by their first and last bytes. Within a class a word has the
smoothed share (c + 0.1) / (N_class + 0.1 (V_class + 1)) of its exact training
count c, so the model is a distribution over texts and any word, known or
not, has a probability.

Counts of all training words are summed in Spark. Baum-Welch runs over all
training texts: each partition sums its expected transitions and emissions by
scaled forward-backward recursions, Spark adds them up, and the driver holds
only the STATES x classes table. A text's score is its exact likelihood by the
scaled forward recursion over all its tokens, plus the words' shares; the
counts of rare words come by a join (one row for each text and distinct word).

Defined cases: null text is empty (one token, the end); with no training text
every count is 0 and the model is uniform; repeated rows are rows of their own,
learnt from and scored; a null doc_id is not held out; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.llm.common import blocks, flat, held_out, save

STATES = 8
HEAVY = 8192
LIGHT = 1024
ITERATIONS = 5
#: Baum-Welch takes longer texts in parts of so many tokens (scores never do).
PART = 32_768
#: Texts and tokens that a task recurs over side by side, at most.
SIDE_BY_SIDE, TOKENS = 512, 400_000
#: Steps from one scaling to the next. A step takes a factor of 1e-30 at least (PRIOR, unigram), doubles reach 1e-308.
SCALED = 8
PRIOR = 100.0


def split(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z in lower case."""
    return text.encode().lower().split() if text else []


def light_class(word: bytes) -> int:
    return zlib.crc32(word[:2] + word[-2:]) % LIGHT


def parts(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``size`` bytes of text: what a task holds as Python objects at a time."""
    for a, z in blocks(flat(batch.column("text"))[1], size):
        yield batch.slice(a, z - a)


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c over all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in parts(whole, 8_000_000)):
            own: Counter = Counter()
            for x in b.column("text").to_pylist():
                own.update(split(x))
            words = [w.decode() for w in own]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(own.values()), pa.int64())],
                                             ["word", "n"])
    return (docs.select("text").mapInArrow(count, "word string, n long").groupBy("word")
            .agg(F.sum("n").alias("c")))


def time_major(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sequences of falling length: how many are active at each step, and where each step begins."""
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right") if len(lengths) else np.zeros(0, np.int64)
    return active, np.r_[0, np.cumsum(active)]


def side_by_side(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Sequence numbers in groups of similar length, longest first."""
    order = np.argsort(-lengths, kind="stable")
    a = 0
    while a < len(order):
        b = min(len(order), a + max(1, min(SIDE_BY_SIDE, TOKENS // max(1, int(lengths[order[a]])))))
        yield order[a:b]
        a = b


def gather(seqs: list[np.ndarray], own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes of the sequences step by step, with lengths, active counts and step starts."""
    lengths = np.array([len(seqs[k]) for k in own])
    active, at = time_major(lengths)
    obs = np.empty(at[-1], np.int64)
    for row, k in enumerate(own):
        obs[at[:lengths[row]] + row] = seqs[k]
    return obs, lengths, active, at


def log10_likelihood(seqs: list[np.ndarray], start: np.ndarray, trans: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """Exact log10 likelihood of each class sequence by the scaled forward recursion. emit: (classes, states)."""
    out = np.zeros(len(seqs))
    sizes = np.array([len(s) for s in seqs], np.int64)
    for own in side_by_side(sizes):
        obs, _, active, at = gather(seqs, own)
        total, ones = np.zeros(len(own)), np.ones(len(start))
        alpha = np.broadcast_to(start, (len(own), len(start)))
        for t, n in enumerate(active):
            # texts that ended at the step before are whole
            if t and n < len(alpha):
                total[n:len(alpha)] += np.log10(alpha[n:] @ ones)
            alpha = (alpha[:n] @ trans if t else alpha) * np.take(emit, obs[at[t]:at[t + 1]], axis=0)
            if t % SCALED == SCALED - 1:
                s = alpha @ ones
                total[:n] += np.log10(s)
                alpha /= s[:, None]
        out[own] = total
        out[own[:len(alpha)]] += np.log10(alpha @ ones)
    return out


def expected(seqs: list[np.ndarray], start: np.ndarray, trans: np.ndarray, emit: np.ndarray) -> tuple[np.ndarray, ...]:
    """Expected starts, transitions and emissions (classes, states) of class sequences, none of them empty.

    Both recursions are divided by the same sums at every ``SCALED``-th step; at its end a text's backward values are
    one over its last forward sum, so that forward times backward adds up to 1 at every token.
    """
    k = len(start)
    ones, back = np.ones(k), trans.T.copy()
    e_start, e_trans, e_emit = np.zeros(k), np.zeros((k, k)), np.zeros_like(emit)
    for own in side_by_side(np.array([len(s) for s in seqs], np.int64)):
        obs, lengths, active, at = gather(seqs, own)
        b = np.take(emit, obs, axis=0)
        alpha = np.empty_like(b)
        begin = at.tolist()
        np.multiply(start, b[:begin[1]], out=alpha[:begin[1]])
        for t in range(len(active)):
            here = alpha[begin[t]:begin[t + 1]]
            if t:
                np.matmul(alpha[begin[t - 1]:begin[t - 1] + len(here)], trans, out=here)
                here *= b[begin[t]:begin[t + 1]]
            if t % SCALED == SCALED - 1:
                s = (here @ ones)[:, None]
                here /= s
                b[begin[t]:begin[t + 1]] /= s
        later = np.empty_like(b)
        last = at[lengths - 1] + np.arange(len(own))
        later[last] = 1 / (alpha[last] @ ones)[:, None]
        for t in range(len(active) - 2, -1, -1):
            a, z = begin[t + 1], begin[t + 2]
            w = b[a:z]
            w *= later[a:z]
            np.matmul(w, back, out=later[begin[t]:begin[t] + z - a])
            e_trans += alpha[begin[t]:begin[t] + z - a].T @ w
        alpha *= later
        e_start += alpha[:active[0]].sum(0)
        for s, gamma in enumerate(np.ascontiguousarray(alpha.T)):
            e_emit[:, s] += np.bincount(obs, gamma, len(emit))
    return e_start, e_trans * trans, e_emit


class Classes(dict):
    """Class number of each word: the frequent ones given, the others by their bytes, a bounded number remembered."""

    def __init__(self, heavy: dict[bytes, int], end: int):
        super().__init__(heavy)
        self.heavy, self.end = heavy, end

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
            self.update(self.heavy)
        k = self.end + 1 + light_class(word)
        if len(word) <= 64:
            self[word] = k
        return k


class Vocabulary:
    """What the driver knows of the words: the heavy ones, and sums for each class."""

    def __init__(self, counts: DataFrame, n_texts: int):
        total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
        self.n = (total["n"] or 0) + n_texts
        self.v = total["v"] + (1 if n_texts else 0)
        self.ends = n_texts
        # at most HEAVY rows: their counts sum to n at most
        heavy = counts.where((F.col("c") * HEAVY >= F.lit(max(self.n, 1))) & (F.octet_length("word") <= 64))
        self.heavy = {r["word"].encode(): (i, r["c"]) for i, r in enumerate(heavy.orderBy(F.desc("c"), "word").collect())}
        word = F.col("word").cast("binary")
        ends = F.concat(F.substring(word, 1, 2), F.substring(word, -2, 2))
        light = counts.join(F.broadcast(heavy.select("word")), "word", "left_anti").groupBy(
            F.pmod(F.crc32(ends), F.lit(LIGHT)).alias("k")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"))
        h = len(self.heavy)
        self.end = h
        self.classes = h + 1 + LIGHT
        self.class_n = np.zeros(self.classes)
        light_v = np.zeros(LIGHT)
        for r in light.collect():
            self.class_n[h + 1 + r["k"]], light_v[r["k"]] = r["n"], r["v"]
        for i, c in self.heavy.values():
            self.class_n[i] = c
        self.class_n[h] = n_texts
        #: log10 of the share's denominator: 0 for classes of one word
        self.below = np.zeros(self.classes)
        self.below[h + 1:] = np.log10(self.class_n[h + 1:] + 0.1 * (light_v + 1))

    def unigram(self) -> np.ndarray:
        return (self.class_n + 0.1) / (self.class_n.sum() + 0.1 * self.classes)


def encode(docs: DataFrame, words: Vocabulary, train: str) -> DataFrame:
    """A row for each text: its class sequence, the rare words with their numbers, and sums over the frequent ones."""
    shared = docs.sparkSession.sparkContext.broadcast((words.heavy, words.end, words.below, words.ends))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, end, below, ends = shared.value
        number = Classes({w: i for w, (i, _) in heavy.items()}, end)
        log_c = np.zeros(len(below))
        log_c[:end] = np.log10([c + 0.1 for _, c in heavy.values()])
        log_c[end] = np.log10(ends + 0.1)
        for b in (part for whole in batches for part in parts(whole, 2_000_000)):
            seq, light, counts, n, known, own, share = [], [], [], [], [], [], []
            for x in b.column("text").to_pylist():
                ws = split(x)
                ids = np.fromiter(chain(map(number.__getitem__, ws), (end,)), np.int32, len(ws) + 1)
                rare = Counter(compress(ws, (ids > end).tolist()))
                seq.append(ids.astype("<u2").tobytes())
                light.append([w.decode() for w in rare])
                counts.append(list(rare.values()))
                n.append(len(ids))
                known.append(len(ids) - sum(rare.values()) - (0 if ends else 1))
                own.append(float(log_c[ids].sum()))
                share.append(float(-below[ids].sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), b.column("train"), pa.array(seq, pa.binary()),
                 pa.array(light, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64())), pa.array(n, pa.int64()),
                 pa.array(known, pa.int64()), pa.array(own, pa.float64()), pa.array(share, pa.float64())],
                ["doc_id", "held_out", "train", "seq", "words", "counts", "n", "known", "own", "share"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", F.col(train).alias("train"), "text").mapInArrow(
        run, f"doc_id {id_type}, held_out boolean, train boolean, seq binary, words array<string>, counts array<long>, "
             "n long, known long, own double, share double").withColumn("rid", F.monotonically_increasing_id())


def _sequences(col: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2") for x in col.to_pylist()]


def baum_welch(coded: DataFrame, words: Vocabulary, states: int = STATES,
               iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, trans, emit (classes, states) after some iterations over every training text."""
    spark = coded.sparkSession
    rng = np.random.default_rng(5)
    base = words.unigram()
    emit = base[:, None] * np.exp(rng.normal(0, 1.0, (words.classes, states)))
    emit /= emit.sum(0)
    start = np.full(states, 1 / states)
    trans = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(trans, 0.95 if states > 1 else 1.0)
    classes = words.classes
    for _ in range(iterations):
        shared = spark.sparkContext.broadcast((start, trans, emit))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            model = shared.value
            total = None
            for b in batches:
                seqs = [s[a:a + PART] for s in _sequences(b.column("seq")) for a in range(0, len(s), PART)]
                if seqs:
                    own = expected(seqs, *model)
                    total = own if total is None else tuple(x + y for x, y in zip(total, own, strict=True))
            if total is not None:
                flat = np.concatenate([x.ravel() for x in total])
                slot = np.flatnonzero(flat > 1e-9)
                yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(flat[slot])], ["slot", "x"])

        sums = (coded.where("train").select("seq").mapInArrow(run, "slot int, x double")
                .groupBy("slot").agg(F.sum("x").alias("x")).toArrow())  # STATES x classes numbers at most
        flat = np.zeros(states + states * states + classes * states)
        flat[sums["slot"].to_numpy()] = sums["x"].to_numpy()
        shared.destroy()
        e_start, e_trans = flat[:states], flat[states:states + states * states].reshape(states, states)
        e_emit = flat[states + states * states:].reshape(classes, states)
        start = (e_start + 0.1) / (e_start.sum() + 0.1 * states)
        trans = (e_trans + 0.1) / (e_trans.sum(1, keepdims=True) + 0.1 * states)
        emit = (e_emit + PRIOR * base[:, None]) / (e_emit.sum(0) + PRIOR)
    return start, trans, emit


def score(spark: SparkSession, docs: DataFrame, folds: int = 10, states: int = STATES,
          iterations: int = ITERATIONS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    docs = docs.select("doc_id", "text", held_out("doc_id", folds).alias("held_out"))
    counts = save(spark, word_counts(docs.where("not held_out")), "counts")
    words = Vocabulary(counts, docs.where("not held_out").count())
    coded = save(spark, encode(docs.withColumn("train", ~F.col("held_out")), words, "train"), "coded")
    model = baum_welch(coded, words, states, iterations)

    # the rare words' counts, summed for each text
    pairs = coded.select("rid", F.explode(F.arrays_zip("words", "counts")).alias("w")).select(
        "rid", F.col("w.words").alias("word"), F.col("w.counts").alias("k"))
    rare = (pairs.join(counts, "word", "left").groupBy("rid").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))).alias("log_c"),
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("rare_known")))

    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ll = log10_likelihood(_sequences(b.column("seq")), *shared.value)
            keep = [i for i, name in enumerate(b.schema.names) if name != "seq"]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(ll)],
                                             [*(b.schema.names[i] for i in keep), "chain"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    chain = coded.select("rid", "doc_id", "held_out", "n", "known", "own", "share", "seq").mapInArrow(
        run, f"rid long, doc_id {id_type}, held_out boolean, n long, known long, own double, share double, chain double")
    # own covers the words that are classes; a class of one word has probability 1 within its class
    log_c = F.coalesce("log_c", F.lit(0.0))
    denominator = float(np.log10(words.n + 0.1 * (words.v + 1)))
    return chain.join(rare, "rid", "left").select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(words.n).cast("long").alias("train_tokens"),
        (F.col("own") + log_c - F.col("n") * F.lit(denominator)).alias("base_score"),
        (F.col("chain") + F.col("share") + log_c).alias("score"))
