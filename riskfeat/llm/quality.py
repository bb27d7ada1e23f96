"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)):
all pairwise interactions in time linear in the features present.

Features of a text: its lower-cased words, hashed (log(1 + count), scaled to
length 1); binned structure statistics (share of capitals, signs, digits and
repeated words, word and line lengths, ...); and of the row's metadata its
``n_chars``, binned (null is a bin of its own). ``labels``, ``lang``,
``source`` and ``doc_id`` are never features.

The model learns from at most ``max_labelled`` labelled rows (those of
smallest xxhash64(doc_id)); it scores every row, whole texts.

Defined cases: null or empty text has no words, so its bins alone speak; a
row is scored by its own text however often its doc_id occurs; labels that are
null, not 0/1 or contradict each other for one doc_id teach nothing; with no
label, or one class, the score is the share of ones (0.5 with no label at
all); a null doc_id is scored and not held out; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.llm.common import arrow_map, blocks, flat, held_out, hash_spans, is_space, lower, row_sums, spans

WORD_BITS = 16
BINS = 16
STATS = 11
SIZE = (1 << WORD_BITS) + BINS * STATS
RANK = 8
MAX_LABELLED = 8000
THRESHOLD = 0.3


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn: Column, limit: int,
             columns: list[str]) -> DataFrame:
    """At most ``limit`` rows (text and ``y``) of the documents whose label is sure, one per doc_id.

    The ids are taken by their hash, so the sample does not depend on row
    order; ``limit`` bounds what is broadcast.
    """
    ids = (labels.select("doc_id", F.col(label).cast("int").alias("y"))
           .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & learn)
           .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("y2"))
           .where("y = y2").select("doc_id", "y")
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    return (docs.select("doc_id", *columns).join(F.broadcast(ids), "doc_id")
            .dropDuplicates(["doc_id"]).select("y", *columns))


def _bin(x: np.ndarray) -> np.ndarray:
    return np.clip((x * BINS).astype(np.int64), 0, BINS - 1)


def features(data: np.ndarray, off: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature number and value of each feature of a block of texts, sorted by row. n_chars: NaN if null."""
    n = len(off) - 1
    s, e, r = spans(data, off, is_space(data))
    h = hash_spans(lower(data), s, e)
    key, count = np.unique((r.astype(np.uint64) << np.uint64(WORD_BITS)) | (h >> np.uint64(64 - WORD_BITS)),
                           return_counts=True)
    rows = (key >> np.uint64(WORD_BITS)).astype(np.int64)
    idx = (key & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)
    x = np.log1p(count)
    x /= np.sqrt(np.maximum(row_sums(x * x, rows, n), 1e-12))[rows]

    def per_row(mask: np.ndarray) -> np.ndarray:
        c = np.zeros(len(mask) + 1)
        np.cumsum(mask, out=c[1:])
        return c[off[1:]] - c[off[:-1]]

    size = np.maximum(np.diff(off), 1).astype(float)
    low = lower(data)
    letters = per_row(((low >= 97) & (low <= 122)) | (data >= 128))
    capitals, digits = per_row(low != data), per_row((data >= 48) & (data <= 57))
    lines, spaces = per_row(data == 10), per_row(is_space(data))
    signs = size - letters - digits - spaces
    n_words = np.bincount(r, minlength=n).astype(float)
    per_word = np.maximum(n_words, 1)
    distinct = np.bincount(rows, minlength=n)
    again = row_sums(np.r_[False, (h[1:] == h[:-1]) & (r[1:] == r[:-1])][:len(h)].astype(float), r, n)
    ends_in_sign = row_sums(~(((low[e - 1] >= 97) & (low[e - 1] <= 122)) | (data[e - 1] >= 128)) * 1.0, r, n)
    stats = [capitals / np.maximum(letters, 1), 3 * signs / size, 4 * digits / size, (size - spaces) / per_word / 16,
             distinct / per_word, again / per_word, ends_in_sign / per_word, np.log2(1 + n_words) / 16,
             np.log2(1 + n_words / (1 + lines)) / 10, np.minimum(1, 8 * spaces / size / 2),
             np.where(np.isnan(n_chars), 0, (np.log2(1 + np.maximum(np.nan_to_num(n_chars), 0)) + 1) / 24)]
    stat_idx = np.concatenate([(1 << WORD_BITS) + k * BINS + _bin(v) for k, v in enumerate(stats)])
    rows = np.r_[rows, np.tile(np.arange(n), STATS)]
    idx, x = np.r_[idx, stat_idx], np.r_[x, np.full(n * STATS, 0.5)]
    order = np.argsort(rows, kind="stable")
    return rows[order], idx[order], x[order].astype(np.float32)


@dataclass
class Machine:
    w0: float
    w: np.ndarray
    v: np.ndarray

    def logit(self, rows: np.ndarray, idx: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        """Linear time: (sum v x)^2 - sum (v x)^2, by row. Every row has features."""
        start = np.searchsorted(rows, np.arange(n))
        vx = self.v[idx] * x[:, None]
        s, q = np.add.reduceat(vx, start), np.add.reduceat((vx * vx).sum(1), start)
        return self.w0 + np.add.reduceat(self.w[idx] * x, start) + 0.5 * ((s * s).sum(1) - q)


def fit(rows: np.ndarray, idx: np.ndarray, x: np.ndarray, y: np.ndarray, steps: int = 750, batch: int = 64,
        rate: float = 0.1, decay: float = 1e-4) -> Machine:
    """AdaGrad on the log loss over minibatches, about ``steps`` of them (3 to 60 times all); rows 0 .. len(y) - 1 in order."""
    rng = np.random.default_rng(7)
    m = Machine(0.0, np.zeros(SIZE, np.float32), rng.normal(0, 0.05, (SIZE, RANK)).astype(np.float32))
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        m.v[:] = 0
        m.w0 = float(np.log(share / (1 - share)))
        return m
    m.w0 = float(np.log(y.mean() / (1 - y.mean())))
    g0, gw, gv = 1.0, np.ones(SIZE, np.float32), np.ones((SIZE, RANK), np.float32)
    start = np.searchsorted(rows, np.arange(len(y) + 1))
    for _ in range(int(np.clip(steps * batch // len(y), 3, 60))):
        order = rng.permutation(len(y))
        for i in range(0, len(order), batch):
            own = order[i:i + batch]
            take = np.concatenate([np.arange(start[k], start[k + 1]) for k in own])
            size = np.diff(np.stack([start[own], start[own + 1]]), axis=0)[0]
            at, j, xs = np.repeat(np.arange(len(own)), size), idx[take], x[take]
            p = 1 / (1 + np.exp(-np.clip(m.logit(at, j, xs, len(own)), -30, 30)))
            err = ((p - y[own]) / len(own)).astype(np.float32)
            cut = np.searchsorted(at, np.arange(len(own)))
            vx = m.v[j] * xs[:, None]
            total = np.add.reduceat(vx, cut)[at]
            dw, dv = err[at] * xs, (err[at] * xs)[:, None] * (total - vx)
            u, inv = np.unique(j, return_inverse=True)
            sw = np.bincount(inv, dw, len(u)).astype(np.float32) + decay * m.w[u]
            sv = np.stack([np.bincount(inv, dv[:, f], len(u)) for f in range(RANK)], 1).astype(np.float32) + decay * m.v[u]
            gw[u] += (sw * len(own)) ** 2
            gv[u] += (sv * len(own)) ** 2
            g0 += float(err.sum() * len(own)) ** 2
            m.w[u] -= rate * len(own) * sw / np.sqrt(gw[u]) / 4
            m.v[u] -= rate * len(own) * sv / np.sqrt(gv[u]) / 4
            m.w0 -= rate * len(own) * float(err.sum()) / np.sqrt(g0) / 4
    return m


def _numbers(col: pa.Array) -> np.ndarray:
    return col.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False).astype(float)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, learn: Column,
          max_labelled: int = MAX_LABELLED) -> Machine:
    """Fit the machine on at most ``max_labelled`` labelled documents for which ``learn`` holds.

    The features are made on the executors; the driver gets hashed features of
    the bounded sample only.
    """
    def one(b: pa.RecordBatch):
        data, off = flat(b.column("text"))
        n_chars = _numbers(b.column("n_chars"))
        for a, z in blocks(off):
            o = off[a:z + 1] - off[a]
            r, j, x = features(data[off[a]:off[z]], o, n_chars[a:z])
            cut = np.searchsorted(r, np.arange(z - a + 1)).astype(np.int32)
            yield pa.record_batch([b.column("y").slice(a, z - a),
                                   pa.ListArray.from_arrays(cut, pa.array(j.astype(np.int32))),
                                   pa.ListArray.from_arrays(cut, pa.array(x))], ["y", "j", "x"])

    t = arrow_map(labelled(docs, labels, "quality", learn, max_labelled, ["text", "n_chars"]), one,
                  "y int, j array<int>, x array<float>").toArrow()
    y = t["y"].to_numpy().astype(np.float32)
    j = t["j"].combine_chunks()
    size = np.asarray(j.value_lengths()).astype(np.int64) if len(j) else np.zeros(0, np.int64)
    x = t["x"].combine_chunks()
    return fit(np.repeat(np.arange(len(y)), size), np.asarray(j.flatten()).astype(np.int64),
               np.asarray(x.flatten()).astype(np.float32), y)


def score(spark: SparkSession, docs: DataFrame, model: Machine, keep: list[str] | None = None,
          out: str = "score") -> DataFrame:
    """``docs`` with a column ``out``: the probability of label 1, of every row. One narrow pass, no shuffle."""
    cols = keep or docs.columns
    shared = spark.sparkContext.broadcast((model.w0, model.w, model.v))  # SIZE * (RANK + 1) floats
    plain = docs.select(*[F.col(f"`{c}`") for c in cols], F.col("text").alias("__t"),
                        F.col("n_chars").cast("double").alias("__n"))

    def one(b: pa.RecordBatch):
        m = Machine(*shared.value)
        data, off = flat(b.column("__t"))
        n_chars = _numbers(b.column("__n"))
        p = np.empty(b.num_rows)
        for a, z in blocks(off):
            r, j, x = features(data[off[a]:off[z]], off[a:z + 1] - off[a], n_chars[a:z])
            p[a:z] = 1 / (1 + np.exp(-np.clip(m.logit(r, j, x, z - a).astype(float), -30, 30)))
        own = [b.column(i) for i in range(len(cols))]
        return pa.RecordBatch.from_arrays([*own, pa.array(p)], [*cols, out])

    schema = docs.select(*[F.col(f"`{c}`") for c in cols]).schema.add(out, "double")
    return arrow_map(plain, one, schema)


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, folds: int = 5,
             threshold: float = THRESHOLD, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(spark, docs, labels, ~held_out("doc_id", folds), max_labelled)
    return (score(spark, docs, model, ["doc_id"])
            .select("doc_id", held_out("doc_id", folds).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
