"""Toxicity: subword-bag embeddings averaged into a linear softmax.

Every word (run of letters and digits, lower-cased) gives the hashed byte
n-grams of 3 to 5 bytes of " word " and itself as a whole; a text is the mean
of their embeddings, and a linear softmax over that mean gives the two
classes. Embeddings and softmax are trained jointly (numpy, AdaGrad) on a
bounded sample of each class, and the intercept is set back to the true class
shares. A misspelt or compounded word shares most of its n-grams with the word
it comes from.

When scoring, the softmax of a mean is a mean of one number per n-gram bucket,
so the whole text costs one table lookup per n-gram.

Defined cases: null, empty or letterless texts have no n-gram and get the
prior; labels that are null, not 0/1 or contradict each other for one doc_id
teach nothing; with no label, or one class, the score is the share of ones
(0.5 with no label at all); a row is scored by its own text however often its
doc_id occurs; a null doc_id is not held out; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.llm.common import arrow_map, blocks, flat, hash_spans, held_out, lower, spans
from riskfeat.llm.quality import labelled

BUCKET_BITS = 17
SIZE = 1 << BUCKET_BITS
DIM = 8
SIZES = (3, 4, 5)
#: Labelled documents learnt from, at most, of class 0 and of class 1.
MAX_LABELLED = (4500, 1500)
THRESHOLD = 0.5


def buckets(data: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, buckets) of the n-grams of a block of texts: one pair for each n-gram size, one for whole words."""
    low = lower(data)
    solid = ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57)) | (low >= 128)
    # a gap before, between and after the rows: no n-gram crosses a row
    n, rows = len(data), len(off) - 1
    at = np.arange(n) + np.repeat(np.arange(rows), np.diff(off)) + 1
    text = np.zeros(n + rows + 1, np.uint32)
    text[at] = np.where(solid, low, 0)
    full = text > 0
    out = []
    for size in SIZES:
        m = len(text) - size + 1
        if m <= 0:
            continue
        ok = full[1:m + 1].copy()  # the bytes between the first and the last are of one word
        for k in range(2, size - 1):
            ok &= full[k:m + k]
        pos = np.flatnonzero(ok)
        h = np.full(len(pos), size * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for k in range(size):
            h = (h ^ text[pos + k]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        out.append((pos, (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BUCKET_BITS)))
    s, e, _ = spans(low, off, ~solid)
    out.append((at[s] if len(s) else s, (hash_spans(low, s, e) >> np.uint64(64 - BUCKET_BITS)).astype(np.uint32)))
    return out


def _bounds(off: np.ndarray) -> np.ndarray:
    """Where the rows begin in the text with gaps."""
    return off + np.arange(len(off))


def bag(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and share of each distinct n-gram bucket of each row."""
    begin, keys = _bounds(off), []
    for pos, b in buckets(data, off):
        row = np.searchsorted(begin, pos, side="right") - 1
        keys.append((np.minimum(row, len(off) - 2).astype(np.uint64) << np.uint64(BUCKET_BITS)) | b.astype(np.uint64))
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    row = (key >> np.uint64(BUCKET_BITS)).astype(np.int64)
    total = np.bincount(row, count, len(off) - 1)
    return row, (key & np.uint64(SIZE - 1)).astype(np.int64), (count / total[row]).astype(np.float32)


@dataclass
class SubwordSoftmax:
    table: np.ndarray   # per bucket: embedding times (weights of class 1 - of class 0)
    bias: float

    def logit(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        begin = _bounds(off)
        total, count = np.zeros(len(off) - 1), np.zeros(len(off) - 1)
        for pos, b in buckets(data, off):
            cut = np.searchsorted(pos, begin)
            c = np.zeros(len(pos) + 1)
            np.cumsum(self.table[b], out=c[1:], dtype=np.float64)
            total += c[cut[1:]] - c[cut[:-1]]
            count += np.diff(cut)
        return self.bias + total / np.maximum(count, 1)


def fit(row: np.ndarray, bucket: np.ndarray, share: np.ndarray, y: np.ndarray, prior: float, steps: int = 750,
        batch: int = 32, rate: float = 1.0, scale: float = 20.0) -> SubwordSoftmax:
    """Embeddings (SIZE x DIM) and softmax weights (DIM x 2) by minibatch AdaGrad on the cross entropy."""
    prior = float(np.clip(prior, 1e-4, 1 - 1e-4))
    prior_logit = float(np.log(prior / (1 - prior)))
    if not len(y) or y.min() == y.max():
        return SubwordSoftmax(np.zeros(SIZE, np.float32), prior_logit)
    rng = np.random.default_rng(11)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (SIZE, DIM)).astype(np.float32)
    w, b = rng.normal(0, 1, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    ge, gw, gb = np.full((SIZE, DIM), 1e-6, np.float32), np.full((DIM, 2), 1e-2, np.float32), np.full(2, 1e-2, np.float32)
    start = np.searchsorted(row, np.arange(len(y) + 1))
    y = y.astype(np.int64)
    for _ in range(int(np.clip(steps * batch // len(y), 3, 8))):
        order = rng.permutation(len(y))
        for i in range(0, len(order), batch):
            own = order[i:i + batch]
            size = start[own + 1] - start[own]
            own, size = own[size > 0], size[size > 0]
            if not len(own):
                continue
            take = np.concatenate([np.arange(start[k], start[k + 1]) for k in own])
            j, x = bucket[take], share[take]
            at = np.repeat(np.arange(len(own)), size)
            mean = np.add.reduceat(emb[j] * x[:, None], np.r_[0, np.cumsum(size)[:-1]])
            z = scale * mean @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(own)), y[own]] -= 1
            p /= len(own)
            dw, db, dmean = scale * mean.T @ p, p.sum(0), scale * p @ w.T
            u, inv = np.unique(j, return_inverse=True)
            de = np.stack([np.bincount(inv, dmean[at, f] * x, len(u)) for f in range(DIM)], 1).astype(np.float32)
            ge[u] += de * de
            gw += dw * dw
            gb += db * db
            emb[u] -= rate * de / np.sqrt(ge[u])
            w -= rate * dw / np.sqrt(gw)
            b -= rate * db / np.sqrt(gb)
    seen = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
    return SubwordSoftmax((scale * emb @ (w[:, 1] - w[:, 0])).astype(np.float32),
                          float(b[1] - b[0]) + prior_logit - float(np.log(seen / (1 - seen))))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, learn: Column,
          max_labelled: tuple[int, int] = MAX_LABELLED) -> SubwordSoftmax:
    """Fit on at most ``max_labelled`` labelled documents of class 0 and of class 1 for which ``learn`` holds."""
    def one(batch: pa.RecordBatch):
        data, off = flat(batch.column("text"))
        for a, z in blocks(off):
            r, j, x = bag(data[off[a]:off[z]], off[a:z + 1] - off[a])
            cut = np.searchsorted(r, np.arange(z - a + 1)).astype(np.int32)
            yield pa.record_batch([batch.column("y").slice(a, z - a),
                                   pa.ListArray.from_arrays(cut, pa.array(j.astype(np.int32))),
                                   pa.ListArray.from_arrays(cut, pa.array(x))], ["y", "j", "x"])

    shares = {r["y"]: r["n"] for r in labels.where(F.col("toxic").isin(0, 1) & learn)
              .groupBy(F.col("toxic").cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(shares.values())
    sure = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1))
            .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
            .where("toxic = other"))
    tables = [arrow_map(labelled(docs, sure.where(F.col("toxic") == c), "toxic", learn, max_labelled[c], ["text"]), one,
                        "y int, j array<int>, x array<float>").toArrow() for c in (0, 1)]
    t = pa.concat_tables(tables)
    y = t["y"].to_numpy().astype(np.float32)
    j, x = t["j"].combine_chunks(), t["x"].combine_chunks()
    size = np.asarray(j.value_lengths()).astype(np.int64) if len(j) else np.zeros(0, np.int64)
    return fit(np.repeat(np.arange(len(y), dtype=np.int32), size), np.asarray(j.flatten()).astype(np.int32),
               np.asarray(x.flatten()).astype(np.float32), y, shares.get(1, 0) / n if n else 0.5)


def score(spark: SparkSession, docs: DataFrame, model: SubwordSoftmax, out: str = "score") -> DataFrame:
    """doc_id and the probability of toxicity of every row. One narrow pass, no shuffle."""
    shared = spark.sparkContext.broadcast((model.table, model.bias))  # SIZE floats

    def one(batch: pa.RecordBatch):
        m = SubwordSoftmax(*shared.value)
        data, off = flat(batch.column("text"))
        z = np.concatenate([m.logit(data[off[a]:off[b]], off[a:b + 1] - off[a]) for a, b in blocks(off)] or [np.zeros(0)])
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))],
                                          ["doc_id", out])

    return arrow_map(docs.select("doc_id", "text"), one, docs.select("doc_id").schema.add(out, "double"))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, folds: int = 5,
             threshold: float = THRESHOLD, max_labelled: tuple[int, int] = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(spark, docs, labels, ~held_out("doc_id", folds), max_labelled)
    return (score(spark, docs, model)
            .select("doc_id", held_out("doc_id", folds).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
