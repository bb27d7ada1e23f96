"""Near-duplicate documents by min-max hashing.

A document's set holds the hashes of its distinct shingles of ``words``
lower-cased words. Each permutation gives two values, its minimum and its
maximum over the set, so a signature takes half the hash evaluations; bands of
``ROWS`` values put documents of similarity 0.8 into a common bucket but for
less than one pair in a million. Equal sets are one node (their copies are never
paired). Candidates are confirmed on their full sets, read from the texts:
100 * intersection >= 100 * similarity * union. Links become components, and the smallest
doc_id of each is kept.

Defined cases: null, empty and blank texts have the empty set and are linked with
nothing; with fewer words than a shingle the whole sequence is one; repeated
rows, also of one doc_id, are rows of equal sets; a null doc_id counts as larger
than any other (component_id is null only if no row of the component has an
id); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from riskfeat.llm.common import arrow_map, blocks, flat, mix, save, words
from riskfeat.llm.linking import components, link

ROWS, BANDS = 5, 36
PERMUTATIONS = ROWS * BANDS // 2
#: Candidates of one pivot that a task verifies together, at most.
CHUNK = 64
#: Nodes of a family in a block; a cell compares two blocks.
BLOCK = 256
#: Candidate nodes that are broadcast to find their texts, at most (8 bytes each); more are joined by a shuffle.
BROADCAST_NODES = 4_000_000

_rng = np.random.default_rng(2024)
_XOR = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2)
_MUL = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each row, sorted by (row, hash), and the n + 1 cuts between rows."""
    n = len(off) - 1
    _, _, row, h = words(data, off)
    count = np.bincount(row, minlength=n)
    first = np.r_[0, np.cumsum(count)][:-1]
    # a shingle for each word that has size - 1 words after it, and for the first word of a shorter text
    place = np.arange(len(h)) - first[row]
    start = np.flatnonzero((place + size <= count[row]) | (place == 0))
    s = np.zeros(len(start), np.uint64)
    length = np.minimum(count[row[start]], size)
    for k in range(size):
        at = np.minimum(start + k, len(h) - 1)
        s = np.where(k < length, mix(s ^ h[at]) + np.uint64(k + 1), s)
    r = row[start]
    order = np.lexsort((s, r))
    s, r = s[order], r[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (r[1:] != r[:-1])
    s, r = s[new], r[new]
    return s, np.searchsorted(r, np.arange(n + 1))


def signatures(s: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """(rows, 2 * PERMUTATIONS) minima and maxima; rows with an empty set are 0."""
    full = np.flatnonzero(cut[1:] > cut[:-1])
    out = np.zeros((len(cut) - 1, 2 * PERMUTATIONS), np.uint64)
    if len(full):
        at = cut[full]
        for p in range(PERMUTATIONS):
            v = (s ^ _XOR[p]) * _MUL[p]
            out[full, 2 * p] = np.minimum.reduceat(v, at)
            out[full, 2 * p + 1] = np.maximum.reduceat(v, at)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(rows, BANDS) keys; a band has the minimum and maximum of its permutations, and its number."""
    keys = np.zeros((len(sig), BANDS), np.uint64)
    for b in range(BANDS):
        k = np.full(len(sig), b + 1, np.uint64)
        for r in range(ROWS):
            k = mix(k ^ sig[:, b * ROWS + r]) + np.uint64(r)
        keys[:, b] = k
    return keys.view(np.int64)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """The columns of ``docs`` with rid, n, k1, k2 (128 bits that name the set), bands of every row."""
    names = docs.columns
    def one(b: pa.RecordBatch):
        data, off = flat(b.column("text"))
        for a, z in blocks(off):
            s, cut = shingles(data[off[a]:off[z]], off[a:z + 1] - off[a], size)
            n = np.diff(cut)
            c1, c2 = (np.r_[np.uint64(0), np.cumsum(x, dtype=np.uint64)] for x in
                      (mix(s ^ np.uint64(0xA5A5A5A5)), mix(s + np.uint64(0x5DEECE66D))))
            keys = band_keys(signatures(s, cut))
            bands = pa.ListArray.from_arrays(np.arange(0, (z - a + 1) * BANDS, BANDS, dtype=np.int32),
                                             pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i).slice(a, z - a) for i in range(len(names))), pa.array(n.astype(np.int64)),
                 *(pa.array((c[cut[1:]] - c[cut[:-1]]).view(np.int64)) for c in (c1, c2)), bands],
                [*names, "__n", "__k1", "__k2", "__bands"])

    schema = docs.select("*").schema.add("__n", "long").add("__k1", "long").add("__k2", "long")
    return (arrow_map(docs, one, schema.add("__bands", ArrayType(LongType())))
            .withColumn("__rid", F.monotonically_increasing_id()))


def intersections(s: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """(rows, rows) sizes of the intersections of sorted sets: frequent elements by matrix products, rare ones by lists."""
    m = len(cut) - 1
    row = np.repeat(np.arange(m), np.diff(cut))
    order = np.argsort(s, kind="stable")
    s, row = s[order], row[order]
    first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]][:len(s)])
    count = np.diff(np.r_[first, len(s)])
    out = np.zeros((m, m), np.float32)
    column = np.repeat(np.arange(len(first)), count)
    often = count[column] > 16
    r, c = row[~often], column[~often]
    pairs = np.zeros(m * m)
    for d in range(1, 16):
        same = np.flatnonzero(c[d:] == c[:-d])
        if not len(same):
            break
        pairs += np.bincount(r[same] * m + r[same + d], minlength=m * m)
    out += (pairs.reshape(m, m) + pairs.reshape(m, m).T).astype(np.float32)
    r, c = row[often], np.unique(column[often], return_inverse=True)[1]
    for a in range(0, int(c.max(initial=-1)) + 1, 4096):
        own = (c >= a) & (c < a + 4096)
        x = np.zeros((m, 4096), np.float32)
        x[r[own], c[own] - a] = 1
        out += x @ x.T
    return out


def finish(spark: SparkSession, members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between components of common buckets.

    Buckets that share members are one family. A family is dealt into blocks of about
    ``BLOCK`` nodes; a cell compares two blocks (or one with itself) on the full sets,
    all at once, and returns one link for each two components that have any.
    """
    low = save(spark, members.groupBy("key").agg(F.min("node").alias("low")), "low")
    family = components(spark, members.join(low, "key").select(F.col("node").alias("a"), F.col("low").alias("b")))
    sizes = family.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    sizes = save(spark, sizes.select(F.col("component").alias("family"), "blocks"), "sizes")
    nodes = (members.select("node", "component").distinct()
             .join(family.withColumnRenamed("component", "family"), "node"))
    cells = save(spark, nodes.join(sizes, "family").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "family", F.least("block", "j").alias("i"), F.greatest("block", "j").alias("j"), "node", "component"), "cells")

    def compare(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        node, component = (np.array(x) for x in list(zip(*rows, strict=True))[:2])
        if (component == component[0]).all():
            return
        data, off = flat(pa.array([r[2] for r in rows], pa.string()))
        s, cut = shingles(data, off, size)
        both, n = intersections(s, cut), np.diff(cut)
        linked = 100 * both >= percent * (n[:, None] + n[None, :] - both)
        x, y = np.nonzero(np.triu(linked & (component[:, None] != component[None, :]), 1))
        if len(x):
            lo, hi = np.minimum(component[x], component[y]), np.maximum(component[x], component[y])
            _, at = np.unique(np.stack([lo, hi]), axis=1, return_index=True)
            yield from zip(node[x[at]].tolist(), node[y[at]].tolist(), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, found = None, [], []
        for b in batches:
            for f, i, j, node, component, text in zip(*(b.column(k).to_pylist() for k in range(6)), strict=True):
                if (f, i, j) != at:
                    found += compare(rows) if rows else []
                    at, rows = (f, i, j), []
                rows.append((node, component, text))
        found += compare(rows) if rows else []
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return (cells.join(texts, cells.node == texts.rid).select("family", "i", "j", "node", "component", "text")
            .repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "node").mapInArrow(run, "a long, b long"))


def verifier(all_texts: DataFrame, size: int, percent: int):
    """For ``link``: of pairs (a, b) those with 100 * intersection >= percent * union of their texts' full sets.

    The candidates of a pivot are dealt out in chunks; a task reads a chunk's
    pivot, then its candidates one after the other.
    """
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, own = None, None
        for b in batches:
            data, off = flat(b.column("text"))
            a_, c_, b_ = b.column("a").to_numpy(), b.column("chunk").to_numpy(), b.column("b").to_numpy()
            found = []
            for lo, hi in blocks(off):
                s, cut = shingles(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], size)
                for k in range(lo, hi):
                    x = s[cut[k - lo]:cut[k - lo + 1]]
                    if b_[k] < 0:
                        pivot, own = (a_[k], c_[k]), x
                        continue
                    if pivot != (a_[k], c_[k]):
                        raise RuntimeError("a candidate came without its pivot")
                    short, long = (x, own) if len(x) < len(own) else (own, x)
                    if 100 * len(short) < percent * len(long):
                        continue
                    at = np.minimum(np.searchsorted(long, short), len(long) - 1)
                    both = int((long[at] == short).sum())
                    if 100 * both >= percent * (len(x) + len(own) - both):
                        found.append(k)
            yield pa.RecordBatch.from_arrays([b.column("a").take(pa.array(found, pa.int64())),
                                              b.column("b").take(pa.array(found, pa.int64()))], ["a", "b"])

    def prepare(nodes: DataFrame):
        spark = nodes.sparkSession
        own = save(spark, nodes.select(F.col("node").alias("rid")), "candidates")
        side = F.broadcast(own) if own.count() <= BROADCAST_NODES else own
        texts = save(spark, all_texts.join(side, "rid"), "texts")
        return (lambda pairs: verify(spark, pairs, texts)), (lambda members: finish(spark, members, texts, size, percent))

    def verify(spark: SparkSession, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        n = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        n = save(spark, n.where(F.col("n") > CHUNK), "large")
        pairs = (pairs.join(n, "a", "left")
                 .withColumn("chunk", F.when(F.col("n").isNull(), F.lit(0)).otherwise(
                     F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / (CHUNK // 2)))).cast("int")).drop("n"))
        pairs = save(spark, pairs, "chunks")
        rows = (pairs.join(texts, pairs.b == texts.rid).select("a", "chunk", "b", "text").unionByName(
            pairs.select("a", "chunk").distinct().join(texts, F.col("a") == texts.rid)
            .select("a", "chunk", F.lit(-1).cast("long").alias("b"), "text")))
        return (rows.repartition("a", "chunk").sortWithinPartitions("a", "chunk", "b")
                .mapInArrow(check, "a long, b long"))

    return prepare


def _sketched(spark: SparkSession, docs: DataFrame, size: int) -> DataFrame:
    return save(spark, sketches(docs, size), "sketches")


def _classes(spark: SparkSession, saved: DataFrame, size: int, percent: int) -> DataFrame:
    """rid, doc_id, n_shingles, component_id, kept, first of every row of a saved table of sketches."""
    rows = saved.select("doc_id", "text", *[F.col(f"__{c}").alias(c) for c in ("rid", "n", "k1", "k2", "bands")])
    order = F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id"), F.col("rid"))
    nodes = save(spark, rows.where("n > 0").groupBy("k1", "k2").agg(
        F.min("rid").alias("node"), F.min(order).alias("low"), F.first("bands").alias("bands")), "nodes")
    entries = nodes.select(F.explode("bands").alias("key"), "node")
    group = link(spark, entries, verifier(rows.select("rid", "text"), size, percent), rounds=0)
    named = nodes.select("k1", "k2", "node", "low").join(group, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    named = save(spark, named, "grouped")
    least = save(spark, named.groupBy("component").agg(F.min("low").alias("low")), "least")
    named = save(spark, named.select("k1", "k2", "component").join(least, "component")
                 .select("k1", "k2", F.col("low.doc_id").alias("component_id"), F.col("low.rid").alias("first_rid"),
                         F.lit(True).alias("has")), "named")
    return (rows.select("rid", "doc_id", "n", "k1", "k2").join(named, ["k1", "k2"], "left")
            .select("rid", "doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("has"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.coalesce(F.col("first_rid") == F.col("rid"), F.lit(True)).alias("first"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """rid, doc_id, n_shingles, component_id, kept (doc_id = component_id), first (one row of each component)."""
    return _classes(spark, _sketched(spark, docs.select("doc_id", "text"), size), size, percent)


def clean(spark: SparkSession, docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, all columns, with the first row of each component only."""
    saved = _sketched(spark, docs, size)
    gone = save(spark, _classes(spark, saved, size, percent).where("not first").select(F.col("rid").alias("__rid")), "gone")
    return saved.join(gone, "__rid", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
