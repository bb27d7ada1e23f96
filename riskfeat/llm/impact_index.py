"""Exact top-k search by an impact-ordered score-at-a-time index.

Vectors are quantised to integers; a posting is (dimension, row, impact), the
impact being the quantised component. Each block of rows keeps its postings in segments of falling
impact (absolute value from 2^j to 2^(j+1) - 1). A search adds whole segments
to the scores, highest impact first. What the segments not yet read can add to
a score is at most the product of the query's norm and the norm of the row's
unread part, so every score has a lower and an upper bound. It stops when the
rows whose upper bound reaches the k-th best lower bound are few, and scores
exactly those from all their components; they contain every member of the
answer, ties included. If they never are few, all segments get read, which is
exact, too.

Query blocks meet index blocks in cells of bounded size; each cell returns its
best k for a query, and the best k over the cells are ranked.

Defined cases: vectors that are null or hold null or non-finite components, and
null ids, take no part; equal rows (id and vector) count once; rows that share an id
with another vector are candidates of their own, and each is a query of its own
(a query's own rows are all rows with its id); shorter vectors are filled
up with zeros; with fewer than k candidates all are returned; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskfeat.llm.common import save

ROWS_A_BLOCK, QUERIES_A_BLOCK, SIDE_BY_SIDE = 4096, 2048, 128
#: The search stops once at most this share of a block's rows may be members.
FEW = 0.05


def quantise(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """rid, vec_id, q (array of long) of every row that takes part."""
    ok = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
          & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    return (vectors.select("vec_id", "embedding").where(ok)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("q"))
            .distinct())


def segments(x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Postings (row, dimension, impact) by falling impact, and the norm of each row's postings after the segment."""
    row, dim = np.nonzero(x)
    value = x[row, dim]
    level = np.floor(np.log2(np.abs(value.astype(np.float64)))).astype(np.int64)
    rest = np.bincount(row, value.astype(np.float64) ** 2, len(x))
    for j in np.unique(level)[::-1]:
        own = level == j
        rest = rest - np.bincount(row[own], value[own].astype(np.float64) ** 2, len(x))
        yield row[own], dim[own], value[own], np.sqrt(np.maximum(rest, 0)) * (1 + 1e-9)


def matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return out


def search(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray,
           index: list[tuple], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, row number, score) of the k best rows of a block for each query."""
    out_q, out_r, out_s = [], [], []
    n, width = rows.shape
    largest = int(np.abs(queries).max(initial=0)) * int(np.abs(rows).max(initial=0)) * max(width, 1)
    if largest >= 1 << 62:
        raise OverflowError("inner products of these vectors do not fit 64-bit integers")
    exact = np.float64 if largest < 1 << 52 else np.int64
    dense = []
    for row, dim, value, rest in index:
        part = np.zeros((width, n), exact)
        part[dim, row] = value
        dense.append((part, rest))
    for a in range(0, len(queries), SIDE_BY_SIDE):
        q, ids = queries[a:a + SIDE_BY_SIDE].astype(exact), query_ids[a:a + SIDE_BY_SIDE]
        norm = np.sqrt((q.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)
        own = ids[:, None] == row_ids[None, :]
        score = np.zeros((len(q), n), exact)
        may = ~own
        for part, rest in dense:
            score += q @ part
            slack = norm[:, None] * rest[None, :]
            low = np.where(own, -np.inf, score - slack)
            if n > k:
                kth = np.partition(low, n - k, axis=1)[:, n - k]
                may = ~own & (score + slack + 0.5 >= kth[:, None])
            if may.sum() <= max(FEW * n, k) * len(q):
                break
        at_q, at_r = np.nonzero(may)
        s = (queries[a + at_q] * rows[at_r]).sum(1)  # the possible members, exactly
        order = np.lexsort((row_ids[at_r], -s, at_q))
        at_q, at_r, s = at_q[order], at_r[order], s[order]
        best = np.arange(len(at_q)) - np.searchsorted(at_q, at_q) < k
        out_q.append(a + at_q[best])
        out_r.append(at_r[best])
        out_s.append(s[best])
    return np.concatenate(out_q), np.concatenate(out_r), np.concatenate(out_s)


def top_k(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of highest inner product for each query row, ties to smaller ids."""
    v = save(spark, quantise(vectors, scale).withColumn("rid", F.monotonically_increasing_id()), "vectors")
    n, n_q = v.count(), v.where(is_query).count()
    n_blocks, n_query_blocks = -(-n // ROWS_A_BLOCK), -(-n_q // QUERIES_A_BLOCK)

    def build(block: pd.DataFrame) -> pd.DataFrame:
        x = matrix(list(block["q"]), max(map(len, block["q"])))
        seg = list(segments(x))
        return pd.DataFrame({
            "block": [block["block"].iloc[0]], "width": [x.shape[1]], "ids": [block["vec_id"].to_numpy(np.int64).tobytes()],
            "rows": [x.tobytes()], "sizes": [[len(s[0]) for s in seg]],
            "row": [np.concatenate([s[0] for s in seg] or [[]]).astype(np.int32).tobytes()],
            "dim": [np.concatenate([s[1] for s in seg] or [[]]).astype(np.int32).tobytes()],
            "impact": [np.concatenate([s[2] for s in seg] or [[]]).astype(np.int64).tobytes()],
            "rest": [np.concatenate([s[3] for s in seg] or [[]]).astype(np.float64).tobytes()]})

    index = save(spark, v.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(max(1, n_blocks))).cast("int"))
                 .groupBy("block").applyInPandas(build, "block int, width int, ids binary, rows binary, "
                                                        "sizes array<int>, row binary, dim binary, impact binary, "
                                                        "rest binary"), "impact-index")

    def cell(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("qrid", "query_id", "vec_id", "score")})
        if block.empty or queries.empty:
            return empty
        b = block.iloc[0]
        width = max(int(b["width"]), max(map(len, queries["q"])))
        ids = np.frombuffer(b["ids"], np.int64)
        rows = np.zeros((len(ids), width), np.int64)
        rows[:, :int(b["width"])] = np.frombuffer(b["rows"], np.int64).reshape(len(ids), -1)
        cut = np.r_[0, np.cumsum(b["sizes"])].astype(np.int64)
        row, dim = np.frombuffer(b["row"], np.int32), np.frombuffer(b["dim"], np.int32)
        impact, rest = np.frombuffer(b["impact"], np.int64), np.frombuffer(b["rest"], np.float64).reshape(-1, len(ids))
        seg = [(row[x:y], dim[x:y], impact[x:y], rest[i]) for i, (x, y) in enumerate(zip(cut[:-1], cut[1:], strict=True))]
        query_ids = queries["vec_id"].to_numpy(np.int64)
        q, r, s = search(matrix(list(queries["q"]), width), query_ids, rows, ids, seg, k)
        return pd.DataFrame({"qrid": queries["rid"].to_numpy(np.int64)[q], "query_id": query_ids[q], "vec_id": ids[r],
                             "score": s})

    cells_of_block = index.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(max(1, n_query_blocks) - 1))))
    cells_of_query = (v.where(is_query).withColumn("qb", F.pmod(F.xxhash64("rid"), F.lit(max(1, n_query_blocks))).cast("int"))
                      .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(1, n_blocks) - 1)))))
    best = (cells_of_block.groupBy("block", "qb").cogroup(cells_of_query.groupBy("block", "qb"))
            .applyInPandas(cell, "qrid long, query_id long, vec_id long, score long"))
    rank = F.row_number().over(W.partitionBy("qrid").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
