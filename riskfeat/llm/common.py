"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.session import checkpoint_dir, remove_folder

# Functions of this subpackage travel to the executors whole, so a worker need
# not have the package on its path.
cloudpickle.register_pickle_by_value(sys.modules["riskfeat.llm"])

#: Rows of text are worked on in blocks of about so many bytes, so that a
#: task's arrays do not grow with its partition (one longer text is one block).
BLOCK_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting that shuffle files go as soon as the query that wrote them has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting for the bytes of a batch that goes to a Python worker: the JVM and the worker each hold one, or two.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def save(spark: SparkSession, df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: what follows survives the loss of any executor, and is
    not computed again for each consumer. Shuffle files of the write are removed
    when it has ended: the table replaces them. ``batch_bytes``: of a batch that
    goes to a Python worker, about (a row is never cut); Spark's setting if not given.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    settings = {SHUFFLE_CLEANUP: "true"} | ({ARROW_BYTES: str(batch_bytes)} if batch_bytes else {})
    before = {k: spark.conf.get(k, "false" if k == SHUFFLE_CLEANUP else None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, saved: DataFrame) -> None:
    """Delete the table behind a result of ``save`` that nothing reads any more."""
    files = saved.inputFiles()
    if files:
        remove_folder(spark, files[0].rsplit("/", 1)[0])


def held_out(doc_id: str | Column, k: int) -> Column:
    """crc32(doc_id as text) mod k = 0; a null id is not held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % F.lit(k) == 0, F.lit(False))


def arrow_map(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` for a function from one batch to batches (or one)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = fn(b)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out
    return df.mapInArrow(run, schema)


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text column as one array of UTF-8 bytes and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    _, offs, data = col.buffers()
    if len(col) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def blocks(off: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows [a, b) of about ``size`` bytes together."""
    a, n = 0, len(off) - 1
    while a < n:
        b = int(np.searchsorted(off, off[a] + size, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte as it is."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)


def is_space(data: np.ndarray) -> np.ndarray:
    """The bytes 0x20 and 0x09 to 0x0D."""
    return (data == 32) | ((data - 9) <= 4)  # uint8 wraps: below 9 is above 4


def spans(data: np.ndarray, off: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of bytes not marked in ``gap``; runs do not cross rows."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~gap
    first = np.zeros(n + 1, bool)
    first[off] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    rows = np.searchsorted(off, starts, side="right") - 1
    return starts, ends, rows


_M = np.uint64(0x9E3779B97F4A7C15)
_MINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("m", ())) < n:
        with np.errstate(over="ignore"):
            for name, base in (("m", _M), ("i", _MINV)):
                x = np.full(n, base, np.uint64)
                x[0] = 1
                _powers[name] = np.cumprod(x, dtype=np.uint64)
    return _powers["m"], _powers["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power(len(data) + 1)
    c = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=c[1:])
    return mix((c[ends] - c[starts]) * down[starts])


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and hash of each lower-cased word ``[^\\x20\\x09-\\x0D]+``."""
    s, e, r = spans(data, off, is_space(data))
    return s, e, r, hash_spans(lower(data), s, e)


def row_sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n)
