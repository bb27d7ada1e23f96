"""Best-fit packing by bin completion.

Every document becomes its token ids and an end id; only longer ones than a
sequence are cut. All that the choice of sequences depends on is how many
pieces have each length: a table of at most ``capacity`` rows, which the driver
packs into patterns (lengths that share a sequence, and how often). Branch and
bound: around the largest length left, undominated fillings are enumerated and
branches are pruned by the waste that an improvement may have; best-fit
decreasing gives the incumbent, and it is returned at once if it meets the
lower bound. The search for a better one has a documented node limit; the
incumbent stands if it runs out.

The pieces never pass through the driver: each gets its rank among those of its
length, by blocks of bounded size, and rank and pattern give its place. Equal
pieces are interchangeable, so a third of all rows of one length is no hot key.

Defined cases: null text is empty (one piece, the end id); repeated rows and
repeated or null doc_ids are packed row by row; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskfeat.llm.common import arrow_map, save
from riskfeat.llm.tokens import TOKENIZER, Encoder

CAPACITY = 4096
END_ID = 1
#: Rows of one length that a task ranks together, at most.
BLOCK = 512
NODES = 1500

Pattern = tuple[tuple[int, int], ...]  # (length, how many), lengths falling


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over a histogram: each length in turn goes to the fullest sequences that it fits."""
    rooms: dict[int, list[list]] = {}  # room left -> [pattern, sequences]
    order: list[int] = []

    def put(room: int, pattern: Pattern, n: int) -> None:
        if n:
            if room not in rooms:
                rooms[room] = []
                insort(order, room)
            rooms[room].append([pattern, n])

    for length in sorted(counts, reverse=True):
        c = counts[length]
        while c:
            k = bisect_left(order, length)
            if k == len(order):
                pattern, n, room = (), c, capacity
            else:
                room = order[k]
                pattern, n = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room], order[k]
            fit = room // length
            full = min(n, c // fit)
            put(room - fit * length, (*pattern, (length, fit)), full)
            c -= full * fit
            if full < n and pattern == () and k == len(order) and not c:
                continue
            if full < n and c:  # fewer left than one more sequence takes
                put(room - c * length, (*pattern, (length, c)), 1)
                full, c = full + 1, 0
            if pattern:
                put(room, pattern, n - full)
    return [(p, n) for group in rooms.values() for p, n in group]


def fillings(rising: list[int], counts: dict[int, int], room: int, limit: int) -> list[tuple[int, ...]]:
    """At most ``limit`` undominated fillings of ``room``, the fullest first: none takes one more length, a larger length in
    place of one of its own, or one length in place of two. ``rising``: the lengths there are, ``counts`` how many."""
    found: set[tuple[int, ...]] = set()
    steps = 20 * limit

    def spare(least: int, have: dict[int, int]) -> int:
        """The smallest length from ``least`` on that is not used up; beyond ``room`` if there is none."""
        k = bisect_left(rising, least)
        while k < len(rising) and counts[rising[k]] <= have.get(rising[k], 0):
            k += 1
        return rising[k] if k < len(rising) else room + 1

    def undominated(f: tuple[int, ...], left: int) -> bool:
        have = Counter(f)
        if spare(1, have) <= left or any(spare(y + 1, have) <= y + left for y in have):
            return False
        two = sum(f[-2:])
        return len(f) < 2 or spare(two, have) > two + left

    def grow(k: int, left: int, own: tuple[int, ...]) -> None:
        nonlocal steps
        steps -= 1
        k = min(k, bisect_right(rising, left) - 1)
        if k < 0:
            if undominated(own, left):
                found.add(own)
            return
        x = rising[k]
        for n in range(min(counts[x], left // x), -1, -1):
            if steps < 0 or len(found) >= limit:
                return
            grow(k - 1, left - n * x, own + (x,) * n)

    grow(len(rising) - 1, room, ())
    return sorted(found, key=lambda f: (-sum(f), f))


def bin_completion(counts: dict[int, int], capacity: int, nodes: int = NODES) -> list[tuple[Pattern, int]]:
    """Patterns and how often each is used, all pieces placed, in as few sequences as found.

    A node of the search fills sequences around the largest length left, with
    one filling as often as the counts allow.
    """
    best = best_fit(counts, capacity)
    n_best = sum(n for _, n in best)
    total = sum(x * c for x, c in counts.items())
    # more than half a sequence: no two of them share one
    bound = max(-(-total // capacity), sum(c for x, c in counts.items() if 2 * x > capacity))
    state = {x: c for x, c in counts.items() if c}
    rising = sorted(state)

    def take(pattern: Counter, m: int) -> None:
        for y, c in pattern.items():
            before = state[y]
            state[y] = before - m * c
            if m > 0 and not state[y]:
                del rising[bisect_left(rising, y)]
            elif m < 0 and not before:
                insort(rising, y)

    def options(waste: int) -> list[tuple[Counter, int, int]]:
        """What a better packing may do next, the worst first: pattern, how often, waste with it."""
        x = rising[-1]
        state[x] -= 1
        rest = rising if state[x] else rising[:-1]
        found = fillings(rest, state, capacity - x, 16) or [()]
        state[x] += 1
        out = []
        for f in reversed(found):
            pattern = Counter((x, *f))
            m = min(state[y] // c for y, c in pattern.items())
            after = waste + m * (capacity - x - sum(f))
            if after <= (n_best - 1) * capacity - total:  # else it cannot save a sequence
                out.append((pattern, m, after))
        return out

    done: list[tuple[Counter, int]] = []
    stack = [options(0)] if n_best > bound else []
    while stack and nodes > 0 and n_best > bound:
        if not stack[-1]:
            stack.pop()
            if done:
                pattern, m = done.pop()
                take(pattern, -m)
            continue
        nodes -= 1
        pattern, m, waste = stack[-1].pop()
        take(pattern, m)
        done.append((pattern, m))
        if rising:
            stack.append(options(waste))
        else:
            used = sum(k for _, k in done)
            if used < n_best:
                best, n_best = [(tuple(sorted(p.items(), reverse=True)), k) for p, k in done], used
            stack.append([])
    return best


def places(patterns: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """For each length the runs of ranks that a pattern takes, sorted by (length, first rank)."""
    rows, taken, base = [], Counter(), 0
    for pattern, n in patterns:
        at = 0
        for length, c in pattern:
            rows.append((length, taken[length], n, base, at))
            taken[length] += n * c
            at += length * c
        base += n
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 5)
    return {"key": (a[:, 0] << 44) + a[:, 1], "first": a[:, 1], "n": a[:, 2], "base": a[:, 3], "at": a[:, 4]}


def pieces(docs: DataFrame, capacity: int = CAPACITY, name: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every row; length is 1 at least."""
    def one(b: pa.RecordBatch):
        enc, end = Encoder(name), np.array([end_id], "<u4").tobytes()
        row, piece, start, length, crc = [], [], [], [], []
        for k, x in enumerate(b.column("text").to_pylist()):
            ids = memoryview((enc.pieces(x) if x else b"") + end)
            for p, s in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[s:s + 4 * capacity]
                row.append(k)
                piece.append(p)
                start.append(s // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
             pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
            ["doc_id", "piece", "start", "length", "ids_crc32"])

    schema = (docs.select("doc_id").schema.add("piece", "integer").add("start", "long").add("length", "long")
              .add("ids_crc32", "long"))
    return arrow_map(docs.select("doc_id", "text"), one, schema)


def pack(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY, name: str = TOKENIZER,
         end_id: int = END_ID, nodes: int = NODES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = save(spark, pieces(docs, capacity, name, end_id).withColumn("rid", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = places(bin_completion(counts, capacity, nodes))  # at most a few runs for each of `capacity` lengths
    shared = spark.sparkContext.broadcast(table)

    # rank among the pieces of a length: its place in its block, after the blocks before
    cut = cut.withColumn("block", F.floor(F.col("rid") / BLOCK))
    before = (cut.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.sum("n").over(W.partitionBy("length").orderBy("block")) - F.col("n"))
              .select("length", "block", "before"))
    ranked = (cut.withColumn("own", F.row_number().over(W.partitionBy("length", "block").orderBy("rid")) - 1)
              .join(before, ["length", "block"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("own")).alias("rank")))

    def place(b: pa.RecordBatch):
        t = shared.value
        length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
        k = np.searchsorted(t["key"], (length << 44) + rank, side="right") - 1
        j = rank - t["first"][k]
        own = [b.column(i) for i in range(5)]
        return pa.RecordBatch.from_arrays(
            [*own, pa.array(t["base"][k] + j % t["n"][k]), pa.array(t["at"][k] + j // t["n"][k] * length)],
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    schema = (docs.select("doc_id").schema.add("piece", "integer").add("start", "long").add("length", "long")
              .add("ids_crc32", "long").add("sequence_id", "long").add("offset", "long"))
    return arrow_map(ranked, place, schema)
