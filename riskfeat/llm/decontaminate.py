"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits in Unicode lower case, so case and signs do not
hide a copy; in scripts written without blanks (Han, Kana, Thai, Lao, Khmer, Myanmar) each
character is a word. Every benchmark word is counted over the whole corpus. A seed is three
words in order that stand within four places (``SHAPES``); its hash does not tell the shapes
apart, so a seed survives a word put in or left out between its words, and any long copy
that keeps more than half of its words in place keeps a seed. A seed
is rare if its words would meet by chance at no more than ``RARE`` of all places;
an item's rare seeds (its ``FEWEST`` rarest at least) are looked for. Copies do not make
their own seeds common, so an item that leaked into every document is still found. Where
a text hits seeds of an item, the stretch of the text around the hits is aligned
with the whole item (match 2, mismatch and gap -1). The score over its highest
possible value tells exact and edited copies (1.0 down to ``THRESHOLD``) from chance;
a part of an item is a copy too if ``VERBATIM`` words stand in a row. One hit is enough to
align an item of ``LONG`` words or more; shorter items, of which three words can be chance,
need two different seeds.

The benchmark is taken in parts of bounded size, each broadcast to one narrow
pass over the corpus; nothing of the corpus is shuffled but word counts.

Defined cases: null, empty or shorter texts hit nothing; null items and those of fewer than
three words have no seeds and are never found; texts of any length are read whole, block by block;
repeated items are found under each of their ids; repeated rows are judged alike (one row for each
id and item, with the highest score; equal scores are one); an empty table gives
no rows (or, when cleaning, all rows stay); other columns are kept as they are when cleaning and ignored
otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.llm.common import blocks, flat, hash_spans, mix, spans

#: Places of a seed's words: all ways to take three words in order from four places or fewer.
SHAPES = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
RARE = 1e-7
FEWEST = 24
THRESHOLD = 0.5
VERBATIM = 13
LONG = 16
# Code points of signs and blanks beyond ASCII, and of scripts whose characters are taken one by one.
SIGNS = ((0x80, 0xA9), (0xAB, 0xB4), (0xB6, 0xB9), (0xBB, 0xBF), (0xD7, 0xD7), (0xF7, 0xF7), (0x2000, 0x206F), (0x2E00, 0x2E7F),
         (0x3000, 0x3004), (0x3008, 0x3020), (0x3030, 0x3030), (0x30FB, 0x30FB), (0xFE10, 0xFE6F), (0xFEFF, 0xFEFF),
         (0xFF00, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))
ALONE = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x3400, 0x4DBF),
         (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
#: Bytes of benchmark text that one pass over the corpus looks for.
PART_BYTES = 16_000_000
#: Cells of alignment tables that are filled side by side.
CELLS = 2_000_000
#: Seed hits and alignments that a task holds at a time.
HITS, JOBS = 200_000, 2_000


def folded(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts in Unicode lower case, as one array of bytes and offsets."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    try:
        col = pc.utf8_lower(col.cast(pa.large_string()))
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        col = pa.array([x if x is None else x.decode(errors="replace").lower() for x in col.cast(pa.large_binary()).to_pylist()],
                       pa.large_string())
    return flat(col)


def signs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to no word, and which begin a character that is a word by itself, or follow one."""
    gap = ~(((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128))
    cut = np.zeros(len(data) + 1, bool)
    lead = np.flatnonzero(data >= 0xC2)
    if not len(lead):
        return gap, cut[:-1]
    wide = np.zeros(len(data) + 4, np.uint32)
    wide[:len(data)] = data
    size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
    mask = np.array([0, 0, 0x1F, 0x0F, 0x07], np.uint32)[size]
    point = wide[lead] & mask
    for k in range(1, 4):
        point = np.where(size > k, (point << np.uint32(6)) | (wide[lead + k] & np.uint32(0x3F)), point)
    sign, alone = np.zeros(len(lead), bool), np.zeros(len(lead), bool)
    for (a, z) in SIGNS:
        sign |= (point >= a) & (point <= z)
    for (a, z) in ALONE:
        alone |= (point >= a) & (point <= z)
    for k in range(4):
        at = (lead + k)[sign & (size > k)]
        gap[at[at < len(data)]] = True
    cut[lead[alone]] = True
    after = (lead + size)[alone]
    cut[after[after <= len(data)]] = True
    return gap, cut[:-1]


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each word of lower-cased texts."""
    gap, cut = signs(data)
    s, e, row = spans(data, off, gap)
    at = np.flatnonzero(cut & ~gap)
    if len(at):
        every = np.union1d(s, at)
        run = np.searchsorted(s, every, side="right") - 1
        e = np.minimum(e[run], np.r_[every[1:], len(data)])
        s, row = every, row[run]
    return row, hash_spans(data, s, e)


def seeds(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, shape and hash of each three words that lie in one row."""
    out = []
    for shape, places in enumerate(SHAPES):
        n = max(0, len(h) - places[-1])
        at = np.flatnonzero(row[:n] == row[places[-1]:]) if n else np.zeros(0, np.int64)
        g = np.zeros(len(at), np.uint64)
        for k, p in enumerate(places):
            g = mix(g ^ h[at + p]) + np.uint64(k + 1)
        out.append((at, np.full(len(at), shape), g))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Items:
    """A part of the benchmark: each item's words and seeds, sorted by hash."""

    def __init__(self, texts: list[str]):
        row, h = word_hashes(*folded(pa.array(texts, pa.string())))
        cut = np.searchsorted(row, np.arange(len(texts) + 1))
        self.words = [h[cut[k]:cut[k + 1]] for k in range(len(texts))]
        at, self.shape, self.gram = seeds(row, h)
        self.item = row[at]
        self.place = at - cut[self.item]

    @classmethod
    def of(cls, *parts) -> Items:
        self = cls.__new__(cls)
        self.words, self.gram, self.item, self.place = parts
        return self

    def choose(self, known: np.ndarray, count: np.ndarray) -> None:
        """Keep the rare seeds of each item, given how often each known word stands in the corpus (the last count: all words)."""
        share = np.log((count[:-1] + 1) / (count[-1] + 1))
        chance = np.zeros(len(self.gram))
        every = np.concatenate([*self.words, np.zeros(0, np.uint64)])
        first = np.r_[0, np.cumsum([len(w) for w in self.words])]
        at = first[self.item] + self.place
        for p in np.array(SHAPES).T:
            chance += share[np.searchsorted(known, every[at + p[self.shape]])]
        order = np.lexsort((self.shape, self.place, chance, self.item))
        first = np.searchsorted(self.item[order], self.item[order])
        order = order[(np.arange(len(order)) - first < FEWEST) | (chance[order] <= np.log(RARE))]
        order = order[np.argsort(self.gram[order], kind="stable")]
        self.gram, self.item, self.place = self.gram[order], self.item[order], self.place[order]

    def hits(self, g: np.ndarray) -> np.ndarray:
        """Which of the hashes are seeds: by a bit map of their low bits first."""
        bits = max(16, min(24, 5 + int(len(self.gram)).bit_length()))
        low = np.uint64((1 << bits) - 1)
        seen = np.zeros(1 << bits, bool)
        seen[self.gram & low] = True
        maybe = np.flatnonzero(seen[g & low])
        at = np.minimum(np.searchsorted(self.gram, g[maybe]), len(self.gram) - 1)
        return maybe[self.gram[at] == g[maybe]]


def align(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman score of each (item words, text words) over the highest possible, and the most words in a row that
    both share; side by side by size."""
    out, rows = np.zeros(len(pairs)), np.zeros(len(pairs), np.int64)
    order = sorted(range(len(pairs)), key=lambda k: (len(pairs[k][0]), len(pairs[k][1])))
    a = 0
    while a < len(order):
        b, wide = a, 0
        m = len(pairs[order[a]][0])
        while b < len(order) and len(pairs[order[b]][0]) == m and (
                b == a or max(wide, len(pairs[order[b]][1])) * (b - a + 1) <= CELLS // 32):
            wide = max(wide, len(pairs[order[b]][1]))
            b += 1
        own = order[a:b]
        item = np.stack([pairs[k][0] for k in own])
        text, real = np.zeros((len(own), wide), np.uint64), np.zeros((len(own), wide), bool)
        for r, k in enumerate(own):
            text[r, :len(pairs[k][1])] = pairs[k][1]
            real[r, :len(pairs[k][1])] = True
        slope = np.arange(wide + 1, dtype=np.int32)
        h = np.zeros((len(own), wide + 1), np.int32)
        best = np.zeros(len(own), np.int32)
        run, longest = np.zeros((len(own), wide + 1), np.int32), np.zeros(len(own), np.int32)
        for i in range(m):
            same = (text == item[:, i:i + 1]) & real
            step = np.where(same, 2, -1)
            run[:, 1:] = (run[:, :-1] + 1) * same
            longest = np.maximum(longest, run.max(1))
            t = np.maximum(h - 1, 0)
            t[:, 1:] = np.maximum(t[:, 1:], h[:, :-1] + step)
            # a gap in the item costs 1 a word: the best of all places before, less the distance
            h = np.maximum.accumulate(t + slope, axis=1) - slope
            best = np.maximum(best, h.max(1))
        out[own], rows[own] = best / (2 * m), longest
        a = b
    return out, rows


def find(items: Items, data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, float, int]]:
    """(row, item, score, seeds hit) of each item that a row of a block holds a copy of."""
    row, h = word_hashes(data, off)
    at, _, g = seeds(row, h)
    if not len(at) or not len(items.gram):
        return
    hit = items.hits(g)
    if not len(hit):
        return
    lo, up = np.searchsorted(items.gram, g[hit]), np.searchsorted(items.gram, g[hit], side="right")
    size = up - lo
    if size.sum() > HITS and len(off) > 2:  # a common seed: fewer rows at a time
        half = len(off) // 2
        yield from find(items, data[:off[half]], off[:half + 1])
        for own, *what in find(items, data[off[half]:], off[half:] - off[half]):
            yield half + own, *what
        return
    seed = np.repeat(lo - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    pos = np.repeat(at[hit], size)
    item, place, r = items.item[seed], items.place[seed], row[pos]
    # a hit speaks for a copy that begins about there
    begin = pos - place
    order = np.lexsort((begin, item, r))
    r, item, begin, seed = r[order], item[order], begin[order], seed[order]
    length = np.array([len(w) for w in items.words], np.int64)
    slack = np.maximum(8, length[item] // 4)
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (item[1:] != item[:-1]) | (begin[1:] - begin[:-1] > 2 * slack[1:] + length[item[1:]])
    starts = np.flatnonzero(new)
    ends = np.r_[starts[1:], len(r)]
    cut = np.searchsorted(row, np.arange(len(off)))
    n_seeds = np.bincount(items.item, minlength=len(items.words))
    jobs, what = [], []

    def judged() -> Iterator[tuple[int, int, float, int]]:
        for (own, k, n), x, in_a_row in zip(what, *align(jobs), strict=True):
            if x >= THRESHOLD or in_a_row >= VERBATIM:
                yield own, k, float(x), n
        jobs.clear()
        what.clear()

    for s, e in zip(starts, ends, strict=True):
        if len(jobs) == JOBS:
            yield from judged()
        k, own = int(item[s]), int(r[s])
        n = len(np.unique(items.gram[seed[s:e]])) if e - s > 1 else 1
        if length[k] < LONG and n < min(2, n_seeds[k]):
            continue
        a = max(cut[own], begin[s] - slack[s])
        b = min(cut[own + 1], begin[e - 1] + length[k] + slack[s])
        jobs.append((items.words[k], h[a:b]))
        what.append((own, k, n))
    yield from judged()


def parts(benchmark: DataFrame) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of the items, in parts of about PART_BYTES."""
    items = benchmark.select("item_id", "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // PART_BYTES)
    for k in range(n):
        got = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        if got:
            yield [r["item_id"] for r in got], [r["text"] for r in got]


def seeded(spark: SparkSession, docs: DataFrame, texts: list[str]) -> tuple:
    """The parts of the Items, with their seeds; their words are counted over all documents."""
    items = Items(texts)
    known = np.unique(np.concatenate([*items.words, np.zeros(0, np.uint64)]))
    shared = spark.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        total = np.zeros(len(known) + 1, np.int64)
        for b in batches:
            data, off = folded(b.column("text"))
            for a, z in blocks(off):
                _, h = word_hashes(data[off[a]:off[z]], off[a:z + 1] - off[a])
                k = np.minimum(np.searchsorted(known, h), len(known) - 1)
                total += np.bincount(np.where(known[k] == h, k, len(known)), minlength=len(known) + 1)
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(total[slot])], ["slot", "n"])

    n = np.zeros(len(known) + 1, np.int64)
    if len(known):
        got = docs.select("text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
        n[got["slot"].to_numpy()] = got["n"].to_numpy()
    n[-1] = n.sum()
    items.choose(known, n)
    return items.words, items.gram, items.item, items.place


def matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, seeds: one row for each document and item of which it holds a copy."""
    id_type, item_type = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    out = spark.createDataFrame([], f"doc_id {id_type.simpleString()}, item_id {item_type.simpleString()}, "
                                    "score double, seeds long")
    for ids, texts in parts(benchmark):
        shared = spark.sparkContext.broadcast((pa.array(ids, out_type(item_type)), seeded(spark, docs, texts)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, items = shared.value[0], Items.of(*shared.value[1])
            for b in batches:
                data, off = folded(b.column("text"))
                found = [(a + r, k, x, n) for a, z in blocks(off)
                         for r, k, x, n in find(items, data[off[a]:off[z]], off[a:z + 1] - off[a])]
                r, k, x, n = zip(*found, strict=True) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(r, pa.int64())), names.take(pa.array(k, pa.int64())),
                     pa.array(x, pa.float64()), pa.array(n, pa.int64())], ["doc_id", "item_id", "score", "seeds"])

        out = out.unionByName(docs.select("doc_id", "text").mapInArrow(run, out.schema))
    return out.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), F.max("seeds").alias("seeds"))


def out_type(t) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(t)


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no copy of an item, all columns. Narrow passes, no shuffle of documents."""
    out = docs
    for _, texts in parts(benchmark):
        shared = spark.sparkContext.broadcast(seeded(spark, docs, texts))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items.of(*shared.value)
            for b in batches:
                data, off = folded(b.column("text"))
                bad = np.zeros(b.num_rows, bool)
                for a, z in blocks(off):
                    for r, *_ in find(items, data[off[a]:off[z]], off[a:z + 1] - off[a]):
                        bad[a + r] = True
                yield b.filter(pa.array(~bad))

        out = out.mapInArrow(run, docs.schema)
    return out
