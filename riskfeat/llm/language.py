"""Language ID by cross-parsing: the language in whose labelled text a text needs fewest normalised phrases.

Of each language a bounded sample of labelled text becomes a suffix automaton. A text is parsed greedily against
each: a phrase is the longest string from here on that occurs in the sample (a byte that never occurs there is a
phrase of its own). A language's cost is phrases * log2(2 + bytes learnt), the bits that name the phrases; the
least cost wins, ties go to the smaller name. ``score`` is second / (best + second) of the two least costs.

Text is read as UTF-8 bytes, A-Z lowered. Whole texts are parsed, in pieces of ``PIECE`` bytes; the parse begins
anew with each piece, so very long texts are parsed side by side like many short ones. Of the sample, each language
gives at most ``SLICES`` distinct texts (those of smallest xxhash64), each a slice of at most ``SLICE`` characters
that begins at a place told by that hash; at most ``LANGUAGES`` languages are learnt, those of most texts.

Defined cases: null text and text without a letter give ``und`` and score 0, as does everything when nothing is
learnt; with one language learnt the score is 1; rows of null lang or text teach nothing, a null doc_id is not held
out; equal texts of a language count once in the sample; rows equal in all columns are scored each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskfeat.llm.common import arrow_map, blocks, flat, held_out, lower

SLICES, SLICE = 96, 512
LANGUAGES = 256
PIECE = 1024
#: Stands between slices; no UTF-8 text holds this byte, so no match goes across.
BETWEEN = b"\xff"
UNKNOWN = "und"


def automaton(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """State, byte and target of each transition of the suffix automaton of ``text``; state 0 is the root."""
    length, back, out = [0], [-1], [{}]
    last = 0
    for b in text:
        new = len(length)
        length.append(length[last] + 1)
        back.append(0)
        out.append({})
        p = last
        while p >= 0 and b not in out[p]:
            out[p][b] = new
            p = back[p]
        if p >= 0:
            q = out[p][b]
            if length[q] == length[p] + 1:
                back[new] = q
            else:  # q stands for longer strings too: those that end in p + b get a state of their own
                twin = len(length)
                length.append(length[p] + 1)
                back.append(back[q])
                out.append(dict(out[q]))
                back[q] = back[new] = twin
                while p >= 0 and out[p].get(b) == q:
                    out[p][b] = twin
                    p = back[p]
        last = new
    size = [len(o) for o in out]
    return (np.repeat(np.arange(len(out)), size), np.array([b for o in out for b in o], np.int64),
            np.array([t for o in out for t in o.values()], np.int64))


@dataclass
class Parser:
    """The automata of all languages: transitions in one open-addressed table of keys state * 256 + byte."""
    names: list[str]
    weight: np.ndarray
    roots: np.ndarray
    first: np.ndarray
    key: np.ndarray
    target: np.ndarray

    @staticmethod
    def slot(key: np.ndarray, bits: int) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    @classmethod
    def build(cls, automata: list[tuple[str, int, np.ndarray, np.ndarray, np.ndarray]]) -> Parser:
        """From (name, bytes learnt, states, bytes, targets) of each language, in order of name."""
        roots, keys, targets, start = [], [], [], 0
        first = np.zeros((len(automata), 256), np.int64)
        for k, (_, _, s, b, t) in enumerate(automata):
            roots.append(start)
            keys.append(((s + start) << 8) | b)
            targets.append(t + start)
            first[k] = start
            first[k, b[s == 0]] = t[s == 0] + start
            start += int(max(s.max(initial=0), t.max(initial=0))) + 1
        want = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        goal = np.concatenate(targets) if targets else np.zeros(0, np.int64)
        bits = max(8, int(4 * len(want)).bit_length())
        key, target = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        at = cls.slot(want, bits)
        while len(want):
            free = np.flatnonzero(key[at] < 0)
            _, own = np.unique(at[free], return_index=True)
            put = free[own]
            key[at[put]], target[at[put]] = want[put], goal[put]
            rest = np.ones(len(want), bool)
            rest[put] = False
            want, goal, at = want[rest], goal[rest], (at[rest] + 1) & ((1 << bits) - 1)
        return cls([a[0] for a in automata], np.array([np.log2(2 + a[1]) for a in automata]),
                   np.array(roots, np.int64), first, key, target)

    def step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Target of each transition and whether there is one."""
        want = (state << 8) | byte
        bits = len(self.key).bit_length() - 1
        at = self.slot(want, bits)
        got = self.key[at]
        found = got == want
        to = self.target[at]
        open_ = np.flatnonzero((~found & (got >= 0)).ravel())
        if len(open_):
            want, at, found, to = want.ravel(), at.ravel(), found.ravel(), to.ravel()
            while len(open_):
                at[open_] = (at[open_] + 1) & (len(self.key) - 1)
                got = self.key[at[open_]]
                hit = got == want[open_]
                found[open_[hit]] = True
                to[open_[hit]] = self.target[at[open_[hit]]]
                open_ = open_[~hit & (got >= 0)]
            found, to = found.reshape(state.shape), to.reshape(state.shape)
        return to, found

    def phrases(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Phrases of each text (rows) for each language (columns). All pieces of all texts are parsed in step."""
        n = len(off) - 1
        count = -(-np.diff(off) // PIECE)
        row = np.repeat(np.arange(n), count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        start = off[row] + nth * PIECE
        size = np.minimum(off[row + 1] - start, PIECE)
        order = np.argsort(-size, kind="stable")
        start, size, row = start[order], size[order], row[order]
        alive = np.searchsorted(-size, -np.arange(1, PIECE + 1), side="right")  # pieces of that many bytes or more
        low = lower(data).astype(np.int64)
        state = np.tile(self.roots, (len(row), 1))
        total = np.zeros((len(row), len(self.names)), np.int64)
        langs = np.arange(len(self.names))
        for j in range(int(size[0]) if len(size) else 0):
            m = alive[j]
            s, byte = state[:m], low[start[:m] + j][:, None]
            to, found = self.step(s, byte)
            total[:m] += ~found | (s == self.roots)
            state[:m] = np.where(found, to, self.first[langs, byte])
        return np.stack([np.bincount(row, total[:, k], n) for k in langs], 1) if len(langs) else np.zeros((n, 0))


def sample(docs: DataFrame, learn: Column, slices: int = SLICES, slice_chars: int = SLICE,
           languages: int = LANGUAGES) -> DataFrame:
    """lang, h, slice: at most ``slices`` slices of distinct texts of each learnt language."""
    rows = (docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != ""))
            .select(F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("h"), "text"))
    ids = rows.select("lang", "h").distinct()
    by_size = ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).select("lang")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = ids.withColumn("nth", nth).where(F.col("nth") <= slices).join(F.broadcast(by_size), "lang").select("lang", "h")
    begin = F.pmod("h", F.greatest(F.length("text") - slice_chars + 1, F.lit(1)).cast("long")).cast("int") + 1
    return (rows.join(F.broadcast(chosen), ["lang", "h"])  # at most slices * languages rows of two short values
            .select("lang", "h", F.substring("text", begin, F.lit(slice_chars)).alias("slice"))
            .groupBy("lang", "h").agg(F.min("slice").alias("slice")))


def train(spark: SparkSession, docs: DataFrame, learn: Column, slices: int = SLICES, slice_chars: int = SLICE,
          languages: int = LANGUAGES) -> Parser:
    """One automaton per language, built on the executors from the bounded sample; the driver gets transitions only."""
    def one(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["h", "slice"])
        raw = BETWEEN.join(t.encode("utf-8") for t in part["slice"])
        s, b, t = automaton(lower(np.frombuffer(raw, np.uint8)).tobytes())
        return pd.DataFrame({"lang": [part["lang"].iloc[0]], "n": [len(raw)], "s": [s.astype("<i4").tobytes()],
                             "b": [b.astype("u1").tobytes()], "t": [t.astype("<i4").tobytes()]})

    rows = (sample(docs, learn, slices, slice_chars, languages).groupBy("lang")
            .applyInPandas(one, "lang string, n long, s binary, b binary, t binary").collect())
    of = lambda raw, kind: np.frombuffer(bytes(raw), kind).astype(np.int64)
    return Parser.build([(r.lang, r.n, of(r.s, "<i4"), of(r.b, "u1"), of(r.t, "<i4"))
                         for r in sorted(rows, key=lambda r: r.lang)])


def predict(spark: SparkSession, docs: DataFrame, model: Parser) -> DataFrame:
    """doc_id, lang_pred, score of every row; one narrow pass."""
    shared = spark.sparkContext.broadcast(model)  # at most 3 transitions a learnt byte
    plain = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has"))

    def one(b: pa.RecordBatch):
        m = shared.value
        data, off = flat(b.column("text"))
        has = b.column("has").to_numpy(zero_copy_only=False).astype(bool)
        for a, z in blocks(off):
            n = z - a
            name, score = np.full(n, UNKNOWN, object), np.zeros(n)
            if m.names:
                cost = m.phrases(data[off[a]:off[z]], off[a:z + 1] - off[a]) * m.weight
                best = np.argmin(cost, 1)  # the first of equal ones
                two = np.partition(cost, 1, axis=1)[:, :2] if len(m.names) > 1 else None
                sure = np.ones(n) if two is None else two[:, 1] / np.maximum(two.sum(1), 1e-9)
                own = has[a:z]
                name[own] = np.array(m.names, object)[best[own]]
                score[own] = sure[own]
            yield pa.record_batch([b.column("doc_id").slice(a, n), pa.array(name, pa.string()), pa.array(score)],
                                  ["doc_id", "lang_pred", "score"])

    return arrow_map(plain, one, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def identify(spark: SparkSession, docs: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learnt from those not held out."""
    model = train(spark, docs, ~held_out("doc_id", folds))
    return predict(spark, docs, model).select("doc_id", held_out("doc_id", folds).alias("held_out"), "lang_pred", "score")
