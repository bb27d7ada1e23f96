import zlib
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import pytest

from riskfeat.llm import packing, tokens
from tests.llm.helpers import awkward, documents, table

LIB = tokens.tokenizer(tokens.TOKENIZER)


def whole(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


TEXTS = ["", " ", "Hello, world! don't <|endoftext|> stop", "<|STARTOFTEXT|>", "á ́b ÉTÉ ΣΟΣ ẞ",
         "x" * 900, "中文" * 300, "a.b.c,,, d;;e 1234 5", "tab\tnl\ncr\rvt\x0bff\x0cnbsp em x\x1cy\x85z",
         "word's we'll I'M they've" * 30, "\U0001f600 İstanbul ﬁn"]


@pytest.mark.parametrize("text", TEXTS)
def test_pieces_equal_the_library(text):
    assert ids(tokens.Encoder().pieces(text)) == whole(text)


@pytest.mark.parametrize("chunk, overlap", [(16, 2), (64, 4), (100, 30)])
def test_resynchronised_chunks_equal_the_library(chunk, overlap):
    rng = np.random.default_rng(3)
    words = ["a", "the", "don't", "x" * 150, "<|endoftext|>", "中文" * 60, "1234567", "é", "...,,,", "\n\n", "naive"]
    for _ in range(20):
        text = " ".join(rng.choice(words, 80))
        assert ids(tokens.encode_huge(text, LIB, chunk, overlap)) == whole(text)
    for text in TEXTS:  # no boundary at all: widened to the end
        assert ids(tokens.encode_huge(text * 5, LIB, chunk, overlap)) == whole(text * 5)


def test_counts(spark):
    rows = awkward() + list(enumerate(TEXTS, 100))
    r = tokens.token_counts(documents(spark, rows)).toPandas()
    assert sorted(zip(r.n_tokens, r.n_bytes)) == sorted((len(whole(t)), len((t or "").encode())) for _, t in rows)
    assert (r.over_limit == (r.n_tokens > 2048)).all()
    assert tokens.token_counts(documents(spark, [])).count() == 0


def optimum(lengths, capacity):
    """The fewest bins, by search."""
    best = len(lengths)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for i in {r: i for i, r in enumerate(rooms)}.values():
            if rooms[i] >= lengths[k]:
                place(k + 1, rooms[:i] + [rooms[i] - lengths[k]] + rooms[i + 1:])
        place(k + 1, rooms + [capacity - lengths[k]])

    place(0, [])
    return best


def test_bin_completion_is_optimal_on_small_cases():
    rng = np.random.default_rng(4)
    for _ in range(60):
        cap = int(rng.integers(8, 30))
        lengths = sorted((int(x) for x in rng.integers(1, cap + 1, rng.integers(1, 9))), reverse=True)
        packed = packing.bin_completion(dict(Counter(lengths)), cap)
        placed = Counter()
        for pattern, n in packed:
            assert sum(x * c for x, c in pattern) <= cap
            for x, c in pattern:
                placed[x] += c * n
        assert placed == Counter(lengths)
        assert sum(n for _, n in packed) == optimum(lengths, cap)
    # best-fit decreasing needs one more here than bin completion
    case = {6: 1, 5: 2, 4: 1, 3: 2, 2: 2}
    assert sum(n for _, n in packing.bin_completion(case, 10)) == optimum([6, 5, 5, 4, 3, 3, 2, 2], 10)


def test_fillings_are_undominated():
    counts = {7: 1, 5: 1, 4: 2, 3: 1, 2: 1}
    found = packing.fillings(sorted(counts), counts, 9, 100)
    every = {f for n in range(6) for f in combinations_with_replacement(sorted(counts, reverse=True), n)
             if sum(f) <= 9 and all(c <= counts[x] for x, c in Counter(f).items())}
    assert max(map(sum, every)) == sum(found[0]) and set(found) <= every


def check_packed(r, texts, capacity):
    """texts: the tokens of each document row, by id."""
    seen = Counter()
    for x in r.itertuples():
        own = texts[x.doc_id]
        assert 0 < x.length <= capacity and x.start == x.piece * capacity
        part = own[x.start:x.start + x.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == x.ids_crc32 and len(part) == x.length
        seen[x.doc_id] += x.length
    s = r.sort_values(["sequence_id", "offset"])
    assert (s.groupby("sequence_id").length.cumsum() - s.length == s.offset).all()
    assert s.groupby("sequence_id").length.sum().max() <= capacity
    return seen


def test_packing_of_documents(spark):
    docs = table(spark, "documents")
    r = packing.pack(spark, docs).toPandas()
    texts = {x.doc_id: whole(x.text) + [1] for x in docs.collect()}
    assert check_packed(r, texts, 4096) == {k: len(v) for k, v in texts.items()}
    assert r.sequence_id.nunique() == -(-sum(map(len, texts.values())) // 4096)


def test_packing_awkward_rows(spark):
    rows = awkward()
    r = packing.pack(spark, documents(spark, rows), capacity=64).toPandas()
    r["doc_id"] = r.doc_id.fillna(-1).astype(int)
    texts = {-1 if i is None else i: whole(t) + [1] for i, t in rows}
    seen = check_packed(r, texts, 64)
    times = Counter(-1 if i is None else i for i, _ in rows)
    assert seen == {k: len(v) * times[k] for k, v in texts.items()}
    assert packing.pack(spark, documents(spark, [])).count() == 0


def test_many_equal_lengths(spark):
    r = packing.pack(spark, documents(spark, [(k, "same text") for k in range(1500)]), capacity=10).toPandas()
    assert check_packed(r, {k: whole("same text") + [1] for k in range(1500)}, 10)[7] == 3
    assert r.sequence_id.nunique() == 500
