import random
import zlib

import pyspark.sql.functions as F
import pytest

from riskfeat.llm import language
from tests.llm.helpers import SF, awkward, documents, table


def low(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())


def phrases(text, learnt):
    """Greedy cross-parsing by substring search, anew with each piece."""
    n = 0
    for p in range(0, len(text), language.PIECE):
        piece, i = text[p:p + language.PIECE], 0
        while i < len(piece):
            j = i + 1
            while j < len(piece) and piece[i:j + 1] in learnt:
                j += 1
            i, n = j, n + 1
    return n


def parser(texts):
    return language.Parser.build([(k, len(t), *language.automaton(t)) for k, t in sorted(texts.items())])


def test_phrases_equal_substring_search():
    rng = random.Random(3)
    for _ in range(20):
        learnt = {k: bytes(rng.choices(b"abcd ", k=rng.randrange(1, 300))) for k in ("p", "q", "r")}
        texts = [bytes(rng.choices(b"abcde ", k=rng.choice([0, 1, 30, 1023, 1024, 1025, 5000]))) for _ in range(9)]
        import numpy as np
        off = np.r_[0, np.cumsum([len(t) for t in texts])]
        got = parser(learnt).phrases(np.frombuffer(b"".join(texts), np.uint8), off)
        assert got.tolist() == [[phrases(t, learnt[k]) for k in sorted(learnt)] for t in texts]


def test_automaton_holds_every_substring_and_no_other():
    text = b"abcbcabccab"
    s, b, t = language.automaton(text)
    go = {(x, y): z for x, y, z in zip(s.tolist(), b.tolist(), t.tolist())}

    def read(w):
        at = 0
        for c in w:
            at = go.get((at, c))
            if at is None:
                return False
        return True
    subs = {text[i:j] for i in range(len(text)) for j in range(i, len(text) + 1)}
    assert all(read(x) for x in subs)
    words = {bytes(x) for n in range(1, 5) for x in __import__("itertools").product(b"abc", repeat=n)}
    assert {x for x in words if read(x)} == {x for x in words if x in subs}


def test_predictions_equal_brute_force(spark):
    docs = table(spark, "documents")
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0
    learnt = {}
    for r in language.sample(docs, learn).orderBy("lang", "h").collect():
        learnt.setdefault(r.lang, []).append(low(r.slice))
    learnt = {k: b"\xff".join(v) for k, v in learnt.items()}
    import math
    got = {r.doc_id: r for r in language.identify(spark, docs).collect()}
    for r in docs.where("doc_id < 40").collect():
        cost = {k: phrases(low(r.text or ""), v) * math.log2(2 + len(v)) for k, v in learnt.items()}
        has = any(c.isalpha() for c in r.text or "")
        assert got[r.doc_id].lang_pred == (min(sorted(cost), key=cost.get) if has else "und")
        two = sorted(cost.values())[:2]
        assert got[r.doc_id].score == pytest.approx(two[1] / sum(two) if has else 0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    rows = language.identify(spark, docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    sure = [r for r in rows if r.lang_pred != "und"]
    assert sum(r.lang_pred == r.lang for r in sure) >= 0.97 * len(sure) and len(sure) > 0.9 * len(rows)


def test_sample_is_bounded_and_distinct(spark):
    docs = documents(spark, [(k, f"text number {k % 50} " * 200) for k in range(400)])
    s = language.sample(docs, F.lit(True), slices=7, slice_chars=33).collect()
    assert len(s) == 7 and all(len(r.slice) == 33 for r in s) and len({r.h for r in s}) == 7


def test_awkward_rows(spark):
    docs = documents(spark, awkward())
    r = language.identify(spark, docs).collect()
    assert len(r) == len(awkward())
    by = {x.doc_id: x for x in r}
    assert {k: by[k].lang_pred for k in (1, 2, 3, 4, None)} == {1: "en", 2: "und", 3: "und", 4: "und", None: "en"}
    assert by[2].score == 0 and by[1].score == 1 and not by[None].held_out
    empty = language.identify(spark, documents(spark, []))
    assert empty.columns == ["doc_id", "held_out", "lang_pred", "score"] and empty.count() == 0
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {x.lang_pred for x in language.identify(spark, none).collect()} == {"und"}


def test_ties_go_to_the_smaller_name(spark):
    docs = documents(spark, [(1, "same text here"), (2, "same text here")]).withColumn(
        "lang", F.when(F.col("doc_id") == 1, "zz").otherwise("aa"))
    model = language.train(spark, docs, F.lit(True))
    assert [r.lang_pred for r in language.predict(spark, docs, model).collect()] == ["aa", "aa"]
    assert {r.score for r in language.predict(spark, docs, model).collect()} == {0.5}
