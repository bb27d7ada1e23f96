import random
import re
import zlib
from collections import Counter

from riskfeat.llm import spelling
from tests.llm.helpers import awkward, documents, table

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute(rows):
    c = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            c[run] += 1
    c = {w: n for w, n in c.items() if len(w) >= 6 and n >= 5}
    by = {}
    for w in c:
        by.setdefault(len(w), []).append(w)
    out, forms = {}, {}
    for w, n in c.items():
        own = [x for m in (-1, 0, 1) for x in by.get(len(w) + m, ()) if near(w, x)]
        best = min(own, key=lambda x: (-c[x], x)) if own else None
        form = best if own and c[best] >= 5 * n else None
        forms[w] = form
        out[w] = [n, len(own), form, c[form] if form else None]
    for w in out:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def run(spark, docs, **kw):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(spark, docs, **kw).collect()}


def test_equals_brute_force(spark):
    docs = table(spark, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert len(want) > 500 and any(v[2] for v in want.values())
    assert run(spark, docs) == want


def test_chains_ties_and_accents(spark):
    rng = random.Random(1)
    base = ["necessary", "separate", "déjàvuéé", "straßenß", "abcdef"]
    words = []
    for w in base:
        n = 4000
        while n >= 5:
            words += [w] * n
            p = rng.randrange(len(w))
            w = rng.choice([w[:p] + w[p + 1:] if len(w) > 7 else w[:p] + "q" + w[p:], w[:p] + "q" + w[p:], w[:p] + "z" + w[p + 1:]])
            n //= 5
    words += ["aaaaaa", "aaaaab", "aaaaac"] * 5 + ["aaaaad"] * 1 + ["ÀÉÎÕÜÿ", "àéîõüÿ", "àéîõüÿÿ"] * 6
    rng.shuffle(words)
    rows = [(k, " ".join(words[k::40])) for k in range(40)]
    want = brute(rows)
    assert len({v[4] for v in want.values()}) < len(want)
    got = run(spark, documents(spark, rows))
    assert got == want
    assert run(spark, documents(spark, rows), symbols=2) == want  # the alphabet changes the work, not the result


def test_neighbourhood_is_whole(spark):
    def around(w):
        s = "".join(map(str, range(spelling.SYMBOLS)))
        return ({w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in s}
                | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in s} | {w})
    for w in ("012345", "000000", "543210543"):
        got = spark.sql(f"select '{w}' as r").select(spelling.neighbourhood("r").alias("x")).first().x
        assert sorted(got) == sorted(x for x in around(w) if x >= w)


def test_awkward_rows(spark):
    rows = awkward() + [(k, "Letters letterz " * 3 + "x" * 5000) for k in range(5)] + [(None, "letters " * 40)]
    assert run(spark, documents(spark, rows)) == brute(rows)
    empty = spelling.variants(spark, documents(spark, []))
    assert empty.count() == 0 and set(empty.columns) == {"word", "n", "n_near", "form", "form_n", "root"}


def test_no_python_in_the_plans(spark):
    v = spelling.variants(spark, documents(spark, [(1, "letters letterz " * 9)]))
    assert not re.search("Python|Pandas|Arrow", v._jdf.queryExecution().executedPlan().toString())
