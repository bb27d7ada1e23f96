import random

import numpy as np
import pytest

from riskfeat.llm import near_dedup
from riskfeat.llm.linking import components
from tests.llm.helpers import awkward, documents, table


def sets_of(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute(rows, size, percent=80):
    """Component (smallest index) of each row by all pairs."""
    sets, at = [sets_of(t, size) for _, t in rows], list(range(len(rows)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                at[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(rows))], [len(s) for s in sets]


@pytest.mark.parametrize("size", [2, 5])
def test_equals_all_pairs(spark, size):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").orderBy("doc_id").collect()]
    group, n = brute(rows, size)
    r = near_dedup.near_duplicates(spark, documents(spark, rows), size).toPandas().set_index("doc_id")
    assert [r.component_id[i] for i, _ in rows] == [rows[g][0] for g in group]
    assert [r.n_shingles[i] for i, _ in rows] == n
    assert (r.kept == (r.index == r.component_id)).all() and (r["first"] == r.kept).all()


def test_chains_and_a_large_group(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    base = [word() for _ in range(120)]
    rows = []
    for k in range(150):  # near copies of one text, not all linked with each other
        w = list(base)
        for p in rng.sample(range(120), 3):
            w[p] = word()
        rows.append((1000 - k, " ".join(w)))
    w = [word() for _ in range(100)]
    for k in range(12):  # a chain: only neighbours are linked
        w = list(w)
        for p in range(4):
            w[8 * k + p] = word()
        rows.append((2000 + k, " ".join(w)))
    rows += [(3000 + k, rows[0][1]) for k in range(40)]
    group, _ = brute(rows, 2)
    low = {}
    for g, (i, _) in zip(group, rows):
        low[g] = min(low.get(g, i), i)
    r = near_dedup.near_duplicates(spark, documents(spark, rows), 2).toPandas().set_index("doc_id")
    assert [r.component_id[i] for i, _ in rows] == [low[g] for g in group]


def test_awkward_rows(spark):
    r = near_dedup.near_duplicates(spark, documents(spark, awkward()), 2).toPandas()
    assert len(r) == len(awkward())
    by = {(-1 if np.isnan(x.doc_id) else int(x.doc_id)): x for x in r.itertuples()}
    assert by[2].n_shingles == by[3].n_shingles == by[4].n_shingles == 0
    assert by[2].component_id == 2 and by[3].component_id == 3 and by[6].n_shingles == 1 and by[5].n_shingles == 1
    assert r[r.doc_id == 1].kept.all() and r[r.doc_id == 1]["first"].sum() == 1
    assert by[-1].kept
    kept = near_dedup.clean(spark, documents(spark, awkward()))
    assert kept.count() == len(awkward()) - 1 and "score" in kept.columns
    assert near_dedup.near_duplicates(spark, documents(spark, [])).count() == 0


def test_null_id_is_not_the_kept_one(spark):
    r = near_dedup.near_duplicates(spark, documents(spark, [(None, "a b c d"), (9, "a b c d")]), 2).toPandas()
    assert (r.component_id == 9).all() and r.kept.sum() == 1


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, k) for k in range(501, 800)]
    r = components(spark, spark.createDataFrame(edges, "a long, b long")).toPandas()
    assert r.node.is_unique and len(r) == 201 + 300
    assert (r.component == np.where(r.node <= 200, 0, 500)).all()
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_minimum_and_maximum_match_with_the_similarity():
    rng = np.random.default_rng(8)
    a = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    b = np.r_[a[:360], rng.integers(0, 1 << 62, 40).astype(np.uint64)]
    sig = near_dedup.signatures(np.r_[np.sort(a), np.sort(b)], np.array([0, 400, 800]))
    assert abs((sig[0] == sig[1]).mean() - 360 / 440) < 0.12


def test_intersections_equal_python_sets():
    rng = np.random.default_rng(12)
    sets = [np.unique(rng.integers(0, 60 if k % 2 else 4000, rng.integers(0, 80))).astype(np.uint64) for k in range(70)]
    cut = np.r_[0, np.cumsum([len(s) for s in sets])]
    got = near_dedup.intersections(np.concatenate(sets), cut)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert i == j or got[i, j] == len(set(a.tolist()) & set(b.tolist()))
    assert near_dedup.intersections(np.zeros(0, np.uint64), np.zeros(3, int)).tolist() == [[0, 0], [0, 0]]


def test_families_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(15)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    base = [word() for _ in range(60)]
    rows = []
    for k in range(120):  # about half of the pairs are linked
        w = list(base)
        for p in rng.sample(range(60), rng.randrange(1, 5)):
            w[p] = word()
        rows.append((k, " ".join(w)))
    group, _ = brute(rows, 2)
    r = near_dedup.near_duplicates(spark, documents(spark, rows), 2).toPandas().set_index("doc_id")
    assert [r.component_id[i] for i, _ in rows] == [rows[g][0] for g in group]
