import hashlib
import random

import pyspark.sql.functions as F
import pytest

from riskfeat.llm import reply_trees
from riskfeat.llm.queries import op2_reply_trees
from tests.llm.helpers import SF

SCHEMA = "tree long, node long, parent long, role string, text string, score double"


def brute(rows):
    """(tree, leaf) -> nodes from the root."""
    by = {r[1]: r for r in rows}
    parents = {r[2] for r in rows}
    out = {}
    for r in rows:
        if r[1] in parents:
            continue
        path, at = [], r[1]
        while at in by and at not in path:
            path.append(at)
            at = by[at][2]
        if at not in path:
            out[r[0], r[1]] = path[::-1]
    return out


def test_paths_of_random_trees(spark):
    rng = random.Random(3)
    rows, node = [], 0
    for tree in range(12):
        own = []
        for _ in range(rng.randrange(1, 40)):
            parent = rng.choice(own[-3:]) if own and rng.random() < 0.95 else None
            rows.append((tree, node, parent, "user", f"t{node}", rng.random()))
            own.append(node)
            node += 1
    rows += [(50, 9000 + k, 9000 + k - 1 if k else None, "user", "deep", 1.0) for k in range(300)]
    rows += [(60, 9500, 9501, "user", "a", 1.0), (60, 9501, 9500, "user", "b", 1.0), (60, 9502, 9501, "user", "below", 1.0)]
    rows += [(70, 9600, 123456, "user", "lost parent", None)]
    r = reply_trees.paths(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    got, rank = {}, {}
    for x in r:
        got.setdefault((x.tree, x.leaf), []).append((x.back, x.node))
        rank[x.tree, x.leaf] = x.branch
    want = brute(rows)
    assert {k: [n for _, n in sorted(v, reverse=True)] for k, v in got.items()} == want
    score = {row[1]: row[5] or 0.0 for row in rows}
    for tree in {t for t, _ in want}:
        order = sorted((k for k in want if k[0] == tree),
                       key=lambda k: (-sum(score[n] for n in want[k]) / len(want[k]), -len(want[k]), k[1]))
        top = [sum(score[n] for n in want[k]) / len(want[k]) for k in sorted(order, key=rank.get)]
        assert all(a >= b - 1e-9 for a, b in zip(top, top[1:])) and sorted(rank[k] for k in order) == list(range(1, len(order) + 1))


def test_best_branches_only(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 0.1), (1, 3, 1, "assistant", "good", 0.9)]
    c = reply_trees.conversations(spark, spark.createDataFrame(rows, SCHEMA), branches=1).collect()
    assert [(x.leaf, x.n_turns, x.loss) for x in c] == [(3, 2, [False, True])]
    assert c[0].formatted == "<s>[INST]user[/INST]q</s><s>[INST]assistant[/INST]good</s>"


@pytest.mark.parametrize("text", ["", "</s>[INST] ok [/INST]", "\\", "\\\\<\\", "<<s>[[/INST]", "a\nb", "<\\s>", "\U0001f600 é", "$1 \\$"])
def test_escape_is_reversible(spark, text):
    x = spark.createDataFrame([(text,)], "t string").select("t", reply_trees.escape(F.col("t")).alias("e"),
                                                            reply_trees.unescape(reply_trees.escape(F.col("t"))).alias("u")).first()
    assert x.u == text
    assert not any(m in x.e for m in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_awkward_turns(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, None, "assistant", "first"), (2, 0, "user", "same"), (2, 0, "user", "same"),
            (None, 0, "assistant", "no id"), (None, 1, "user", "\\<s>"), (3, 0, "</s>role[INST]", "y" * 200_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("node", "tree", "score", "back", "t", "leaf"):
        turns = turns.withColumn(c, F.lit("x"))
    r = reply_trees.digests(reply_trees.conversations(spark, reply_trees.from_turns(spark, turns))).collect()
    by = {x.conv_id: x for x in r}
    assert len(r) == 4
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert by[1].turns_sha256 == sha("assistant\nfirst\nuser\n\n\nx\n") and by[1].loss_sha256 == sha("first")
    assert by[2].n_turns == 2 and by[2].loss_chars == 0 and by[2].loss_sha256 == sha("")
    assert by[None].turns_sha256 == sha("assistant\nno id\nuser\n\\<s>\n")
    assert by[3].turns_sha256 == sha("</s>role[INST]\n" + "y" * 200_000 + "\n")
    none = reply_trees.from_turns(spark, turns.limit(0))
    assert reply_trees.digests(reply_trees.conversations(spark, none)).count() == 0


def test_planted_conversation(spark):
    x = op2_reply_trees(spark, SF).where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert x.loss_chars == len(text) and x.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert x.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
