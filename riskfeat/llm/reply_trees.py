"""Chat formatting of reply trees.

Messages name their parent; a conversation is the path from a root to a leaf.
Iterative self-joins with doubled steps give every message its root, depth and
the score of its path, and then every chosen leaf its path: the number of joins grows with the
logarithm of the depth. Branches of a tree are ranked by the mean score of their
messages (then the longer, then the smaller leaf), and each chosen path is
formatted as one conversation.

The template marks a turn as ``<s>[INST]role[/INST]text</s>``. Inside roles and
texts a backslash is put after every ``<``, ``[`` and backslash, so no mark can
occur there, and taking them out again gives the exact text. The loss mask has one flag
for each turn: it covers the texts of the assistant.

Everything is DataFrame and SQL functions. Defined cases: null role or text is
empty; a parent that is null or not a message makes a root; messages on or
below a cycle of parents have no root and belong to no path; a null score
counts as 0; an empty table gives no rows; other columns are ignored. In
``from_turns`` rows of equal turn are ordered by role and text, null turns come first,
and all rows with a null conv_id are one conversation. One conversation is one
row of the result, so its turns meet in one task; only there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskfeat.llm.common import save

# The template's marks.
BEGIN, MIDDLE, END = "<s>[INST]", "[/INST]", "</s>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


def from_turns(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """Messages (tree, node, parent, role, text, score) of plain conversations: each turn replies to the one before."""
    rows = save(spark, turns.select(F.col("conv_id").alias("tree"), "turn", "role", "text")
                .withColumn("node", F.monotonically_increasing_id()), "turns")
    before = F.lag("node").over(W.partitionBy("tree").orderBy("turn", "role", "text", "node"))
    return rows.select("tree", "node", before.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def paths(spark: SparkSession, messages: DataFrame, branches: int | None = None) -> DataFrame:
    """tree, leaf, branch (rank in its tree, from 1), node, back (steps up from the leaf): the messages of each path.

    ``branches``: keep so many best paths of a tree (all, if None).
    """
    m = save(spark, messages.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0))
                                    .alias("score")), "messages")
    known = m.select(F.col("node").alias("parent"), F.lit(True).alias("there"))
    at = save(spark, m.join(known, "parent", "left").select(
        "tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), "score", F.lit(1).cast("long").alias("depth")),
        "steps")
    # after i joins: `up` is 2^i messages above, score and depth are sums over the 2^i messages from node on
    steps, open_ = [], None
    while True:
        steps.append(at.select("node", "up").where("up is not null"))
        still = steps[-1].count()
        if still == 0 or still == open_:
            break  # what stays open runs in a cycle
        open_ = still
        above = at.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("score").alias("score2"),
                          F.col("depth").alias("depth2"))
        on = at.where("up is not null").join(above, "up").select(  # what has reached its root is not joined again
            "tree", "node", F.col("up2").alias("up"), (F.col("score") + F.col("score2")).alias("score"),
            (F.col("depth") + F.col("depth2")).alias("depth"))
        at = save(spark, at.where("up is null").unionByName(on), "steps")
    parents = m.where("parent is not null").select(F.col("parent").alias("node")).distinct()
    leaves = at.where("up is null").join(parents, "node", "left_anti")
    rank = F.row_number().over(W.partitionBy("tree").orderBy(
        F.desc(F.col("score") / F.col("depth")), F.desc("depth"), "node"))
    leaves = leaves.withColumn("branch", rank)
    if branches is not None:
        leaves = leaves.where(F.col("branch") <= branches)
    out = leaves.select("tree", F.col("node").alias("leaf"), "branch", "node", F.lit(0).cast("long").alias("back"))
    for i, step in enumerate(steps[:-1] if open_ is not None else []):
        out = save(spark, out, "paths")
        out = out.unionByName(out.join(step, "node").select(
            "tree", "leaf", "branch", F.col("up").alias("node"), (F.col("back") + F.lit(1 << i)).alias("back")))
    return out


def conversations(spark: SparkSession, messages: DataFrame, branches: int | None = None) -> DataFrame:
    """tree, leaf, branch, n_turns, formatted, loss (a flag for each turn) of each chosen path."""
    texts = messages.select("node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turn = F.concat(F.lit(BEGIN), escape(F.col("role")), F.lit(MIDDLE), escape(F.col("text")), F.lit(END))
    rows = paths(spark, messages, branches).join(texts, "node").select(
        "tree", "leaf", "branch", F.struct((-F.col("back")).alias("at"), turn.alias("turn"),
                                           (F.col("role") == LOSS_ROLE).alias("loss")).alias("t"))
    return rows.groupBy("tree", "leaf", "branch").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "tree", "leaf", "branch", F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.col("t.turn"), "").alias("formatted"), F.col("t.loss").alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns``: the roles and texts parsed from the formatted string, unescaped."""
    parts = F.expr(f"slice(split(formatted, '{END}'), 1, size(split(formatted, '{END}')) - 1)")

    def turn(s: Column) -> Column:
        role = F.substring_index(s.substr(F.lit(len(BEGIN) + 1), F.length(s)), MIDDLE, 1)
        text = s.substr(F.length(role) + F.lit(len(BEGIN) + len(MIDDLE) + 1), F.length(s))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return formatted.withColumn("turns", F.transform(parts, turn))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the formatted text."""
    back = read_back(formatted).select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("all"),
        F.array_join(F.filter(F.transform(F.arrays_zip(F.col("turns.text").alias("text"), F.col("loss")),
                                          lambda t: F.when(t["loss"], t["text"])), lambda x: x.isNotNull()), "").alias("own"),
        F.length("formatted").cast("long").alias("formatted_chars"))
    return back.select("conv_id", "n_turns", F.sha2("all", 256).alias("turns_sha256"),
                       F.length("own").cast("long").alias("loss_chars"), F.sha2("own", 256).alias("loss_sha256"),
                       "formatted_chars")
