"""From band buckets to components, with no bucket ever held or paired as a whole.

``link`` compares each member of a bucket with one pivot, joins what is linked,
and goes on with a new pivot for the members of other components only. Buckets
that still hold several components then go to the operator's ``finish``, which
compares across components and returns links only, not the pairs it has compared. A
bucket of n copies costs n comparisons. Components are found by alternating
large-star and small-star steps, so long chains take a logarithmic number of them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.llm.common import save

#: Edges from which on a step's tables are written one by one.
LARGE = 1_000_000


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of each node of ``edges`` (a, b: long), as a saved table.

    Both steps are aggregations and joins on a node. From ``LARGE`` edges on the
    joined sides are written first, so that both are plain exchanges and Spark splits a node
    of very many edges.
    """
    e = save(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .distinct(), "edges")
    while True:
        # done if each node points to one that points nowhere
        n, nodes = e.agg(F.count(F.lit(1)), F.count_distinct("u")).first()
        if n == nodes and e.join(e.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        hold = (lambda df, name: save(spark, df, name)) if n > LARGE else (lambda df, name: df)
        # large star: larger neighbours go to the smallest neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = hold(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        big = hold(both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .distinct(), "star")
        # small star: a node and its smaller neighbours go to the smallest
        low = hold(big.groupBy("u").agg(F.min("v").alias("m")), "low")
        e = save(spark, big.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "star")


def link(spark: SparkSession, entries: DataFrame | list[DataFrame], prepare: Callable[[DataFrame], tuple[Callable, Callable]],
         rounds: int = 1, narrow: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> DataFrame:
    """node, component of every node with a link.

    ``entries``: key, node (long), or several such tables without common keys, whose buckets are found one table
    after another so that fewer entries are shuffled at a time. ``prepare`` gets the nodes that share any
    bucket (node, distinct) and returns two functions: ``verify`` tells of pairs
    (a, b: long) those linked; ``finish`` gets the members (key, node,
    component) of buckets of several components and returns links (a, b) that join all
    components with linked members. So every pair of nodes that share a key ends up
    compared or in one component. ``narrow`` may thin ``entries`` before they are joined with keys (key, pivot); it
    must keep all entries of those keys.
    """
    slices = entries if isinstance(entries, list) else [entries]
    entries = reduce(DataFrame.unionByName, slices)
    multi = reduce(DataFrame.unionByName, [
        save(spark, part.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("other"),
                                            F.count(F.lit(1)).alias("n")).where("pivot < other"), "buckets")
        for part in slices])
    # the members of buckets of more than two; a bucket of two is a pair
    larger = multi.where("n > 2").select("key", "pivot")
    members = save(spark, (narrow(entries, larger) if narrow else entries).join(larger, "key"), "members")
    pairs = save(spark, members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
                 .unionByName(multi.where("n = 2").select(F.col("pivot").alias("a"), F.col("other").alias("b")))
                 .distinct(), "pairs")
    verify, finish = prepare(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
    links = save(spark, verify(pairs), "links")
    group = components(spark, links)
    rest = members.select("key", "node")
    for k in range(rounds + 1):
        named = save(spark, rest.join(group, "node", "left").select(
            "key", "node", F.coalesce("component", "node").alias("component")), "named")
        turn = F.xxhash64("node", F.lit(k))
        open_ = save(spark, named.groupBy("key").agg(
            F.min("component").alias("lo"), F.max("component").alias("hi"), F.min_by("node", turn).alias("pivot"),
            F.min_by("component", turn).alias("of")).where("lo < hi").select("key", "pivot", "of"), "open")
        if open_.isEmpty():
            break
        rest = save(spark, named.join(open_, "key"), "members")
        if k < rounds:
            found = save(spark, rest.where("component <> of").select(
                F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b")).distinct(), "pairs")
            links = save(spark, verify(found), "links")
        else:
            links = save(spark, finish(rest.select("key", "node", "component")), "links")
        rest = rest.select("key", "node")
        if not links.isEmpty():
            # the components found so far stand for the links before
            group = components(spark, links.unionByName(group.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    return group
