"""Strongly connected components: which nodes of a graph lie on circles together.

Forward labels, backward labels and trimming. Nodes without a way in or out lie on no circle and go first, again and again. Then each
node takes the least id that reaches it and the least that it reaches; where both are the same, the node lies on a circle with it. Such
nodes go, ways between nodes that differ in a label go (no circle runs over them), and the rest starts anew. Each round is a join with
the ways that are left, for labels that changed. The number of rounds grows with the longest shortest way, not with the number of nodes;
long rings and chains are put together before (`lines_of`).

Before labels are sent, nodes with a single way out are folded into the node that it leads to, again and again: who lies on a circle with
such a node lies on one with that node too. The same the other way round. Trees with ways home fold into their roots, a layer a round, on
ever fewer rows. In the end the folds are opened, the last first: a node shares the circles of the node it was folded into if a way
leads to it from one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators.frontier import at_hand, written

LEAST_FOLDED = 0.1
"""Share of the ways that a round of folding takes away, for another to follow in the same direction."""


def strong_components(edges: DataFrame) -> DataFrame:
    """(node, component): nodes on circles of two nodes or more, each once, with the least id of those that they share circles with.

    edges (source, target) may repeat; null ends and loops from a node to itself are passed over. A node on no circle has no row.
    """
    e = written(edges.select("source", "target").where("source <> target").distinct())
    found = e.select(F.col("source").alias("node"), F.col("source").alias("component")).limit(0)
    folds: list[DataFrame] = []
    while True:
        e = _trimmed(_folded(e, folds))
        if e.isEmpty():
            return _opened(found, folds)
        label = _labels(e)
        open_ = label.where("fore <> back")
        done = label.where("fore = back").select("node", F.col("fore").alias("component"))
        found = written(found.unionByName(done.join(done.where("node <> component").select("component").distinct(), "component", "left_semi").select("node", "component")))
        of = lambda end: open_.select(F.col("node").alias(end), F.struct("fore", "back").alias(f"__{end}"))  # noqa: E731, B023
        e = e.join(of("source"), "source").join(of("target"), "target").where("__source = __target").select("source", "target")


def _folded(e: DataFrame, folds: list[DataFrame]) -> DataFrame:
    """Ways that are left when nodes with one way out, then with one way in, are folded while that takes away enough of them; folds gets (node, source, on) of each round: the ways into what was folded, and into what.

    A node is folded into one that is not folded in the same round; ways to nodes without a way out are passed over. Rounds take ways away and never add any.
    """
    e = written(e)
    n, idle, names = e.count(), 0, ("source", "target")
    while n and idle < 2:
        e = e.select(*[F.col(c).alias(to) for c, to in zip(names, ("source", "target"))])
        outs = e.groupBy("source").agg(F.when(F.count("*") == 1, F.min("target")).alias("on"))
        single = outs.where("on IS NOT NULL").select(F.col("source").alias("on"), F.lit(True).alias("__single"))
        ends = outs.select("source", F.coalesce("on", "source").alias("on")).join(single, "on", "left")  # several ways out: the node itself, so that nulls are not one key
        ends = written(ends.select("source", F.when(F.col("__single").isNull() & (F.col("on") != F.col("source")), F.col("on")).alias("on")))
        ways = e.join(ends.where("on IS NULL").select("source"), "source").join(ends.select(F.col("source").alias("target"), "on"), "target")
        ways = written(ways.select("source", "target", "on"))
        folds.append(ways.where("on IS NOT NULL").select(F.col("target").alias("node"), "source", "on"))
        left = ways.select("source", F.coalesce("on", "target").alias("target")).where("source <> target").distinct()
        e = written(left.select(*[F.col(c).alias(to) for c, to in zip(("source", "target"), names)]))
        before, n = n, e.count()
        idle = 0 if n <= (1 - LEAST_FOLDED) * before else idle + 1
        names = names[::-1] if idle else names
    return e


def _opened(found: DataFrame, folds: list[DataFrame]) -> DataFrame:
    """found (node, component) with the nodes that were folded, each component by its least id."""
    for ways in reversed(folds):
        if ways.isEmpty():
            continue
        of = lambda end: found.select(F.col("node").alias(end), F.col("component").alias(f"__{end}"))  # noqa: E731, B023
        ends = ways.join(of("on"), "on", "left").join(of("source"), "source", "left").select("node", F.coalesce("__on", "on").alias("component"), F.coalesce("__source", "source").alias("__from"))
        found = written(found.unionByName(ends.where("component = __from").select("node", "component").distinct()))
    whole = found.where("node <> component").unionByName(found.select(F.col("component").alias("node"), "component").distinct())
    least = whole.groupBy("component").agg(F.min("node").alias("__least")).where("__least <> component")
    return whole.join(at_hand(least), "component", "left").select("node", F.coalesce("__least", "component").alias("component"))


def _trimmed(e: DataFrame) -> DataFrame:
    """Ways from nodes with a way in to nodes with a way out, until all are."""
    e = written(e)
    n = e.count()
    while n:
        e = written(e.join(e.select(F.col("target").alias("source")).distinct(), "source", "left_semi").join(e.select(F.col("source").alias("target")).distinct(), "target", "left_semi"))
        before, n = n, e.count()
        if n == before:
            break
    return e


def _labels(e: DataFrame) -> DataFrame:
    """(node, fore, back): the least id of all that reach a node and of all that it reaches, its own included."""
    nodes = e.select(F.col("source").alias("node")).union(e.select("target")).distinct()
    state = written(nodes.select("node", F.col("node").alias("fore"), F.col("node").alias("back"), F.lit(True).alias("f"), F.lit(True).alias("b")))
    while True:
        fore = state.where("f").select(F.col("node").alias("source"), "fore").join(e, "source").groupBy(F.col("target").alias("node")).agg(F.min("fore").alias("fore2"))
        back = state.where("b").select(F.col("node").alias("target"), "back").join(e, "target").groupBy(F.col("source").alias("node")).agg(F.min("back").alias("back2"))
        less = lambda new, old: F.coalesce(F.col(new) < F.col(old), F.lit(False))
        step = state.select("node", "fore", "back").join(fore, "node", "left").join(back, "node", "left")
        state = written(step.select("node", F.least("fore", "fore2").alias("fore"), F.least("back", "back2").alias("back"), less("fore2", "fore").alias("f"), less("back2", "back").alias("b")))
        if state.where("f OR b").isEmpty():
            return state.select("node", "fore", "back")
