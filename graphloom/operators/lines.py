"""Lines of a graph: stretches in which each node has one way in and one way out, and what can be reached along them.

A line is named by its first node, and each node has a place in it. Ways that branch or join lead from the end of a line to the begin of
another. Lines that lie on circles together are a knot; any other line is a knot of its own. What a node reaches is its own knot if that is
a circle, else the rest of its line, and, as a whole, every knot that its own leads to. Places are found by pointer jumping: each
round doubles how far back a node looks, on as many rows as are still looking. Pairs are formed between knots only; between nodes they
are formed on demand, for the seeds that are asked for. Circles of n nodes, however they are knit, are n rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators.cycles import strong_components
from graphloom.operators.frontier import closure, written


class Lines(NamedTuple):
    members: DataFrame  # node, line, place, knot, loop: the nodes of a knot that is a loop all reach each other
    leads: DataFrame  # source, target: pairs of knots, by one way or more; a knot is no pair with itself


def lines_of(edges: DataFrame) -> Lines:
    """Lines of the graph of edges (source, target), which may repeat, branch, join and run in circles; ids of any kind that can be ordered."""
    e = written(edges.select("source", "target").where("source IS NOT NULL AND target IS NOT NULL").distinct())
    single = lambda end: e.groupBy(end).agg(F.count("*").alias("n")).where("n = 1").select(end)
    inner = written(e.where("source <> target").join(single("source"), "source", "left_semi").join(single("target"), "target", "left_semi"))
    nodes = e.select(F.explode(F.array("source", "target")).alias("node")).distinct()
    back = inner.select(F.col("target").alias("node"), F.col("source").alias("ptr"))
    start = nodes.join(back, "node", "left").select("node", F.coalesce("ptr", "node").alias("ptr"), F.when(F.col("ptr").isNull(), 0).otherwise(1).cast("long").alias("dist"), F.least("node", F.coalesce("ptr", "node")).alias("low"), F.col("ptr").isNull().alias("done"))
    table = written(start)
    known, looking = [table.where("done")], table.where("NOT done")
    there = table
    while True:
        ahead = there.select(F.col("node").alias("ptr"), F.col("ptr").alias("__p"), F.col("dist").alias("__d"), F.col("low").alias("__l"), F.col("done").alias("__done"))
        step = looking.join(ahead, "ptr").select("node", F.col("__p").alias("ptr"), (F.col("dist") + F.col("__d")).alias("dist"), F.least("low", "__l").alias("low"), F.col("__done").alias("done"), (F.col("__l") < F.col("low")).alias("lower"))
        step = written(step)
        moved = step.agg(F.count("*").alias("n"), F.count_if("done").alias("done"), F.count_if("lower").alias("lower")).first()
        if not moved.n or not moved.done + moved.lower:
            rings = step.drop("lower")
            break
        step = step.drop("lower")
        known.append(step.where("done"))
        looking = step.where("NOT done")
        there = written(_all(known).unionByName(looking)) if len(known) % 8 == 0 else _all(known).unionByName(looking)
    on_rings = rings.select("node", F.col("low").alias("line"), F.lit(0).cast("long").alias("place"), F.lit(True).alias("loop"))
    members = written(_all(known).select("node", F.col("ptr").alias("line"), F.col("dist").alias("place"), F.lit(False).alias("loop")).unionByName(on_rings))
    of = lambda end: members.select(F.col("node").alias(end), F.col("line").alias(f"__{end}"))
    ways = e.join(inner, ["source", "target"], "left_anti").join(of("source"), "source").join(of("target"), "target")
    ways = written(ways.select(F.col("__source").alias("source"), F.col("__target").alias("target")).distinct())
    knots = strong_components(ways).withColumnsRenamed({"node": "line", "component": "__knot"})
    again = ways.where("source = target").select(F.col("source").alias("line"), F.lit(True).alias("__again"))
    members = members.join(knots, "line", "left").join(again, "line", "left")
    members = members.select("node", "line", "place", F.coalesce("__knot", "line").alias("knot"), (F.col("loop") | F.coalesce("__again", F.lit(False)) | F.col("__knot").isNotNull()).alias("loop"))
    of = lambda end: knots.select(F.col("line").alias(end), F.col("__knot").alias(f"__{end}"))
    between = ways.join(of("source"), "source", "left").join(of("target"), "target", "left").select(F.coalesce("__source", "source").alias("source"), F.coalesce("__target", "target").alias("target"))
    return Lines(written(members), closure(between.where("source <> target")))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reached(lines: Lines, seeds: DataFrame) -> DataFrame:
    """(seed, node), each once: what a path of one edge or more leads to from each seed (seed); the seed itself where it lies on a circle."""
    at = seeds.select("seed").distinct().join(lines.members.withColumnRenamed("node", "seed"), "seed").withColumnsRenamed({"place": "from"})
    own = at.join(lines.members.select("node", "knot", "place"), "knot").where("loop OR place > `from`").select("seed", "node")
    beyond = at.select("seed", F.col("knot").alias("source")).join(lines.leads, "source").select("seed", F.col("target").alias("knot")).join(lines.members.select("node", "knot"), "knot").select("seed", "node")
    return own.unionByName(beyond)


def closure_of(edges: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """Q-05: (source, target) as `closure` gives them, for all nodes or some (seed); circles are put together first, so that they cost rows in their length until the pairs are asked for."""
    if seeds is None:
        seeds = edges.where("target IS NOT NULL").select(F.col("source").alias("seed"))
    return reached(lines_of(edges), seeds).withColumnsRenamed({"seed": "source", "node": "target"})
