"""The questions that a graph is kept for: impact, coverage, citation resolution, dependents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators.frontier import first_hop, follow, reach, written
from graphloom.operators.lines import lines_of, reached


def impact(nodes: DataFrame, edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Q-01: (seed, relation, target), distinct: all that replaces each seed, and what hangs on any of it."""
    back = edges.where("predicate = 'supersedes'").select(F.col("target").alias("source"), F.col("source").alias("target"))
    line = reach(seeds, back).select("seed", "node")
    return _hangs_on(edges, line, "supersededBy")


def impact_of_all(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Q-01 for many seeds at once: nodes are ranked on their replacement lines once, and what replaces a seed is read off its line.

    What hangs on a line is made distinct once for the line, with the last place that it hangs on: a seed has what hangs at its place or
    behind. Pairs have to be made distinct by seed only where lines lead to others.
    """
    back = edges.where("predicate = 'supersedes'").select(F.col("target").alias("source"), F.col("source").alias("target"))
    lines = lines_of(back)
    seeds = seeds.select("seed").distinct()
    line = seeds.select("seed", F.col("seed").alias("node")).unionByName(reached(lines, seeds).where("seed <> node"))
    placed = lambda t, node: t.join(lines.members.select(F.col("node").alias(node), "knot", "place", "loop"), node, "left").withColumns({"knot": F.coalesce("knot", node), "place": F.coalesce("place", F.lit(0)), "loop": F.coalesce("loop", F.lit(False))})
    held = placed(_hung(edges), "node").groupBy("knot", "relation", "target").agg(F.max("place").alias("last"))
    at = placed(seeds, "seed")
    lists = at.join(held, "knot").where("loop OR last >= place").select("seed", "relation", "target")
    if not lines.leads.isEmpty():
        beyond = at.select("seed", F.col("knot").alias("source")).join(lines.leads, "source").select("seed", F.col("target").alias("knot"))
        lists = lists.unionByName(beyond.join(held, "knot").select("seed", "relation", "target")).distinct()
    return _replaced(line, "supersededBy").unionByName(lists)


def _replaced(line: DataFrame, name: str) -> DataFrame:
    return line.select("seed", F.lit("visited").alias("relation"), F.col("node").alias("target")).union(line.where("seed <> node").select("seed", F.lit(name), "node"))


def _hangs_on(edges: DataFrame, line: DataFrame, replaced: str) -> DataFrame:
    """line: (seed, node), each once."""
    return _replaced(line, replaced).union(line.join(_hung(edges), "node").select("seed", "relation", "target").distinct())


def _hung(edges: DataFrame) -> DataFrame:
    """(node, relation, target): what hangs on a node itself."""
    pick = lambda p, a, b: edges.where(F.col("predicate") == p).select(F.col(a).alias("node"), F.col(b).alias("target"))
    evidence = pick("supportedBy", "source", "target")
    outcomes = evidence.withColumnRenamed("target", "e").join(pick("forOutcome", "source", "target").withColumnRenamed("node", "e"), "e").select("node", "target")
    cited = pick("resolvesTo", "target", "source")
    numbered = cited.withColumnRenamed("target", "c").join(pick("numberedAs", "target", "source").withColumnRenamed("node", "c"), "c").select("node", "target")
    ways = [
        ("presentedIn", pick("presentedIn", "source", "target")), ("remark", pick("hasRemark", "source", "target")), ("evidence", evidence), ("outcome", outcomes),
        ("indicator", pick("justifiedBy", "target", "source")), ("indicator", pick("measures", "target", "source")), ("implementedBy", pick("implementedBy", "source", "target")),
        ("citedBy", cited), ("citedBy", numbered),
    ]
    return reduce(DataFrame.unionByName, [t.withColumn("relation", F.lit(name)) for name, t in ways])


def uncovered(nodes: DataFrame, edges: DataFrame, kind: str = "recommendation", predicate: str = "implementedBy") -> DataFrame:
    """Q-02: nodes of a type without an edge of a predicate; its target need not exist."""
    done = edges.where(F.col("predicate") == predicate).select(F.col("source").alias("id"))
    return nodes.where(F.col("type") == kind).join(done, "id", "left_anti").select("id")


def rule_citation_states(nodes: DataFrame, edges: DataFrame, kind: str = "dmn-rule", predicate: str = "citesSource") -> DataFrame:
    """Q-02: each rule is cited (by any citation that is no placeholder), placeholder, or none. Citations without a node do not count."""
    cites = nodes.where("type = 'citation'").select(F.col("id").alias("target"), F.coalesce(F.get_json_object("properties", "$.citationKind") != "placeholder", F.lit(True)).alias("real"))
    found = edges.where(F.col("predicate") == predicate).join(cites, "target").groupBy(F.col("source").alias("id")).agg(F.bool_or("real").alias("real"))
    return nodes.where(F.col("type") == kind).select("id").join(found, "id", "left").select("id", F.when(F.col("real"), "cited").when(~F.col("real"), "placeholder").otherwise("none").alias("state"))


def resolve_citation(nodes: DataFrame, edges: DataFrame, seeds: DataFrame, open_kinds: tuple[str, ...] = ("citation", "reference-entry")) -> tuple[DataFrame, DataFrame]:
    """Q-03: (steps, ends): the walk from each seed along its first resolvesTo, which ends it, else its first numberedAs.

    A step that closes a cycle is the last. target is where the walk ends (a node or an id without one); null without
    steps, or where that is a citation or reference entry still.
    """
    steps = written(follow(seeds, first_hop(edges, ["resolvesTo", "numberedAs"], ["doc_id", "ord"]), last="resolvesTo"))
    last = steps.groupBy("seed").agg(F.max_by("target", "step").alias("end"))
    kinds = nodes.groupBy(F.col("id").alias("end")).agg(F.min_by("type", F.struct("doc_id", "ord")).alias("type"))
    ends = seeds.distinct().join(last, "seed", "left").join(kinds, "end", "left")
    return steps, ends.select("seed", F.when(~F.coalesce(F.col("type").isin(*open_kinds), F.lit(False)), F.col("end")).alias("target"))


def dependents(edges: DataFrame, seeds: DataFrame, predicates: list[str]) -> DataFrame:
    """Q-04: (seed, node, depth): what reaches a seed along edges of some predicates."""
    back = edges.where(F.col("predicate").isin(predicates)).select(F.col("target").alias("source"), F.col("source").alias("target"))
    return reach(seeds, back).where("depth > 0")
