"""Projections, joins, counts and set operations on graphs given as tables of nodes (doc_id, ord, id, type, label, ...) and edges
(doc_id, ord, predicate, source, target, qualifier, ...). Classes give each type its layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions import ids
from graphloom.operators.frontier import written

MOST_SENT = 500_000
"""Ids that are sent to every task: some 50 MB there."""

ROWS_OF_A_TASK = 250_000
"""Edges that a task sorts, joins and counts: some 300 MB there. Spark goes by packed bytes, of which a few MB are millions of rows."""

# Sets and firsts


def first_per_key(t: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """WIN-01: the first row of each key."""
    own = Window.partitionBy(*keys).orderBy(*order)
    return t.withColumn("__n", F.row_number().over(own)).where("__n = 1").drop("__n")


def first_of(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """(id, columns) of the first definition of each id, by document and place: added up where the rows are, then by id."""
    order = F.struct(*[F.col(c) for c in ("doc_id", "ord") if c in nodes.columns], *columns)
    return nodes.groupBy("id").agg(F.min_by(F.struct(*columns), order).alias("f")).select("id", "f.*")


def with_ordinal(t: DataFrame, array: str, item: str = "item") -> DataFrame:
    """WIN-04: a row for each element, with its place from 0."""
    return t.select("*", F.posexplode(array).alias("ordinal", item)).drop(array)


def duplicate_ids(t: DataFrame, keys: list[str]) -> DataFrame:
    """WIN-05: keys that occur twice or more, with the number."""
    return t.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def graph_union(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SET-01: documents as one graph: the first definition of a node, all edges."""
    return first_per_key(nodes, ["id"], ["doc_id", "ord"]), edges


def added_removed(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """SET-02: keys of one side only; null keys match each other."""
    ka, kb = a.select(*keys).distinct(), b.select(*keys).distinct()
    return ka.subtract(kb).withColumn("change", F.lit("removed")).unionByName(kb.subtract(ka).withColumn("change", F.lit("added")))


def union_distinct(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """SET-04: rows of all parts, the first part's row for each key."""
    whole = None
    for i, p in enumerate(parts):
        p = p.withColumn("__part", F.lit(i))
        whole = p if whole is None else whole.unionByName(p)
    return first_per_key(whole, keys, ["__part"]).drop("__part")


def ranked(t: DataFrame, by: list[Column], n: int | None = None) -> DataFrame:
    """ORD-01: sorted, and cut to the first n where a report asks for so many."""
    out = t.orderBy(*by)
    return out if n is None else out.limit(n)


def top_findings(findings: DataFrame, n: int = 6) -> DataFrame:
    """ORD-02: the first n findings of each document."""
    own = Window.partitionBy("doc_id").orderBy("rule_id", "subject", "message")
    return findings.withColumn("place", F.row_number().over(own)).where(F.col("place") <= n)


# Projections


def out(edges: DataFrame, node: str, predicate: str) -> DataFrame:
    """PRJ-01: edges out of a node."""
    return edges.where((F.col("source") == node) & (F.col("predicate") == predicate))


def into(edges: DataFrame, node: str, predicate: str) -> DataFrame:
    """PRJ-01: edges into a node."""
    return edges.where((F.col("target") == node) & (F.col("predicate") == predicate))


def with_layers(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """edges with type and layer of both ends; nodes have a column layer. An id that several documents define counts by its first definition."""
    first = first_of(nodes, ["type", "layer"])
    of = lambda end: first.select(F.col("id").alias(end), F.col("type").alias(f"{end}_type"), F.col("layer").alias(f"{end}_layer"))
    return edges.join(of("source"), "source").join(of("target"), "target")


def subgraph(nodes: DataFrame, edges: DataFrame, layers: list[str], predicate: str | None = None) -> tuple[DataFrame, DataFrame]:
    """PRJ-02: nodes of some layers, edges between them (of a predicate), and then no nodes that the predicate leaves bare."""
    kept = nodes.where(F.col("layer").isin(layers))
    ends = kept.select("id")
    e = edges if predicate is None else edges.where(F.col("predicate") == predicate)
    e = e.join(ends.withColumnRenamed("id", "source"), "source", "left_semi").join(ends.withColumnRenamed("id", "target"), "target", "left_semi")
    if predicate is not None:
        touched = e.select(F.explode(F.array("source", "target")).alias("id"))
        kept = kept.join(touched, "id", "left_semi")
    return kept, e


def search(nodes: DataFrame, edges: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """PRJ-03: nodes with text in id, label, type or a property's name, whatever the case, and the edges at them."""
    word = text.lower()
    named = F.exists(F.coalesce(F.json_object_keys("properties"), F.array().cast("array<string>")), lambda k: F.lower(k).contains(word))
    hits = nodes.where(F.lower("id").contains(word) | F.lower("label").contains(word) | F.lower("type").contains(word) | named)
    at = written(hits.select("id").distinct())  # once; up to MOST_SENT ids go to every task, so that edges, mostly far more, are not dealt
    at = at.hint("broadcast" if at.count() <= MOST_SENT else "merge")
    met = edges
    for end in ("source", "target"):
        met = met.join(at.select(F.col("id").alias(end), F.lit(True).alias(f"__{end}")), end, "left")
    return hits, met.where("__source OR __target").select(*edges.columns)


def search_comments(t: DataFrame, column: str, word: str) -> DataFrame:
    """PRJ-04"""
    return t.where(F.lower(column).contains(word.lower()))


def internal_edges(layered: DataFrame, layer: str) -> DataFrame:
    """PRJ-05"""
    return layered.where((F.col("source_layer") == layer) & (F.col("target_layer") == layer))


def outbound_edges(layered: DataFrame, layer: str) -> DataFrame:
    """PRJ-06"""
    return layered.where((F.col("source_layer") == layer) & (F.col("target_layer") != layer))


def neighbourhood(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """PRJ-07: (id, direction, predicate, other, qualifier): each node with what leads out of it and into it, a row an edge; a node without edges has one row of nulls. Nothing is gathered: a hub is many rows."""
    side = lambda end, other, name: edges.select(F.col(end).alias("id"), F.lit(name).alias("direction"), "predicate", F.col(other).alias("other"), "qualifier")
    return nodes.select("id").distinct().join(side("source", "target", "out").unionByName(side("target", "source", "in")), "id", "left")


# Joins


def match_by_name(left: DataFrame, right: DataFrame, name: str, ref: str) -> DataFrame:
    """JON-03 to 05: rows of left with the number of rows of right of that name, the status of the join and the one match.

    None: unresolved; one: resolved; more: ambiguous, and left open. Right is counted by name before the join.
    """
    by = right.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("matches"), F.min(ref).alias("__ref"))
    joined = left.join(by, name, "left").withColumn("matches", F.coalesce("matches", F.lit(0)).cast("long"))
    status = F.when(F.col("matches") == 0, "unresolved").when(F.col("matches") == 1, "resolved").otherwise("ambiguous")
    return joined.withColumn("status", status).withColumn("match", F.when(F.col("matches") == 1, F.col("__ref"))).drop("__ref")


def placeholders(matched: DataFrame, name: str, kind: str, ns: str) -> DataFrame:
    """A node for each name that matched nothing; names with one slug share it."""
    lost = matched.where("status = 'unresolved'").groupBy(ids.slug(F.col(name)).alias("slug")).agg(F.min(name).alias("label"))
    return lost.select(F.concat(F.lit(f"{ns}/{kind}/"), "slug").alias("id"), F.lit(kind).alias("type"), "label", F.lit("unresolved").alias("resolution_status"))


def component_artifacts(nodes: DataFrame, edges: DataFrame, predicate: str = "implementedBy") -> DataFrame:
    """JON-07: (id, type, artifact): what implements each component, a row each."""
    of = edges.where(F.col("predicate") == predicate).select(F.col("source").alias("id"), F.col("target").alias("artifact")).distinct()
    return of.join(nodes.select("id", "type"), "id")


def two_hops(nodes: DataFrame, edges: DataFrame, kind: str) -> DataFrame:
    """JON-08: paths of two edges out of nodes of a type; counted by way, since parallel edges are paths of their own."""
    step = edges.groupBy("predicate", "source", "target").agg(F.count("*").alias("n"))
    one = step.join(nodes.where(F.col("type") == kind).select(F.col("id").alias("source")), "source", "left_semi")
    two = step.select(F.col("source").alias("target"), F.col("predicate").alias("predicate_2"), F.col("target").alias("end"), F.col("n").alias("n_2"))
    return one.join(two, "target").select("source", "predicate", F.col("target").alias("middle"), "predicate_2", "end", (F.col("n") * F.col("n_2")).alias("paths"))


def trace_path(edges: DataFrame, predicates: list[str]) -> DataFrame:
    """JON-09: distinct (node_0, node_1, ...) along predicates in turn."""
    path = None
    for i, p in enumerate(predicates):
        step = edges.where(F.col("predicate") == p).select(F.col("source").alias(f"node_{i}"), F.col("target").alias(f"node_{i + 1}")).distinct()
        path = step if path is None else path.join(step, f"node_{i}")
    return path.select(*[f"node_{i}" for i in range(len(predicates) + 1)])


def cross_layer_edges(layered: DataFrame) -> DataFrame:
    """JON-10"""
    return layered.where("source_layer <> target_layer")


def unreferenced(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """JON-11: nodes that nothing points at."""
    return nodes.join(edges.select(F.col("target").alias("id")), "id", "left_anti")


def leaf_violations(nodes: DataFrame, edges: DataFrame, kind: str) -> DataFrame:
    """JON-12: edges out of a type that must have none."""
    return edges.join(nodes.where(F.col("type") == kind).select(F.col("id").alias("source")), "source", "left_semi")


def undefined_references(nodes: DataFrame, edges: DataFrame, kinds: list[str]) -> DataFrame:
    """JON-15: unresolved nodes of some types, and what refers to them."""
    status = F.get_json_object("properties", "$.resolutionStatus")
    lost = nodes.where(F.col("type").isin(kinds) & ~status.eqNullSafe(F.lit("resolved"))).select(F.col("id").alias("target"), F.col("type").alias("target_type"))
    return edges.join(lost, "target").select("target", "target_type", "predicate", "source")


def unused(declared: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """JON-16"""
    return declared.select(key).distinct().join(used.select(key).distinct(), key, "left_anti")  # once each: a key may stand in most rows


# Counts


def counts(t: DataFrame, *by: str) -> DataFrame:
    """AGG-01, 02, 10, 11"""
    return t.groupBy(*by).agg(F.count("*").alias("n"))


def cross_document_count(ends: DataFrame) -> DataFrame:
    """AGG-04: edges of a document with an end in another."""
    return ends.groupBy("doc_id").agg(F.count_if((F.col("source_doc") != F.col("doc_id")) | (F.col("target_doc") != F.col("doc_id"))).alias("n"))


def coverage_of(kinds: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """AGG-06, 08: how often each of some kinds was found, zeros kept."""
    return kinds.select(key).distinct().join(counts(found, key), key, "left").select(key, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def orphan_files(files: DataFrame, declared: DataFrame, path: str = "path") -> DataFrame:
    """AGG-07: model files that nothing declares; layout files aside."""
    wanted = files.where(F.col(path).rlike(r"\.(bpmn|dmn)$") & ~F.col(path).contains(".layout."))
    return wanted.join(declared.select(path), path, "left_anti")


def names_per_kind(t: DataFrame, kind: str, name: str) -> DataFrame:
    """AGG-12: (kind, name), each once: a row a name, since a kind may have any number."""
    return t.where(F.col(name).isNotNull()).select(kind, name).distinct()


def kit_components(nodes: DataFrame, edges: DataFrame, predicate: str = "hasComponent") -> DataFrame:
    """AGG-13: components of each kit with the qualifier they hang by. Edges are counted, and dealt by component over as many tasks as they fill."""
    of = edges.where(F.col("predicate") == predicate).select("source", "target", "qualifier")
    tasks = max(edges.sparkSession.sparkContext.defaultParallelism, -(-of.count() // ROWS_OF_A_TASK))
    kinds = nodes.select(F.col("id").alias("target"), "type", "layer").repartition(tasks, "target")
    return of.repartition(tasks, "target").join(kinds, "target").select(F.col("source").alias("kit"), F.col("target").alias("component"), "qualifier", "type", "layer")


def merge_parallel(edges: DataFrame) -> DataFrame:
    """AGG-14: one row for each ordered pair of nodes, its labels once each in the order they came."""
    label = F.when(F.col("qualifier").isNull(), F.col("predicate")).otherwise(F.concat("predicate", F.lit(" ("), "qualifier", F.lit(")")))
    one = edges.select("source", "target", "doc_id", "ord", label.alias("label")).groupBy("source", "target", "label").agg(F.min(F.struct("doc_id", "ord")).alias("at"))
    listed = one.groupBy("source", "target").agg(F.array_sort(F.collect_list(F.struct("at", "label"))).alias("l"))
    return listed.select("source", "target", F.array_join(F.transform("l", lambda x: x["label"]), ", ").alias("labels"))


def layer_totals(nodes: DataFrame, layered: DataFrame) -> DataFrame:
    """AGG-15: nodes and edges of each layer, and the totals under a null layer."""
    n = nodes.groupBy("layer").agg(F.count("*").alias("n_nodes"))
    e = layered.groupBy(F.col("source_layer").alias("layer")).agg(F.count("*").alias("n_edges"))
    both = n.join(e, "layer", "full_outer").na.fill(0)
    return both.rollup("layer").agg(F.sum("n_nodes").alias("n_nodes"), F.sum("n_edges").alias("n_edges"))
