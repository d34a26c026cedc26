"""What a change of files asks for, and no more: extraction, retrieval units and findings of what it touches.

A manifest keeps size, time and hash of each file. Files that look as they did are not opened. Documents of changed files replace the
old ones in a store (store.py); from their ids before and after follow the units and the documents whose findings can be other
than they were, and only those are worked out again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.model import Model
from graphloom.operators import rules
from graphloom.operators.frontier import written
from graphloom.operators.retrieval import retrieval_units
from graphloom.operators.store import Store

KEYS = {"documents": "doc_id", "nodes": "doc_id", "edges": "doc_id", "ids": "id", "ends": "id", "units": "id", "findings": "doc_id"}
"""Tables of a store and what they are dealt by. ids: where each id is defined; ends: which documents refer to it."""


def listing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(file, length, modified): a folder's files by their metadata; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    return files.where(~F.col("path").contains("/.git/")).select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def suspects(now: DataFrame, manifest: DataFrame) -> DataFrame:
    """(file): files that are new, or of another size or time than in the manifest (file, length, modified, sha256). Only these need be read."""
    known = manifest.select("file", F.col("length").alias("__l"), F.col("modified").alias("__m"))
    return now.join(known, "file", "left").where("NOT (length <=> __l AND modified <=> __m)").select("file")


def read_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(file, length, modified, sha256, text) of the files in a table of few: their paths go through the driver, their contents do not."""
    paths = [r.file for r in files.select("file").distinct().collect()]
    if not paths:
        return spark.createDataFrame([], "file string, length long, modified timestamp, sha256 string, text string")
    t = spark.read.format("binaryFile").load(paths)
    return t.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"), F.col("content").cast("string").alias("text"))


def file_changes(read: DataFrame, now: DataFrame, manifest: DataFrame, version: str | None = None) -> DataFrame:
    """(file, change): added, changed (by hash; or every file, where the manifest has another version of the model) and gone. read: hashes of the suspects."""
    old = manifest.select("file", F.col("sha256").alias("old"), *([F.col("version")] if version is not None else []))
    known = read.select("file", F.col("sha256").alias("new")).join(old, "file", "left")
    change = F.when(F.col("old").isNull(), "added").when(F.col("old") != F.col("new"), "changed")
    out = known.select("file", change.alias("change")).where("change IS NOT NULL")
    if version is not None:
        other = old.where(~F.col("version").eqNullSafe(F.lit(version))).join(now.select("file"), "file", "left_semi").join(out.select("file"), "file", "left_anti")
        out = out.unionByName(other.select("file", F.lit("changed").alias("change")))
    return out.unionByName(old.join(now.select("file"), "file", "left_anti").select("file", F.lit("gone").alias("change")))


def documents_from(documents: DataFrame, paths: DataFrame) -> DataFrame:
    """(doc_id): documents that were made from some files (path): the first step of provenance, from which nodes and units follow."""
    made = documents.select("doc_id", F.explode("sources").alias("s")).select("doc_id", F.col("s.path").alias("path"))
    return made.join(paths.select("path").distinct(), "path", "left_semi").select("doc_id").distinct()


def _ids(nodes: DataFrame) -> DataFrame:
    return nodes.select("id", "doc_id").distinct()


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select("doc_id", F.explode(F.array("source", "target")).alias("id")).distinct().select("id", "doc_id")


def build(store: Store, documents: DataFrame, nodes: DataFrame, edges: DataFrame, model: Model | None = None, most_edges: int = 50) -> None:
    """All of a store: the graph, where ids are defined and referred to, units, and findings if there is a model."""
    more = {} if model is None else {"findings": rules.validate(documents, nodes, edges, model)}
    store.write(documents=documents, nodes=nodes, edges=edges, ids=_ids(nodes), ends=_ends(edges), units=retrieval_units(nodes, edges, most_edges, documents), **more)


def _at(store: Store, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes that define, edges that touch) some ids, out of the documents that the store knows to hold them."""
    named = store.near("ids", ids).select("doc_id").distinct()
    nodes = store.near("nodes", named).join(ids, "id", "left_semi")
    near = store.near("edges", store.near("ends", ids).select("doc_id").distinct())
    return nodes, near.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").unionByName(near.join(ids.withColumnRenamed("id", "target"), "target", "left_semi").join(ids.withColumnRenamed("id", "source"), "source", "left_anti"))


def refresh(store: Store, gone: DataFrame, documents: DataFrame, nodes: DataFrame, edges: DataFrame, model: Model | None = None, most_edges: int = 50) -> dict[str, DataFrame]:
    """The documents in gone (doc_id) go, others come; what comes out is what `build` would give. Returns (id) units and (doc_id) findings that were done again,
    as tables in the shared folder; `remove_written` clears them and all others on the way.

    Units that may change: those of ids that the documents define or refer to, before or after, and those with an edge to an id that they
    define, since they hold its label. Findings: those of the documents, and of all that define, or refer to, an id that they define.
    """
    documents, nodes, edges = written(documents), written(nodes), written(edges)
    mine = written(gone.select("doc_id").union(documents.select("doc_id")).distinct())
    old_nodes, old_edges = store.near("nodes", mine), store.near("edges", mine)
    defined = written(_ids(old_nodes).union(_ids(nodes)).select("id").distinct())
    touched = _ends(old_edges).union(_ends(edges)).select("id")
    # who refers to what they define: looked up before the change, and those that come
    referring = written(store.near("ends", defined).union(_ends(edges).join(defined, "id", "left_semi")).distinct())
    by_edge = store.near("edges", referring.select("doc_id").distinct())
    across = [by_edge.join(defined.withColumnRenamed("id", end), end, "left_semi").select(F.col(other).alias("id")) for end, other in (("source", "target"), ("target", "source"))]
    ids = written(defined.union(touched).union(across[0]).union(across[1]).distinct())
    docs = written(mine.union(referring.select("doc_id")).union(store.near("ids", defined).select("doc_id")).distinct())

    ids_of, ends_of = _ids(nodes), _ends(edges)
    old_ids, old_ends = _ids(old_nodes).select("id"), _ends(old_edges).select("id")
    keep = lambda name, keys: store.near(name, keys).join(mine, "doc_id", "left_anti")
    id_keys, end_keys = written(old_ids.union(ids_of.select("id")).distinct()), written(old_ends.union(ends_of.select("id")).distinct())
    store.replace(
        documents=(documents, mine), nodes=(nodes, mine), edges=(edges, mine), ids=(written(keep("ids", id_keys).unionByName(ids_of)), id_keys), ends=(written(keep("ends", end_keys).unionByName(ends_of)), end_keys),
    )

    around = written(ids.union(_others(_at(store, ids)[1])).distinct())  # labels of the other ends
    at_nodes = _at(store, around)[0]
    at_edges = _at(store, ids)[1]
    held = store.near("documents", at_nodes.select("doc_id").distinct())
    units = retrieval_units(written(at_nodes), written(at_edges), most_edges, held).join(ids, "id", "left_semi")
    changes = {"units": (written(units), ids)}
    if model is not None:
        now = store.near("documents", docs)
        own_nodes, own_edges = store.near("nodes", docs), written(store.near("edges", docs))
        needed = _ids(own_nodes).select("id").union(_ends(own_edges).select("id")).distinct()
        all_nodes = written(store.near("nodes", store.near("ids", needed).select("doc_id").union(docs).distinct()).join(needed, "id", "left_semi"))
        found = rules.validate(now, all_nodes, own_edges, model).join(docs, "doc_id", "left_semi")
        changes["findings"] = (written(found), docs)
    store.replace(**changes)
    return {"units": ids, "findings": docs}


def _others(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("source", "target")).alias("id")).distinct()
