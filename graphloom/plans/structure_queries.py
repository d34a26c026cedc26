"""Queries over circles, hot ids and the text index, each beside the SQL it is held against."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators import hot, text_index
from graphloom.operators.cycles import strong_components
from graphloom.operators.frontier import shared_folder
from graphloom.operators.lines import lines_of
from graphloom.plans.bench_graph import bench_graph, read
from graphloom.plans.graph_queries import QUERIES, SQL, query, with_more  # noqa: F401


def _circles(spark, d, parts: bool = True) -> tuple[DataFrame, DataFrame]:
    """(edges, heads): the customers of a nation are a tree with ways home from its leaves, and nations of a region follow each other; the parts of a size are a ring."""
    for name in ("customer", "nation", "part"):
        read(spark, d, name).createOrReplaceTempView(f"circle_{name}")
    c = "c AS (SELECT concat('customer/', c_custkey) AS id, c_nationkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS i, count(*) OVER (PARTITION BY c_nationkey) AS n FROM circle_customer)"
    h = "h AS (SELECT id, k, n, n_regionkey AS r FROM c JOIN circle_nation ON n_nationkey = k WHERE i = 1)"
    p = "p AS (SELECT concat('part/', p_partkey) AS id, coalesce(lead(p_partkey) OVER w, first(p_partkey) OVER w) AS nx, row_number() OVER w AS i FROM circle_part WINDOW w AS (PARTITION BY p_size ORDER BY p_partkey))"
    edges = spark.sql(f"""WITH {c}, {h}, {p}
SELECT a.id AS source, b.id AS target FROM (SELECT *, explode(CASE WHEN 2 * i > n THEN array(1) WHEN 2 * i = n THEN array(2 * i) ELSE array(2 * i, 2 * i + 1) END) AS j FROM c) a JOIN c b ON b.k = a.k AND b.i = a.j WHERE a.n > 1
UNION ALL SELECT id, nx FROM (SELECT id, lead(id) OVER (PARTITION BY r ORDER BY k) AS nx FROM h) WHERE nx IS NOT NULL
{"UNION ALL SELECT id, concat('part/', nx) FROM p" if parts else ""}""")
    return edges, spark.sql(f"WITH {c}, {p} SELECT id AS seed FROM c WHERE i = 1 UNION ALL SELECT id FROM p WHERE i = 1")


_CIRCLES = "c AS (SELECT concat('customer/', c_custkey) AS id, c_custkey AS key, c_nationkey AS k, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer), p AS (SELECT concat('part/', p_partkey) AS id, p_partkey AS key, p_size AS k, count(*) OVER (PARTITION BY p_size) AS n FROM part)"


@query(f"WITH {_CIRCLES} SELECT id AS node, min(id) OVER (PARTITION BY k) AS component FROM c WHERE n > 1 UNION ALL SELECT id, min(id) OVER (PARTITION BY k) FROM p WHERE n > 1", graph=False)
def circle_components(spark, d):
    """M-06, Q-05: the rings of parts are put together as lines before labels are sent along what is left."""
    lines = lines_of(_circles(spark, d)[0])
    knots = lines.members.where("loop").groupBy("knot").agg(F.min("node").alias("component"), F.count("*").alias("n")).where("n > 1")
    return lines.members.join(knots, "knot").select("node", "component")


@query(f"WITH {_CIRCLES} SELECT id AS node, min(id) OVER (PARTITION BY k) AS component FROM c WHERE n > 1", graph=False)
def labelled_components(spark, d):
    """The customers' circles by folds and labels, without lines."""
    return strong_components(_circles(spark, d, parts=False)[0])


@query(with_more("ends AS (SELECT e.predicate, e.source, e.target, t.type AS target_type, t.label AS target_label FROM edges e LEFT JOIN nodes t ON t.id = e.target) SELECT *, count(*)::BIGINT AS n FROM ends GROUP BY ALL"))
def hub_endpoints(spark, d):
    """JON-01 on the hot side: nations are a few ids at which each customer and supplier hangs."""
    n, e = bench_graph(spark, d)
    e = e.select("doc_id", "ord", "predicate", "source", "target")
    ends = hot.look_up(e, n.select(F.col("id").alias("target"), F.col("type").alias("target_type"), F.col("label").alias("target_label")), "target", hot.hot_ids(e, "target", 0.001))
    return ends.groupBy("predicate", "source", "target", "target_type", "target_label").agg(F.count("*").alias("n"))


def _new_folder(spark) -> str:
    return f"{shared_folder(spark)}/graphloom-index-{uuid.uuid4().hex}"


@query("""WITH t AS (SELECT unnest(['SUPPLIER', 'er/12', 'red', '#0000', 'or']) AS word), n AS (SELECT id, type, label FROM nodes) SELECT word, id FROM n, t
WHERE contains(lower(id), lower(word)) OR contains(lower(label), lower(word)) OR contains(lower(type), lower(word))""".replace("WITH t AS", ", t AS", 1))
def indexed_search(spark, d):
    """PRJ-03 by the index, for several texts; the last is too short to have a gram."""
    n, _ = bench_graph(spark, d)
    index = text_index.build_index(n, "id", text_index.node_texts, _new_folder(spark))
    out = None
    for word in ("SUPPLIER", "er/12", "red", "#0000", "or"):
        hits = index.search(word).select(F.lit(word).alias("word"), "id")
        out = hits if out is None else out.unionByName(hits)
    return out


@query("SELECT doc_id AS line, count(*)::BIGINT AS n FROM documents WHERE contains(lower(text), 'that') GROUP BY ALL", graph=False)
def indexed_text_search(spark, d):
    """PRJ-04 by the index, over whole texts."""
    docs = read(spark, d, "documents").select("doc_id", "text")
    index = text_index.build_index(docs, "doc_id", lambda: F.array("text"), _new_folder(spark))
    return index.search("That").groupBy(F.col("doc_id").alias("line")).agg(F.count("*").alias("n"))
