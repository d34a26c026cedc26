"""What changed files ask for, beside the SQL of the state that they lead to: the outcome has to be that of building all anew."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from graphloom.model import make_model
from graphloom.operators import refresh
from graphloom.operators.diff import changes
from graphloom.operators.frontier import shared_folder, written
from graphloom.operators.store import Store, changed_rows
from graphloom.plans.bench_graph import read

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


_NONE = "CAST(NULL AS STRING) AS note, CAST(NULL AS STRUCT<location:STRING,quote:STRING,artifact:STRING,by:STRING,at:STRING>) AS evidence"
_GONE, _EDITED = "c_custkey % 110 = 11", "c_custkey % 70 = 7"


def _graph(spark, d, edited: bool):
    """A document for each customer, who knows the next one, and one for the nations: before the edits, or only what they bring."""
    c = read(spark, d, "customer").where(_EDITED if edited else "true")
    label, kind = ("upper(c_name)", "IF(c_custkey % 2 = 0, 'agent', 'customer')") if edited else ("c_name", "'customer'")
    nodes = c.selectExpr("concat('c/', c_custkey) AS doc_id", "0 AS ord", "concat('customer/', c_custkey) AS id", f"{kind} AS type", f"{label} AS label", "'{}' AS properties", "'derived' AS derivation", *_NONE.split(", ", 1))
    e = c.selectExpr("concat('c/', c_custkey) AS doc_id", "concat('customer/', c_custkey) AS source", "inline(array(struct(0 AS ord, 'knows' AS predicate, concat('customer/', c_custkey + 1) AS target), struct(1 AS ord, 'locatedIn' AS predicate, concat('nation/', c_nationkey) AS target)))")
    edges = e.selectExpr("doc_id", "ord", "predicate", "source", "target", "CAST(NULL AS STRING) AS qualifier", "'derived' AS derivation", *_NONE.split(", ", 1), "'{}' AS properties")
    documents = nodes.selectExpr("doc_id", "'base' AS layer", "'1' AS ontology_version", "array(struct(doc_id AS path, sha2(label, 256) AS sha256)) AS sources")
    if not edited:
        n = read(spark, d, "nation").selectExpr("'geo' AS doc_id", "n_nationkey AS ord", "concat('nation/', n_nationkey) AS id", "'nation' AS type", "n_name AS label", "'{}' AS properties", "'derived' AS derivation", *_NONE.split(", ", 1))
        nodes = nodes.unionByName(n)
        documents = documents.unionByName(n.selectExpr("doc_id", "'base' AS layer", "'1' AS ontology_version", "array(struct(doc_id AS path, repeat('0', 64) AS sha256)) AS sources").distinct())
    return documents, nodes, edges


def _refreshed(spark, d, model: bool):
    """The store before and after: customers edited, others gone; what is not touched is neither extracted nor worked out again."""
    m = None
    if model:
        m = make_model(spark, classes=[("base", c, "Thing", None, None, None) for c in ("customer", "agent", "nation")], predicates=[("base", "knows", False), ("base", "locatedIn", False)], licensed=[("base", "knows", "customer", "customer", None, None), ("base", "locatedIn", "customer", "nation", None, None)], imports=[("base", None, "1", "n")])
    store = Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}", refresh.KEYS, buckets=16)
    refresh.build(store, *[written(t) for t in _graph(spark, d, False)], m)
    before = Store(spark, store.path, store.keys, store.buckets, store.schemas, store.at)
    gone = read(spark, d, "customer").where(f"{_GONE} AND NOT {_EDITED}").selectExpr("concat('c/', c_custkey) AS doc_id")
    refresh.refresh(store, gone, *_graph(spark, d, True), m)
    return before, store


_NOW = f"""c AS (SELECT c_custkey AS k, c_nationkey AS nk, CASE WHEN {_EDITED} THEN upper(c_name) ELSE c_name END AS label, CASE WHEN {_EDITED} AND c_custkey % 2 = 0 THEN 'agent' ELSE 'customer' END AS type FROM customer WHERE {_EDITED} OR NOT {_GONE}),
n AS (SELECT 'customer/' || k AS id, type, label FROM c UNION ALL SELECT 'nation/' || n_nationkey, 'nation', n_name FROM nation),
e AS (SELECT 'c/' || k AS doc_id, 'knows' AS predicate, 'customer/' || k AS source, 'customer/' || (k + 1) AS target FROM c UNION ALL SELECT 'c/' || k, 'locatedIn', 'customer/' || k, 'nation/' || nk FROM c)"""


@query(f"""WITH {_NOW}, x AS (SELECT source AS id, target AS other FROM e UNION ALL SELECT target, source FROM e)
SELECT n.id, n.type, n.label, count(x.other)::BIGINT AS n_edges, count(o.label)::BIGINT AS n_labelled, max(o.label) AS last_label FROM n LEFT JOIN x USING (id) LEFT JOIN n o ON o.id = x.other GROUP BY ALL""")
def refreshed_units(spark, d):
    units = _refreshed(spark, d, False)[1].read("units")
    each = units.select("id", "type", "label", F.explode_outer("edges").alias("e"))
    return each.groupBy("id", "type", "label").agg(F.count("e.other").alias("n_edges"), F.count("e.other_label").alias("n_labelled"), F.max("e.other_label").alias("last_label"))


@query(f"""WITH {_NOW}, t AS (SELECT e.*, s.type AS st, t.type AS tt FROM e LEFT JOIN n s ON s.id = source LEFT JOIN n t ON t.id = target)
SELECT doc_id, 'V-06' AS rule_id, predicate || '|' || source || '|' || target AS subject FROM t WHERE tt IS NULL UNION ALL SELECT doc_id, 'V-07', predicate || '|' || source || '|' || target FROM t WHERE tt IS NOT NULL AND (st = 'agent' OR tt = 'agent')""")
def refreshed_findings(spark, d):
    return _refreshed(spark, d, True)[1].read("findings").select("doc_id", "rule_id", "subject")


@query(f"""SELECT 'customer/' || c_custkey AS id, CASE WHEN {_EDITED} THEN 'changed' ELSE 'gone' END AS change FROM customer WHERE {_EDITED} OR {_GONE}""")
def bucket_diff(spark, d):
    """D-02 between two states of a store: only buckets that they do not share are read."""
    name, spec = "nodes", refresh.KEYS
    store = Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}", spec, buckets=64)
    store.write(nodes=_graph(spark, d, False)[1])
    before = Store(spark, store.path, spec, store.buckets, store.schemas, store.at)
    come = _graph(spark, d, True)[1]
    gone = read(spark, d, "customer").where(_GONE).selectExpr("concat('c/', c_custkey) AS doc_id")
    store.replace(nodes=(come, gone.union(come.select("doc_id"))))
    return changes(*changed_rows(before, store, name), ["id"], ["doc_id", "type", "label"])
