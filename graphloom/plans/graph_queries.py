"""Queries over the bench graph, each beside the SQL it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.model import check_model, duplicate_keys, fk_violations, missing_borrowed
from graphloom.operators import graph as g
from graphloom.operators import questions, retrieval, rules
from graphloom.operators.diff import changes, diff_documents, diff_sources, field_changes, last_per_key, normalise
from graphloom.operators.frontier import written
from graphloom.plans.bench_graph import bench_documents, bench_graph, bench_model, graph_sql, one_layer, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
FINDING = ["doc_id", "rule_id", "severity", "subject", "message"]


def query(sql: str | None, graph: bool = True):
    """Register a query under the name of its function, with its SQL; {G} stands for the graph's CTEs."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = f"WITH {graph_sql()} {sql}" if graph else sql
        return f

    return register


def with_more(sql: str) -> str:
    """SQL whose first CTEs follow those of the graph."""
    return f", {sql}"


def _layered(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    n, e = bench_graph(spark, d)
    again = n.where("type = 'nation'").withColumns({"doc_id": F.lit("zz"), "layer": F.lit("zz")})  # the first definition of an id counts, once
    return n, e, g.with_layers(e, n.unionByName(again))


# Projections and sets


@query("SELECT id, type, label FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY run, ord) AS k FROM (SELECT 1 AS run, ord, id, type, label FROM nodes WHERE doc_id <> 'geo' UNION ALL SELECT 2, ord, id, type, upper(label) FROM nodes)) WHERE k = 1")
def graph_union(spark, d):
    n, e = bench_graph(spark, d)
    twice = n.where("doc_id <> 'geo'").withColumn("doc_id", F.lit("1")).unionByName(n.withColumns({"doc_id": F.lit("2"), "label": F.upper("label")}))
    return g.graph_union(twice, e)[0].select("id", "type", "label")


@query("SELECT 'node' AS what, id AS a, type AS b, 1::BIGINT AS n FROM nodes WHERE layer IN ('party', 'geo') AND (id IN (SELECT source FROM edges WHERE predicate = 'locatedIn') OR id IN (SELECT target FROM edges WHERE predicate = 'locatedIn')) UNION ALL SELECT 'edge', source, target, count(*) FROM edges WHERE predicate = 'locatedIn' GROUP BY source, target")
def subgraph_filter(spark, d):
    n, e = bench_graph(spark, d)
    kept, links = g.subgraph(n, e, ["geo", "party"], "locatedIn")
    return kept.select(F.lit("node").alias("what"), F.col("id").alias("a"), F.col("type").alias("b"), F.lit(1).cast("long").alias("n")).unionByName(links.groupBy(F.lit("edge").alias("what"), F.col("source").alias("a"), F.col("target").alias("b")).agg(F.count("*").alias("n")))


@query("SELECT id, (SELECT count(*) FROM edges e WHERE e.source = n.id OR e.target = n.id)::BIGINT AS n_edges FROM nodes n WHERE contains(lower(id), 'supplier') OR contains(lower(label), 'supplier') OR contains(lower(type), 'supplier')")
def node_search(spark, d):
    n, e = bench_graph(spark, d)
    hits, touched = g.search(n, e, "SUPPLIER")
    at = touched.select(F.explode(F.array_distinct(F.array("source", "target"))).alias("id")).groupBy("id").agg(F.count("*").alias("n_edges"))
    return hits.join(at, "id", "left").select("id", F.coalesce("n_edges", F.lit(0)).cast("long").alias("n_edges"))


@query("SELECT doc_id AS line, lower(text) LIKE '%that%' AS hit, count(*)::BIGINT AS n FROM documents WHERE lower(text) LIKE '%that%' GROUP BY ALL", graph=False)
def comment_search(spark, d):
    hits = g.search_comments(read(spark, d, "documents"), "text", "That")
    return hits.groupBy(F.col("doc_id").alias("line")).agg(F.lit(True).alias("hit"), F.count("*").alias("n"))


_L = "el AS (SELECT e.*, s.layer AS sl, t.layer AS tl, s.type AS st, t.type AS tt FROM edges e JOIN nodes s ON s.id = e.source JOIN nodes t ON t.id = e.target)"


@query(with_more(f"{_L} SELECT predicate, source, target, count(*)::BIGINT AS n FROM el WHERE sl = 'trade' AND tl = 'trade' GROUP BY ALL"))
def internal_edges(spark, d):
    return g.internal_edges(_layered(spark, d)[2], "trade").groupBy("predicate", "source", "target").agg(F.count("*").alias("n"))


@query(with_more(f"{_L} SELECT predicate, tl AS target_layer, source, target, count(*)::BIGINT AS n FROM el WHERE sl = 'trade' AND tl <> 'trade' GROUP BY ALL"))
def outbound_edges(spark, d):
    return g.outbound_edges(_layered(spark, d)[2], "trade").groupBy("predicate", "target_layer", "source", "target").agg(F.count("*").alias("n"))


@query(with_more("""x AS (SELECT source AS id, 'out' AS direction, predicate, target AS other, qualifier FROM edges UNION ALL SELECT target, 'in', predicate, source, qualifier FROM edges)
SELECT id, direction, predicate, other, qualifier, count(*)::BIGINT AS n FROM (SELECT id FROM nodes) LEFT JOIN x USING (id) GROUP BY ALL"""))
def neighbourhood(spark, d):
    return g.neighbourhood(*bench_graph(spark, d)).groupBy("id", "direction", "predicate", "other", "qualifier").agg(F.count("*").alias("n"))


# Rules


@query("""SELECT predicate, source, target, s.type AS source_type, t.type AS target_type, s.doc_id AS source_doc, t.doc_id AS target_doc, count(*)::BIGINT AS n
FROM edges e LEFT JOIN nodes s ON s.id = e.source LEFT JOIN nodes t ON t.id = e.target GROUP BY ALL""")
def edge_endpoints(spark, d):
    n, e = bench_graph(spark, d)
    return rules.with_endpoints(e, n).groupBy("predicate", "source", "target", "source_type", "target_type", "source_doc", "target_doc").agg(F.count("*").alias("n"))


_LIVE = "live AS (SELECT * FROM nodes WHERE NOT (type = 'order' AND derivation = 'decided'))"
_LEFT = "ends AS (SELECT e.*, s.type AS st, t.type AS tt FROM edges e LEFT JOIN live s ON s.id = e.source LEFT JOIN live t ON t.id = e.target)"
_EDGE = "predicate || '|' || source || '|' || target"


@query(with_more(f"""{_LIVE}, {_LEFT} SELECT doc_id, 'V-05' AS rule_id, 'error' AS severity, {_EDGE} AS subject, 'source is defined nowhere' AS message FROM ends WHERE st IS NULL
UNION ALL SELECT doc_id, 'V-06', 'error', {_EDGE}, 'target is defined nowhere' FROM ends WHERE st IS NOT NULL AND tt IS NULL"""))
def dangling_edges(spark, d):
    n, e = bench_graph(spark, d)
    return rules.edge_findings(e, n.where("NOT (type = 'order' AND derivation = 'decided')"), bench_documents(spark), bench_model(spark), {"V-05", "V-06"})


_LIC = "lic(p, st, tt, q, least) AS (VALUES ('partOf', 'nation', 'region', NULL, NULL), ('locatedIn', 'customer', 'nation', NULL, 'inferred'), ('locatedIn', 'supplier', 'nation', NULL, 'inferred'), ('placedBy', 'order', 'customer', NULL, NULL), ('contains', 'order', 'part', 'R', NULL), ('contains', 'order', 'part', 'N', NULL), ('supersedes', 'order', 'order', NULL, NULL))"
_RANK = lambda c: f"(CASE {c} WHEN 'derived' THEN 0 WHEN 'inferred' THEN 1 WHEN 'decided' THEN 2 END)"
_UNLICENSED = f"SELECT doc_id, 'V-07' AS rule_id, 'error' AS severity, {_EDGE} AS subject, 'not licensed; licensed here: ' || coalesce((SELECT string_agg(DISTINCT p || coalesce(' («' || q || '»)', ''), ', ' ORDER BY p || coalesce(' («' || q || '»)', '')) FROM lic l WHERE l.st = el.st AND l.tt = el.tt), 'nothing') AS message FROM el WHERE NOT EXISTS (SELECT 1 FROM lic WHERE p = predicate AND lic.st = el.st AND lic.tt = el.tt)"
_QUALIFIED = f"SELECT doc_id, 'V-08' AS rule_id, 'warning' AS severity, {_EDGE} AS subject, 'unknown qualifier: ' || qualifier AS message FROM el WHERE predicate = 'contains' AND qualifier NOT IN ('R', 'N')"
_EXPLAINED = f"""SELECT doc_id, 'V-09' AS rule_id, 'error' AS severity, {_EDGE} AS subject, 'must be at least inferred' AS message FROM el WHERE predicate = 'locatedIn' AND {_RANK('derivation')} < 1
UNION ALL SELECT doc_id, 'V-10', 'error', {_EDGE}, 'decided by nobody or never' FROM el WHERE predicate <> 'suppliedBy' AND derivation = 'decided' AND ev_by IS NULL
UNION ALL SELECT doc_id, 'V-11', 'error', {_EDGE}, derivation || ' without ' || CASE WHEN note IS NULL THEN 'note' ELSE 'evidence' END FROM el WHERE predicate <> 'suppliedBy' AND derivation <> 'derived' AND (note IS NULL OR ev_location IS NULL)"""
_NODES = f"""SELECT doc_id, 'V-04' AS rule_id, 'error' AS severity, id AS subject, derivation || ' without ' || CASE WHEN note IS NULL THEN 'note' ELSE 'evidence' END AS message FROM nodes WHERE derivation <> 'derived' AND (note IS NULL OR ev_location IS NULL)
UNION ALL SELECT doc_id, 'V-19', 'error', id, 'must be at least inferred' FROM nodes WHERE type = 'customer' AND {_RANK('derivation')} < 1
UNION ALL SELECT doc_id, 'V-20', 'error', id, 'decided by nobody or never' FROM nodes WHERE derivation = 'decided' AND ev_by IS NULL"""
_STATUS = f"""SELECT doc_id, 'V-32' AS rule_id, 'error' AS severity, {_EDGE} AS subject, 'unknown status: ' || status AS message FROM edges WHERE status NOT IN ('resolved', 'unresolved', 'ambiguous')
UNION ALL SELECT doc_id, 'V-34', 'error', {_EDGE}, 'resolved without saying where' FROM edges WHERE status = 'resolved' AND derivation IN ('inferred', 'decided') AND ev_location IS NULL"""


def _edge_rules(spark, d, *only):
    n, e = bench_graph(spark, d)
    return rules.edge_findings(e, n, bench_documents(spark), bench_model(spark), set(only))


@query(with_more(f"{_L}, {_LIC} {_UNLICENSED}"))
def unlicensed_edges(spark, d):
    return _edge_rules(spark, d, "V-07")


@query(with_more(f"{_L}, {_LIC} {_QUALIFIED}"))
def qualifier_warnings(spark, d):
    return _edge_rules(spark, d, "V-08")


@query(with_more(f"{_L} {_EXPLAINED}"))
def edge_explanations(spark, d):
    return _edge_rules(spark, d, "V-09", "V-10", "V-11")


@query(_NODES)
def node_explanations(spark, d):
    return rules.node_findings(bench_graph(spark, d)[0], bench_documents(spark), bench_model(spark), {"V-04", "V-19", "V-20"})


@query("SELECT doc_id, 'V-03' AS rule_id, 'error' AS severity, id AS subject, 'type not in scope: ' || type AS message FROM nodes WHERE doc_id = 'party' AND type = 'supplier' UNION ALL SELECT doc_id, 'V-03', 'error', id, 'type not in scope: ' || type FROM nodes WHERE doc_id = 'geo' AND type = 'nation'")
def unknown_types(spark, d):
    n, _ = bench_graph(spark, d)
    m = bench_model(spark)
    m.classes = m.classes.where("id NOT IN ('supplier', 'nation')")
    return rules.node_findings(n, bench_documents(spark), m, {"V-03"})


@query("SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1", graph=False)
def duplicate_ids(spark, d):
    return g.duplicate_ids(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def _events_as_nodes(spark, d):
    kind = F.concat(F.lit("event-"), "event_type")
    body = F.to_json(F.struct(F.col("event_type").alias("eventType"), F.get_json_object("props", "$.k").alias("k"), F.when(F.col("value") > 100, F.col("user_id").cast("string")).alias("user")))
    return read(spark, d, "events").select(F.lit("log").alias("doc_id"), F.col("event_id").alias("ord"), F.concat(F.lit("event/"), "event_id").alias("id"), kind.alias("type"), F.col("event_type").alias("label"), body.alias("properties"))


_EV = "ev AS (SELECT event_id, event_type, json_extract_string(props, '$.k') AS k, CASE WHEN value > 100 THEN user_id END AS u FROM events)"


@query(f"WITH {_EV} SELECT 'log' AS doc_id, 'V-12' AS rule_id, 'error' AS severity, concat('event/', event_id) AS subject, 'undeclared property: user' AS message FROM ev WHERE u IS NOT NULL AND event_type <> 'error'", graph=False)
def undeclared_properties(spark, d):
    n = _events_as_nodes(spark, d)
    docs, m = one_layer(spark, "log", n)
    m.class_properties = n.where("label <> 'error'").select(F.col("type").alias("class")).distinct().withColumn("property", F.explode(F.array(F.lit("eventType"), F.lit("k"))))
    return rules.node_findings(n, docs, m, {"V-12"})


@query("SELECT 'log' AS doc_id, count(*)::BIGINT AS n_nodes FROM events WHERE event_type = 'error' AND event_type <> 'view' HAVING count(*) > 0", graph=False)
def undeclared_shape(spark, d):
    n = _events_as_nodes(spark, d)
    docs, m = one_layer(spark, "log", n.where("label <> 'view'"))
    m.class_properties = n.where("label NOT IN ('error', 'view')").select(F.col("type").alias("class"), F.lit("k").alias("property")).distinct()
    return rules.undeclared_shape(n, docs, m)


@query(f"WITH {_EV} SELECT 'log' AS doc_id, 'V-14' AS rule_id, 'warning' AS severity, concat('event/', event_id) AS subject, 'eventType is not in event-type: error' AS message FROM ev WHERE event_type = 'error'", graph=False)
def value_sets(spark, d):
    n = _events_as_nodes(spark, d)
    docs, m = one_layer(spark, "log", n)
    kinds = n.select("type", "label").distinct()
    m.bindings = kinds.select(F.col("type").alias("class"), F.lit("eventType").alias("property"), F.lit("event-type").alias("value_set"), F.lit("warning").alias("severity"))
    m.codes = kinds.where("label <> 'error'").select(F.lit("event-type").alias("value_set"), F.col("label").alias("code"))
    return rules.node_findings(n, docs, m, {"V-14"})


@query("""SELECT 'log' AS doc_id, 'V-14' AS rule_id, concat('event/', event_id) AS subject, 'k is not in ks: ' || (event_id % 3) AS message FROM events WHERE event_id % 2 = 0 OR event_id % 3 = 2""", graph=False)
def value_types(spark, d):
    """V-14: a code is a text; the number that reads like it is not."""
    k = F.col("event_id") % 3
    n = read(spark, d, "events").select(F.lit("log").alias("doc_id"), F.concat(F.lit("event/"), "event_id").alias("id"), F.lit("event").alias("type"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"k":'), k.cast("string"), F.lit("}"))).otherwise(F.concat(F.lit('{"k":"'), k.cast("string"), F.lit('"}'))).alias("properties"))
    docs, m = one_layer(spark, "log", n.select("type").distinct())
    m.bindings = spark.createDataFrame([("event", "k", "ks", "error")], "class string, property string, value_set string, severity string")
    m.codes = spark.createDataFrame([("ks", "0"), ("ks", "1")], "value_set string, code string")
    return rules.node_findings(n, docs, m, {"V-14"}).select("doc_id", "rule_id", "subject", "message")


@query("SELECT 'orders' AS doc_id, 'V-15' AS rule_id, 'error' AS severity, concat('order/', o_orderkey) AS subject, 'identifier type: ' || o_orderpriority AS message FROM orders WHERE o_orderpriority NOT LIKE '1%' AND o_orderpriority NOT LIKE '2%'", graph=False)
def identifier_types(spark, d):
    o = read(spark, d, "orders")
    n = o.select(F.lit("orders").alias("doc_id"), F.concat(F.lit("order/"), "o_orderkey").alias("id"), F.lit("order").alias("type"), F.to_json(F.struct(F.array(F.struct(F.col("o_orderpriority").alias("type"), F.col("o_orderkey").cast("string").alias("value"))).alias("identifiers"))).alias("properties"))
    docs, m = one_layer(spark, "orders", n)
    m.codes = o.select("o_orderpriority").distinct().where("o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%'").select(F.lit("identifier-type").alias("value_set"), F.col("o_orderpriority").alias("code"))
    return rules.node_findings(n, docs, m, {"V-15"})


@query("SELECT 'web' AS doc_id, 'V-16' AS rule_id, 'error' AS severity, url AS subject, 'id has another shape than its class asks for' AS message FROM pages WHERE NOT regexp_matches(url, '^https?://[a-z.]+/[a-z]+/[0-9]+$')", graph=False)
def iri_shape(spark, d):
    n = read(spark, d, "pages").select(F.lit("web").alias("doc_id"), F.col("url").alias("id"), F.lit("page").alias("type"))
    docs, m = one_layer(spark, "web", n)
    m.classes = m.classes.withColumn("iri_pattern", F.lit("^https?://[a-z.]+/[a-z]+/[0-9]+$"))
    return rules.node_findings(n, docs, m, {"V-16"})


_SPACED = r"regexp_replace(regexp_replace(nfc_normalize(text), '[\t\n\x0B\f\r \x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]+', ' ', 'g'), '^ | $', '', 'g')"


@query(f"SELECT 'd' AS doc_id, CASE WHEN doc_id % 5 = 0 THEN 'V-17' ELSE 'V-18' END AS rule_id, CASE WHEN doc_id % 5 = 0 THEN 'warning' ELSE 'error' END AS severity, concat('doc/', doc_id) AS subject, CASE WHEN doc_id % 5 = 0 THEN 'content without a hash' ELSE 'hash is not that of the content' END AS message FROM documents WHERE text IS NOT NULL AND (doc_id % 5 = 0 OR sha256({_SPACED}) <> sha256(text))", graph=False)
def content_hash(spark, d):
    stored = F.when(F.col("doc_id") % 5 > 0, F.sha2("text", 256))
    n = read(spark, d, "documents").select(F.lit("d").alias("doc_id"), F.concat(F.lit("doc/"), "doc_id").alias("id"), F.lit("text").alias("type"), F.to_json(F.struct("text", stored.alias("contentHash"))).alias("properties"))
    docs, m = one_layer(spark, "d", n)
    m.content_fields = spark.createDataFrame([("text", 0, "text")], "class string, position int, property string")
    seen = m.seen()
    return rules.content_findings(rules.prepared_nodes(n, rules.checked_documents(docs, seen), seen))


def _graded(spark, d):
    """Orders as recommendations: priority is strength, status the direction, part of the key the kind."""
    kind = F.when(F.col("o_orderkey") % 3 == 0, "good-practice-statement").when(F.col("o_orderkey") % 3 == 1, "no-recommendation").otherwise("recommendation")
    body = F.to_json(F.struct(F.when(F.col("o_totalprice") > 150000, F.col("o_orderpriority")).alias("strength"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("direction"), kind.alias("kind")))
    return read(spark, d, "orders").select(F.lit("trade").alias("doc_id"), F.col("o_orderkey").alias("ord"), F.concat(F.lit("order/"), "o_orderkey").alias("id"), F.lit("recommendation").alias("type"), body.alias("properties"))


@query("""SELECT 'trade' AS doc_id, 'V-21' AS rule_id, 'error' AS severity, concat('order/', o_orderkey) AS subject, 'strength without direction' AS message FROM orders WHERE o_totalprice > 150000 AND o_orderpriority IS NOT NULL AND o_orderstatus = 'O'
UNION ALL SELECT 'trade', 'V-22', 'error', concat('order/', o_orderkey), CASE WHEN o_orderkey % 3 = 0 THEN 'good-practice-statement' ELSE 'no-recommendation' END || ' carries no grade, but: ' || concat_ws(', ', CASE WHEN o_totalprice > 150000 THEN 'strength' END, CASE WHEN o_orderkey % 3 = 1 AND o_orderstatus <> 'O' THEN 'direction' END) FROM orders WHERE (o_orderkey % 3 = 0 AND o_totalprice > 150000) OR (o_orderkey % 3 = 1 AND (o_totalprice > 150000 OR o_orderstatus <> 'O'))""", graph=False)
def grading_rules(spark, d):
    n = _graded(spark, d)
    return rules.node_findings(n, *one_layer(spark, "trade", n), {"V-21", "V-22"})


@query("""SELECT 'trade' AS doc_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'V-23' ELSE 'V-24' END AS rule_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'error' ELSE 'warning' END AS severity, concat('order/', o_orderkey) AS subject,
CASE WHEN c_mktsegment = 'BUILDING' THEN 'defined in a publication that was not reviewed' ELSE 'defined in a publication of unknown review' END AS message FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' OR c_acctbal < 0""", graph=False)
def parent_status(spark, d):
    status = F.when(F.col("c_mktsegment") == "BUILDING", "not-reviewed").when(F.col("c_acctbal") >= 0, "approved")
    pubs = read(spark, d, "customer").select(F.lit("party").alias("doc_id"), F.col("c_custkey").alias("ord"), F.concat(F.lit("customer/"), "c_custkey").alias("id"), F.lit("publication").alias("type"), F.to_json(F.struct(status.alias("grcStatus"))).alias("properties"))
    links = read(spark, d, "orders").select(F.lit("trade").alias("doc_id"), F.lit("definedIn").alias("predicate"), F.concat(F.lit("order/"), "o_orderkey").alias("source"), F.concat(F.lit("customer/"), "o_custkey").alias("target"))
    n = _graded(spark, d).unionByName(pubs)
    return rules.publication_findings(rules.near(links, n), n)


@query("""WITH s AS (SELECT p_partkey, unnest(['setting', 'timing', 'population', 'provider']) AS slot, unnest([split_part(p_name, ' ', 1), p_type, p_brand, p_partkey || ' ' || p_brand]) AS v,
lower(p_name || ' ' || CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END || ' ' || CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE '' END || ' ' || CASE WHEN p_partkey % 5 = 0 THEN p_partkey || ' ' || p_brand ELSE '' END) AS hay FROM part)
SELECT 'd' AS doc_id, 'V-25' AS rule_id, 'warning' AS severity, concat('part/', p_partkey) AS subject, slot || ' is not quoted from the source' AS message FROM s WHERE NOT contains(hay, lower(v))""", graph=False)
def quoted_slots(spark, d):
    p = read(spark, d, "part")
    row = lambda t, i, kind, ord_, **v: t.select(F.lit("d").alias("doc_id"), ord_.alias("ord"), i.alias("id"), F.lit(kind).alias("type"), F.to_json(F.struct(*[c.alias(k) for k, c in v.items()])).alias("properties"))
    link = lambda t, name, a, b: t.select(F.lit("d").alias("doc_id"), F.col("p_partkey").alias("ord"), F.lit(name).alias("predicate"), a.alias("source"), b.alias("target"))
    at = lambda kind: F.concat(F.lit(f"{kind}/"), "p_partkey")
    key, word = F.col("p_partkey"), F.split_part("p_name", F.lit(" "), F.lit(1))
    n = row(p, at("part"), "recommendation", key, statement=F.col("p_name"), setting=word, timing=F.col("p_type"), population=F.col("p_brand"), provider=F.concat_ws(" ", F.col("p_partkey"), "p_brand"))
    n = n.unionByName(row(p, at("note"), "remark", key, text=F.when(key % 2 == 0, F.col("p_brand")), caption=F.col("p_type")))
    n = n.unionByName(row(p, at("row"), "publication-element", key, caption=F.when(key % 3 == 0, F.col("p_type")), text=F.col("p_brand")))
    n = n.unionByName(row(p, at("table"), "publication-element", key, heading=F.when(key % 5 == 0, F.concat_ws(" ", F.col("p_partkey"), "p_brand"))))
    e = link(p, "hasRemark", at("part"), at("note")).unionByName(link(p, "presentedIn", at("part"), at("row"))).unionByName(link(p, "contains", at("table"), at("row")))
    return rules.slot_findings(rules.near(e, n), n)


@query("""WITH l AS (SELECT l_orderkey, min(CASE WHEN l_quantity < 10 THEN 1 WHEN l_quantity < 25 THEN 2 WHEN l_quantity < 40 THEN 3 ELSE 4 END) AS low FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT 'd' AS doc_id, 'V-26' AS rule_id, 'warning' AS severity, concat('order/', o_orderkey) AS subject, 'more certain than its least certain critical outcome' AS message FROM orders JOIN l ON l_orderkey = o_orderkey
WHERE CASE WHEN o_orderpriority LIKE '1%' THEN 4 WHEN o_orderpriority LIKE '2%' THEN 3 WHEN o_orderpriority LIKE '3%' THEN 2 END > low""", graph=False)
def lowest_of_critical(spark, d):
    level = F.when(F.col("o_orderpriority").startswith("1"), "high").when(F.col("o_orderpriority").startswith("2"), "moderate").when(F.col("o_orderpriority").startswith("3"), "low")
    recs = read(spark, d, "orders").select(F.lit("d").alias("doc_id"), F.concat(F.lit("order/"), "o_orderkey").alias("id"), F.lit("recommendation").alias("type"), F.to_json(F.struct(level.alias("overallCertainty"))).alias("properties"))
    li = read(spark, d, "lineitem").withColumn("c", F.when(F.col("l_quantity") < 10, "very-low").when(F.col("l_quantity") < 25, "low").when(F.col("l_quantity") < 40, "moderate").otherwise("high"))
    ev = li.select("c").distinct().select(F.lit("d").alias("doc_id"), F.concat(F.lit("certainty/"), "c").alias("id"), F.lit("evidence").alias("type"), F.to_json(F.struct(F.col("c").alias("certainty"))).alias("properties"))
    flags = li.select("l_returnflag").distinct()
    out = flags.select(F.lit("d").alias("doc_id"), F.concat(F.lit("flag/"), "l_returnflag").alias("id"), F.lit("outcome").alias("type"), F.to_json(F.struct(F.when(F.col("l_returnflag") == "R", "critical").otherwise("important").alias("importance"))).alias("properties"))
    ev_of = lambda c: F.concat(F.lit("certainty/"), c, F.lit("/"), F.col("l_returnflag"))
    ev = li.select("c", "l_returnflag").distinct().select(F.lit("d").alias("doc_id"), ev_of(F.col("c")).alias("id"), F.lit("evidence").alias("type"), F.to_json(F.struct(F.col("c").alias("certainty"))).alias("properties"))
    on = li.select(F.lit("d").alias("doc_id"), F.lit("supportedBy").alias("predicate"), F.concat(F.lit("order/"), "l_orderkey").alias("source"), ev_of(F.col("c")).alias("target")).distinct()
    of = li.select("c", "l_returnflag").distinct().select(F.lit("d").alias("doc_id"), F.lit("forOutcome").alias("predicate"), ev_of(F.col("c")).alias("source"), F.concat(F.lit("flag/"), "l_returnflag").alias("target"))
    n = recs.unionByName(ev).unionByName(out)
    return rules.certainty_findings(rules.near(on.unionByName(of), n), n)


@query("""SELECT DISTINCT 'd' AS doc_id, 'V-27' AS rule_id, 'error' AS severity, concat('line/', l_orderkey, '/', l_linenumber, '/', l_partkey, '/', l_suppkey) AS subject, 'stores a second copy of price' AS message FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R'""", graph=False)
def one_copy(spark, d):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]  # made distinct as numbers, once, before there are texts
    li, p = written(read(spark, d, "lineitem").groupBy(*keys).agg(F.first("l_extendedprice").alias("l_extendedprice"), F.max(F.coalesce(F.col("l_returnflag") == "R", F.lit(False))).alias("shown"))), read(spark, d, "part")
    row = F.concat_ws("/", F.lit("line"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    tables = p.select(F.lit("d").alias("doc_id"), F.concat(F.lit("part/"), "p_partkey").alias("id"), F.lit("publication-element").alias("type"), F.lit('{"elementType":"table","columns":["key","price"],"columnMap":{"price":"retail"}}').alias("properties"))
    rows = li.select(F.lit("d").alias("doc_id"), row.alias("id"), F.lit("element").alias("type"), F.to_json(F.struct(F.lit("data").alias("rowType"), F.array(F.lit(None).cast("string"), F.col("l_extendedprice").cast("string")).alias("cells")), {"ignoreNullFields": "false"}).alias("properties"))
    held = li.select(F.lit("d").alias("doc_id"), F.lit("contains").alias("predicate"), F.concat(F.lit("part/"), "l_partkey").alias("source"), row.alias("target"))
    shown = li.where("shown").select(F.lit("d").alias("doc_id"), F.lit("presentedIn").alias("predicate"), F.lit("x").alias("source"), row.alias("target"))
    n = tables.unionByName(rows)
    return rules.copy_findings(rules.near(held.unionByName(shown), n), n).distinct()


def _citing(spark, d):
    """Customers cite: numbered as their nation, which resolves to its region unless it is region 0."""
    c, n, r = read(spark, d, "customer"), read(spark, d, "nation"), read(spark, d, "region")
    node = lambda t, i, kind, ord_, **p: t.select(F.lit("d").alias("doc_id"), ord_.alias("ord"), i.alias("id"), F.lit(kind).alias("type"), F.to_json(F.struct(*[v.alias(k) for k, v in p.items()])).alias("properties"))
    cid, nid, rid = (F.concat(F.lit(f"{k}/"), F.col(col)) for k, col in (("customer", "c_custkey"), ("nation", "n_nationkey"), ("region", "r_regionkey")))
    nodes = node(c, cid, "citation", F.col("c_custkey"), text=F.when(F.col("c_custkey") % 50 != 0, F.col("c_name")), citationKind=F.when(F.col("c_mktsegment") == "MACHINERY", "placeholder").otherwise("reference"), resolutionStatus=F.when(F.col("c_acctbal") > 0, "resolved").otherwise("unresolved"))
    nodes = nodes.unionByName(node(n, nid, "reference-entry", F.col("n_nationkey").cast("long"), text=F.col("n_name"), resolutionStatus=F.when(F.col("n_nationkey") % 4 != 0, "resolved").otherwise("unresolved"))).unionByName(node(r, rid, "publication", F.col("r_regionkey").cast("long"), title=F.col("r_name")))
    edge = lambda t, p, a, b, o: t.select(F.lit("d").alias("doc_id"), o.alias("ord"), F.lit(p).alias("predicate"), a.alias("source"), b.alias("target"), F.lit("derived").alias("derivation"))
    edges = edge(c, "numberedAs", cid, F.concat(F.lit("nation/"), "c_nationkey"), F.col("c_custkey")).unionByName(edge(n.where("n_regionkey > 0"), "resolvesTo", nid, F.concat(F.lit("region/"), "n_regionkey"), F.col("n_nationkey").cast("long")))
    return nodes, edges


@query("""WITH c AS (SELECT *, c_acctbal > 0 AS res, coalesce(c_mktsegment = 'MACHINERY', false) AS mock FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT 'd' AS doc_id, 'V-28' AS rule_id, 'error' AS severity, concat('customer/', c_custkey) AS subject, 'a placeholder cannot be resolved' AS message FROM c WHERE mock AND res
UNION ALL SELECT 'd', 'V-29', 'error', concat('customer/', c_custkey), 'claims to be resolved and leads nowhere' FROM c WHERE NOT mock AND res AND NOT (n_regionkey > 0 AND n_nationkey % 4 <> 0)
UNION ALL SELECT 'd', 'V-29', 'error', concat('nation/', n_nationkey), 'claims to be resolved and leads nowhere' FROM nation WHERE n_nationkey % 4 <> 0 AND n_regionkey = 0
UNION ALL SELECT 'd', 'V-30', 'warning', concat('nation/', n_nationkey), 'leads to a source but is not marked resolved' FROM nation WHERE n_nationkey % 4 = 0 AND n_regionkey > 0
UNION ALL SELECT 'd', 'V-31', 'error', concat('customer/', c_custkey), 'no verbatim text' FROM c WHERE c_custkey % 50 = 0""", graph=False)
def citation_claims(spark, d):
    nodes, edges = _citing(spark, d)
    bare = rules.node_findings(nodes, *one_layer(spark, "d", nodes), {"V-31"})
    return rules.citation_findings(rules.near(edges, nodes), nodes).unionByName(bare)


@query("SELECT doc_id, predicate, count(*) FILTER (status = 'resolved')::BIGINT AS resolved, count(*) FILTER (status = 'unresolved')::BIGINT AS unresolved, count(*) FILTER (status = 'ambiguous')::BIGINT AS ambiguous FROM edges WHERE status IN ('resolved', 'unresolved', 'ambiguous') GROUP BY ALL")
def join_tally(spark, d):
    return rules.join_tally(bench_graph(spark, d)[1])


@query(_STATUS)
def join_status(spark, d):
    return _edge_rules(spark, d, "V-32", "V-34")


@query("SELECT 'x' AS doc_id, 'V-33' AS rule_id, 'error' AS severity, 'placedBy|' || 'order/' || o_orderkey || '|customer/' || o_custkey AS subject, 'resolved onto a node that is not' AS message FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F' AND c_acctbal < 0", graph=False)
def resolved_targets(spark, d):
    n = read(spark, d, "customer").select(F.lit("p").alias("doc_id"), F.col("c_custkey").alias("ord"), F.concat(F.lit("customer/"), "c_custkey").alias("id"), F.lit("customer").alias("type"), F.to_json(F.struct(F.when(F.col("c_acctbal") < 0, "unresolved").otherwise("resolved").alias("resolutionStatus"))).alias("properties"))
    e = read(spark, d, "orders").select(F.lit("x").alias("doc_id"), F.col("o_orderkey").alias("ord"), F.lit("placedBy").alias("predicate"), F.concat(F.lit("order/"), "o_orderkey").alias("source"), F.concat(F.lit("customer/"), "o_custkey").alias("target"), F.to_json(F.struct(F.when(F.col("o_orderstatus") == "F", "resolved").otherwise("unresolved").alias("resolutionStatus"))).alias("properties"))
    return rules.edge_findings(e, n, *one_layer(spark, "x", n), {"V-33"})


@query("""SELECT id, CASE k % 3 WHEN 0 THEN 'special' WHEN 2 THEN 'general' END AS type, k % 3 = 1 AS clash FROM (SELECT concat('customer/', c_custkey) AS id, c_custkey AS k FROM customer)""", graph=False)
def type_clash(spark, d):
    c = read(spark, d, "customer").withColumn("id", F.concat(F.lit("customer/"), "c_custkey"))
    second = F.when(F.col("c_custkey") % 3 == 1, "other").when(F.col("c_custkey") % 3 == 0, "special").otherwise("general")
    n = c.select(F.lit("a").alias("doc_id"), "id", F.lit("general").alias("type"), F.lit("{}").alias("properties")).union(c.select(F.lit("b"), "id", second, F.lit("{}")))
    m = bench_model(spark)
    m.classes = spark.createDataFrame([("x", "special", "general")], "layer string, id string, elaborates string")
    one, bad = rules.unify_nodes(n, m)
    return one.select("id", "type", F.lit(False).alias("clash")).unionByName(bad.select(F.col("subject").alias("id"), F.lit(None).cast("string").alias("type"), F.lit(True).alias("clash")))


@query(with_more(f"{_L}, {_LIC} {_UNLICENSED} UNION ALL {_QUALIFIED} UNION ALL {_EXPLAINED} UNION ALL {_NODES} UNION ALL {_STATUS}"))
def validation_report(spark, d):
    n, e = bench_graph(spark, d)
    return rules.validate(bench_documents(spark), n, e, bench_model(spark))


@query(with_more(f"""{_L}, {_LIC}, f AS ({_UNLICENSED} UNION ALL {_QUALIFIED} UNION ALL {_EXPLAINED} UNION ALL {_NODES} UNION ALL {_STATUS}),
tally AS (SELECT doc_id, count(*) FILTER (status = 'resolved') || '/' || count(*) FILTER (status = 'unresolved') || '/' || count(*) FILTER (status = 'ambiguous') AS joins FROM edges GROUP BY 1 HAVING count(*) FILTER (status IN ('resolved', 'unresolved', 'ambiguous')) > 0)
SELECT *, errors = 0 AS conforms FROM (SELECT d.doc_id, (SELECT count(*) FROM nodes n WHERE n.doc_id = d.doc_id)::BIGINT AS n_nodes, (SELECT count(*) FROM edges n WHERE n.doc_id = d.doc_id)::BIGINT AS n_edges,
(SELECT count(*) FROM f WHERE f.doc_id = d.doc_id AND severity = 'error')::BIGINT AS errors, (SELECT count(*) FROM f WHERE f.doc_id = d.doc_id AND severity = 'warning')::BIGINT AS warnings,
(SELECT string_agg(k || ':' || c, ' ' ORDER BY k) FROM (SELECT type AS k, count(*) AS c FROM nodes n WHERE n.doc_id = d.doc_id GROUP BY 1)) AS by_class, (SELECT string_agg(k || ':' || c, ' ' ORDER BY k) FROM (SELECT predicate AS k, count(*) AS c FROM edges n WHERE n.doc_id = d.doc_id GROUP BY 1)) AS by_predicate,
(SELECT joins FROM tally t WHERE t.doc_id = d.doc_id) AS joins, (SELECT count(*) FROM edges x JOIN nodes s ON s.id = x.source JOIN nodes t ON t.id = x.target WHERE x.doc_id = d.doc_id AND (s.doc_id <> d.doc_id OR t.doc_id <> d.doc_id))::BIGINT AS cross_document_edges,
(SELECT count(*) FROM nodes n WHERE n.doc_id = d.doc_id)::BIGINT AS undeclared_shape FROM (SELECT DISTINCT doc_id FROM nodes) d)"""))
def conformance_summary(spark, d):
    n, e = bench_graph(spark, d)
    docs, m = bench_documents(spark), bench_model(spark)
    flat = lambda c: F.array_join(F.transform(F.map_entries(c), lambda x: F.concat(x["key"], F.lit(":"), x["value"].cast("string"))), " ").alias(c)
    index = rules.indexed(n, m)
    ends = rules.stored_ends(e, n, m, index)
    out = rules.report(docs, rules.validate(docs, n, e, m, index=index, ends=ends), n, e, m, index, ends)
    return out.select("doc_id", "n_nodes", "n_edges", "errors", "warnings", "conforms", "cross_document_edges", "undeclared_shape", flat("by_class"), flat("by_predicate"), F.concat_ws("/", *[F.col("joins")[s].cast("string") for s in ("resolved", "unresolved", "ambiguous")]).alias("joins")).withColumn("joins", F.nullif("joins", F.lit("")))


@query(with_more(f"{_L}, {_LIC}, f AS ({_UNLICENSED} UNION ALL {_EXPLAINED} UNION ALL {_NODES}) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY rule_id, subject, message)::INT AS place FROM f) WHERE place <= 6"))
def top_findings(spark, d):
    nodes = rules.node_findings(bench_graph(spark, d)[0], bench_documents(spark), bench_model(spark), {"V-04", "V-19", "V-20"})
    return g.top_findings(nodes.unionByName(_edge_rules(spark, d, "V-07", "V-09", "V-10", "V-11")))


@query("""WITH c AS (SELECT *, concat('conv/', conv_id) AS d FROM conversations)
SELECT d AS doc_id, 'T1-01' AS rule_id, 'error' AS severity, concat('turn/', turn) AS subject, m AS message FROM (SELECT d, turn, unnest(list_filter([
CASE WHEN coalesce(text, '') = '' THEN 'label is missing' END, CASE WHEN role <> 'user' THEN 'unknown derivation' END], lambda x: x IS NOT NULL)) AS m FROM c)
UNION ALL SELECT d, 'T1-01', 'error', concat_ws('|', role || 'Of', concat('turn/', turn), CASE WHEN turn > 0 THEN concat('turn/', turn - 1) ELSE '' END), m FROM (SELECT *, unnest(list_filter([CASE WHEN turn = 0 THEN 'target is missing' END, CASE WHEN turn % 2 = 1 THEN 'inferred or decided without note and evidence' END], lambda x: x IS NOT NULL)) AS m FROM c)""", graph=False)
def shape_check(spark, d):
    c = read(spark, d, "conversations").select(F.concat(F.lit("conv/"), "conv_id").alias("doc_id"), "turn", "role", "text", F.lit(None).cast("string").alias("note"), F.lit(None).cast("struct<location:string>").alias("evidence"), F.lit("{}").alias("properties"))
    n = c.select("doc_id", F.concat(F.lit("turn/"), "turn").alias("id"), F.lit("turn").alias("type"), F.col("text").alias("label"), F.when(F.col("role") == "user", "derived").otherwise(F.col("role")).alias("derivation"), "note", "evidence", "properties")
    before = F.when(F.col("turn") > 0, F.concat(F.lit("turn/"), F.col("turn") - 1)).otherwise(F.lit(""))
    e = c.select("doc_id", F.concat("role", F.lit("Of")).alias("predicate"), F.concat(F.lit("turn/"), "turn").alias("source"), before.alias("target"), F.when(F.col("turn") % 2 == 1, "inferred").otherwise("derived").alias("derivation"), "note", "evidence", "properties")
    return rules.shape_findings(n, e)


@query("""SELECT 'M-01' AS rule_id, CAST(l_orderkey AS VARCHAR) AS subject, 'no such order' AS message FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey
UNION ALL SELECT 'M-03', l_orderkey || '|' || l_linenumber, 'declared ' || count(*) || ' times' FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""", graph=False)
def table_integrity(spark, d):
    li = read(spark, d, "lineitem")
    return fk_violations(li, read(spark, d, "orders").where("o_orderstatus <> 'P'"), {"l_orderkey": "o_orderkey"}, "M-01", "no such order").unionByName(duplicate_keys(li, ["l_orderkey", "l_linenumber"], "M-03"))


@query("""SELECT 'M-02' AS rule_id, o_orderpriority AS subject, 'edge uses an undeclared predicate' AS message FROM orders WHERE o_orderpriority NOT LIKE '1%' GROUP BY 2
UNION ALL SELECT 'M-03', 'flag|' || l_returnflag, 'declared ' || count(*) || ' times' FROM lineitem GROUP BY l_returnflag HAVING count(*) > 1
UNION ALL SELECT 'M-01', c_mktsegment, 'edge names an undeclared class' FROM customer GROUP BY 2 UNION ALL SELECT 'M-07', 'Thing', 'kind without a description'""", graph=False)
def model_check(spark, d):
    m = bench_model(spark)
    o, c = read(spark, d, "orders"), read(spark, d, "customer")
    m.licensed = o.join(c, o.o_custkey == c.c_custkey).select(F.lit("trade").alias("layer"), F.col("o_orderpriority").alias("predicate"), F.lit("order").alias("source"), F.col("c_mktsegment").alias("target"), F.lit(None).cast("string").alias("qualifier"), F.lit(None).cast("string").alias("min_derivation"))
    m.predicates = o.where("o_orderpriority LIKE '1%'").select(F.lit("trade").alias("layer"), F.col("o_orderpriority").alias("predicate"), F.lit(False).alias("open_qualifier")).distinct()
    m.codes = read(spark, d, "lineitem").select(F.lit("flag").alias("value_set"), F.col("l_returnflag").alias("code"))
    m.kinds = m.kinds.limit(0)
    m.layered = True
    return check_model(m)


# Joins


@query("SELECT p_name AS name, count(*) OVER (PARTITION BY p_name)::BIGINT AS matches, CASE WHEN count(*) OVER (PARTITION BY p_name) = 1 THEN 'resolved' ELSE 'ambiguous' END AS status, CASE WHEN count(*) OVER (PARTITION BY p_name) = 1 THEN p_partkey END AS match FROM part", graph=False)
def pool_match(spark, d):
    p = read(spark, d, "part")
    return g.match_by_name(p.select(F.col("p_name").alias("name")), p.select(F.col("p_name").alias("name"), "p_partkey"), "name", "p_partkey").select("name", "matches", "status", "match")


@query("SELECT c_custkey AS id, coalesce(k, 0)::BIGINT AS matches, CASE WHEN coalesce(k, 0) = 0 THEN 'unresolved' WHEN k = 1 THEN 'resolved' ELSE 'ambiguous' END AS status, CASE WHEN k = 1 THEN ref END AS match FROM customer LEFT JOIN (SELECT s_nationkey, count(*) AS k, min(s_suppkey) AS ref FROM supplier GROUP BY 1) ON s_nationkey = c_nationkey", graph=False)
def actor_match(spark, d):
    left = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    return g.match_by_name(left, read(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey"), "nation", "s_suppkey").select("id", "matches", "status", "match")


@query("SELECT o_orderkey AS id, coalesce(k, 0)::BIGINT AS matches, CASE WHEN coalesce(k, 0) = 0 THEN 'unresolved' WHEN k = 1 THEN 'resolved' ELSE 'ambiguous' END AS status FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS k FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON l_orderkey = o_orderkey", graph=False)
def task_match(spark, d):
    left = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    return g.match_by_name(left, read(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"), "l_partkey"), "id", "l_partkey").select("id", "matches", "status")


@query("""SELECT concat('supplier/', s_suppkey) AS source, 'locatedIn' AS predicate, concat('nation/', s_nationkey) AS middle, 'partOf' AS predicate_2, concat('region/', n_regionkey) AS "end", 1::BIGINT AS paths FROM supplier JOIN nation ON n_nationkey = s_nationkey""", graph=False)
def two_hops(spark, d):
    return g.two_hops(*bench_graph(spark, d), "supplier")


@query("SELECT DISTINCT concat('order/', o_orderkey) AS node_0, concat('customer/', o_custkey) AS node_1, concat('nation/', c_nationkey) AS node_2, concat('region/', n_regionkey) AS node_3 FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey", graph=False)
def trace_path(spark, d):
    return g.trace_path(bench_graph(spark, d)[1], ["placedBy", "locatedIn", "partOf"])


@query(with_more(f"{_L} SELECT sl AS source_layer, tl AS target_layer, predicate, source, target, count(*)::BIGINT AS n FROM el WHERE sl <> tl GROUP BY ALL"))
def cross_layer(spark, d):
    return g.cross_layer_edges(_layered(spark, d)[2]).groupBy("source_layer", "target_layer", "predicate", "source", "target").agg(F.count("*").alias("n"))


@query("SELECT id, type FROM nodes WHERE id NOT IN (SELECT target FROM edges)")
def unreferenced(spark, d):
    return g.unreferenced(*bench_graph(spark, d)).select("id", "type")


@query("SELECT predicate, source, target FROM edges e JOIN nodes n ON n.id = e.source WHERE n.type = 'nation'")
def leaf_check(spark, d):
    return g.leaf_violations(*bench_graph(spark, d), "nation").select("predicate", "source", "target")


@query("SELECT DISTINCT source AS id, target AS artifact, n.type FROM edges e JOIN nodes n ON n.id = e.source WHERE predicate = 'suppliedBy'")
def component_artifacts(spark, d):
    return g.component_artifacts(*bench_graph(spark, d), "suppliedBy")


@query("SELECT concat('customer/', c_custkey) AS target, 'customer' AS target_type, 'placedBy' AS predicate, concat('order/', o_orderkey) AS source FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal <= 0", graph=False)
def undefined_refs(spark, d):
    n = read(spark, d, "customer").select(F.concat(F.lit("customer/"), "c_custkey").alias("id"), F.lit("customer").alias("type"), F.when(F.col("c_acctbal") > 0, F.lit('{"resolutionStatus":"resolved"}')).otherwise(F.lit("{}")).alias("properties"))
    return g.undefined_references(n, bench_graph(spark, d)[1].where("predicate = 'placedBy'"), ["customer"])


@query("SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)", graph=False)
def missing_borrowed_parts(spark, d):
    return missing_borrowed(read(spark, d, "lineitem").select(F.col("l_partkey").alias("id")), read(spark, d, "part").where("p_size <= 25").select(F.col("p_partkey").alias("id")))


@query(with_more("decl AS (SELECT unnest(['partOf', 'locatedIn', 'placedBy', 'contains', 'supersedes', 'refines']) AS predicate) SELECT predicate FROM decl WHERE predicate NOT IN (SELECT predicate FROM edges)"))
def unused_predicates(spark, d):
    return g.unused(bench_model(spark).predicates, bench_graph(spark, d)[1], "predicate")


# Counts


@query("SELECT doc_id, type, count(*)::BIGINT AS n FROM nodes GROUP BY ALL")
def class_counts(spark, d):
    return g.counts(bench_graph(spark, d)[0], "doc_id", "type")


@query("SELECT doc_id, predicate, count(*)::BIGINT AS n FROM edges GROUP BY ALL")
def predicate_counts(spark, d):
    return g.counts(bench_graph(spark, d)[1], "doc_id", "predicate")


@query("SELECT predicate, count(*)::BIGINT AS n FROM edges GROUP BY ALL ORDER BY n DESC, predicate")
def edges_per_predicate(spark, d):
    return g.ranked(g.counts(bench_graph(spark, d)[1], "predicate"), [F.desc("n"), F.col("predicate")])


@query("SELECT e.doc_id, count(*) FILTER (s.doc_id <> e.doc_id OR t.doc_id <> e.doc_id)::BIGINT AS n FROM edges e JOIN nodes s ON s.id = e.source JOIN nodes t ON t.id = e.target GROUP BY ALL")
def cross_document_edges(spark, d):
    n, e = bench_graph(spark, d)
    return g.cross_document_count(rules.with_endpoints(e, n))


@query("SELECT t AS type, (SELECT count(*) FROM nodes n WHERE n.type = t)::BIGINT AS n FROM (SELECT unnest(['region', 'nation', 'customer', 'supplier', 'part', 'order', 'invoice']) AS t)")
def component_coverage(spark, d):
    kinds = bench_model(spark).classes.select(F.col("id").alias("type")).union(spark.createDataFrame([("invoice",)], "type string"))
    return g.coverage_of(kinds, bench_graph(spark, d)[0], "type")


@query("SELECT n_name AS name, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal < 0)::BIGINT AS n FROM nation ORDER BY n DESC, name", graph=False)
def type_coverage(spark, d):
    n = read(spark, d, "nation")
    poor = read(spark, d, "supplier").where("s_acctbal < 0").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("name"))
    return g.ranked(g.coverage_of(n.select(F.col("n_name").alias("name")), poor, "name"), [F.desc("n"), F.col("name")])


@query("SELECT path FROM (SELECT url || CASE page_id % 4 WHEN 0 THEN '.bpmn' WHEN 1 THEN '.layout.bpmn' WHEN 2 THEN '.dmn' ELSE '.txt' END AS path, page_id FROM pages) WHERE page_id % 4 IN (0, 2) AND page_id % 3 <> 0", graph=False)
def orphans(spark, d):
    kind = F.element_at(F.array(*[F.lit(x) for x in (".bpmn", ".layout.bpmn", ".dmn", ".txt")]), (F.col("page_id") % 4 + 1).cast("int"))
    files = read(spark, d, "pages").select(F.concat("url", kind).alias("path"), "page_id")
    return g.orphan_files(files, files.where("page_id % 3 = 0")).select("path")


@query("SELECT layer, count(DISTINCT type)::BIGINT AS n FROM nodes GROUP BY ALL ORDER BY layer")
def layer_counts(spark, d):
    return g.ranked(g.counts(bench_graph(spark, d)[0].select("layer", "type").distinct(), "layer"), [F.col("layer")])


@query("SELECT DISTINCT type, label FROM nodes")
def kind_names(spark, d):
    return g.names_per_kind(bench_graph(spark, d)[0], "type", "label")


@query("SELECT source AS kit, target AS component, qualifier, n.type, n.layer, count(*)::BIGINT AS n FROM edges e JOIN nodes n ON n.id = e.target WHERE predicate = 'contains' GROUP BY ALL")
def kit_components(spark, d):
    n, e = bench_graph(spark, d)
    return g.kit_components(n, e, "contains").groupBy("kit", "component", "qualifier", "type", "layer").agg(F.count("*").alias("n"))


@query(with_more("""l AS (SELECT source, target, CASE WHEN qualifier IS NULL THEN predicate ELSE predicate || ' (' || qualifier || ')' END AS label, min(doc_id || lpad(ord::VARCHAR, 15, '0')) AS place FROM edges GROUP BY ALL)
SELECT source, target, string_agg(label, ', ' ORDER BY place, label) AS labels FROM l GROUP BY ALL"""))
def parallel_edges(spark, d):
    return g.merge_parallel(bench_graph(spark, d)[1])


@query(with_more(f"""{_L}, x AS (SELECT layer, count(*) AS a, 0 AS b FROM nodes GROUP BY 1 UNION ALL SELECT sl, 0, count(*) FROM el GROUP BY 1) SELECT layer, sum(a)::BIGINT AS n_nodes, sum(b)::BIGINT AS n_edges FROM x GROUP BY ROLLUP (layer)"""))
def layer_totals(spark, d):
    n, _, layered = _layered(spark, d)
    return g.layer_totals(n, layered)


# Questions


_REACH = "reach(seed, node) AS (SELECT o_orderkey, o_orderkey FROM orders UNION ALL SELECT seed, nx FROM reach JOIN (SELECT o_orderkey AS cur, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nx FROM orders) ON cur = node WHERE nx IS NOT NULL)"


@query(f"""WITH RECURSIVE {_REACH}, all_ AS (SELECT seed, 'visited' AS relation, node, CAST(NULL AS BIGINT) AS p FROM reach UNION SELECT seed, 'supersededBy', node, NULL FROM reach WHERE seed <> node UNION SELECT seed, 'implementedBy', l_orderkey, l_partkey FROM reach JOIN lineitem ON l_orderkey = node)
SELECT seed_id AS seed, relation, count(*)::BIGINT AS n, bit_xor(('0x' || substr(md5(target), 1, 15))::BIGINT) AS x FROM (SELECT DISTINCT concat('order/', seed) AS seed_id, relation, CASE WHEN relation = 'implementedBy' THEN concat('part/', p) ELSE concat('order/', node) END AS target FROM all_) GROUP BY ALL""", graph=False)
def impact(spark, d):
    _, e = bench_graph(spark, d)
    e = e.where("predicate IN ('supersedes', 'contains')").withColumn("predicate", F.when(F.col("predicate") == "contains", "implementedBy").otherwise(F.col("predicate")))
    seeds = read(spark, d, "orders").select(F.concat(F.lit("order/"), "o_orderkey").alias("seed"))
    mark = F.conv(F.substring(F.md5("target"), 1, 15), 16, 10).cast("long")
    return questions.impact_of_all(e, seeds).groupBy("seed", "relation").agg(F.count("*").alias("n"), F.bit_xor(mark).alias("x"))


@query("SELECT concat('order/', o_orderkey) AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)", graph=False)
def coverage(spark, d):
    return questions.uncovered(*bench_graph(spark, d), "order", "contains")


@query("SELECT concat('order/', o_orderkey) AS id, CASE WHEN max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) = 1 THEN 'cited' WHEN count(l_orderkey) > 0 THEN 'placeholder' ELSE 'none' END AS state FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag <> 'N') ON l_orderkey = o_orderkey GROUP BY o_orderkey", graph=False)
def citation_states(spark, d):
    rule = read(spark, d, "orders").select(F.concat(F.lit("order/"), "o_orderkey").alias("id"), F.lit("dmn-rule").alias("type"), F.lit("{}").alias("properties"))
    flags = read(spark, d, "lineitem").select("l_returnflag").distinct().where("l_returnflag <> 'N'")
    cites = flags.select(F.col("l_returnflag").alias("id"), F.lit("citation").alias("type"), F.to_json(F.struct(F.when(F.col("l_returnflag") == "R", "reference").otherwise("placeholder").alias("citationKind"))).alias("properties"))
    links = read(spark, d, "lineitem").select(F.lit("citesSource").alias("predicate"), F.concat(F.lit("order/"), "l_orderkey").alias("source"), F.col("l_returnflag").alias("target"))
    return questions.rule_citation_states(rule.unionByName(cites), links)


@query("""WITH c AS (SELECT * FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT concat('customer/', c_custkey) AS seed, CASE WHEN n_regionkey = 1 THEN 'lost/1' WHEN n_regionkey > 1 THEN concat('region/', n_regionkey) END AS target, 2::BIGINT AS steps FROM c
UNION ALL SELECT concat('nation/', n_nationkey), CASE WHEN n_regionkey = 1 THEN 'lost/1' WHEN n_regionkey > 1 THEN concat('region/', n_regionkey) END, 1 FROM nation WHERE n_regionkey > 0
UNION ALL SELECT concat('nation/', n_nationkey), NULL, 1 FROM nation WHERE n_regionkey = 0 UNION ALL SELECT concat('region/', r_regionkey), NULL, 0 FROM region""", graph=False)
def resolve_chain(spark, d):
    """Nations of region 0 are numbered as themselves (a cycle), those of region 1 resolve to an id without a node, regions have no step."""
    nodes, edges = _citing(spark, d)
    n = read(spark, d, "nation")
    loop = n.where("n_regionkey = 0").select(F.lit("d").alias("doc_id"), F.col("n_nationkey").cast("long").alias("ord"), F.lit("numberedAs").alias("predicate"), F.concat(F.lit("nation/"), "n_nationkey").alias("source"), F.concat(F.lit("nation/"), "n_nationkey").alias("target"), F.lit("derived").alias("derivation"))
    edges = edges.withColumn("target", F.when(F.col("target") == "region/1", "lost/1").otherwise(F.col("target"))).unionByName(loop)
    seeds = nodes.select(F.col("id").alias("seed"))
    steps, ends = questions.resolve_citation(nodes, edges, seeds)
    return ends.join(steps.groupBy("seed").agg(F.count("*").alias("steps")), "seed", "left").select("seed", "target", F.coalesce("steps", F.lit(0)).cast("long").alias("steps"))


@query(with_more("""a AS (SELECT DISTINCT target AS seed, source AS node FROM edges WHERE predicate = 'partOf'), b AS (SELECT DISTINCT a.seed, e.source AS node FROM a JOIN edges e ON e.target = a.node AND e.predicate = 'locatedIn'),
c AS (SELECT DISTINCT b.seed, e.source AS node FROM b JOIN edges e ON e.target = b.node AND e.predicate = 'placedBy')
SELECT seed, node, 1 AS depth FROM a UNION ALL SELECT seed, node, 2 FROM b UNION ALL SELECT seed, node, 3 FROM c"""))
def dependents(spark, d):
    n, e = bench_graph(spark, d)
    return questions.dependents(e, n.where("type = 'region'").select(F.col("id").alias("seed")), ["partOf", "locatedIn", "placedBy"])


# Retrieval


@query("""SELECT id, (n - 1) // 50 AS part, count(*)::BIGINT AS n_edges FROM (SELECT id, row_number() OVER (PARTITION BY id) AS n FROM (SELECT source AS id FROM edges UNION ALL SELECT target FROM edges)) GROUP BY ALL
UNION ALL SELECT id, 0, 0 FROM nodes WHERE id NOT IN (SELECT source FROM edges) AND id NOT IN (SELECT target FROM edges)""")
def unit_split(spark, d):
    units = retrieval.retrieval_units(*bench_graph(spark, d))
    return units.select("id", F.col("part").cast("long").alias("part"), F.coalesce(F.size("edges"), F.lit(0)).cast("long").alias("n_edges")).withColumn("n_edges", F.greatest("n_edges", F.lit(0)))


@query("""SELECT n.id, n.label, count(*)::BIGINT AS n_edges, count(DISTINCT x.other_label)::BIGINT AS n_labels FROM nodes n JOIN (
SELECT e.source AS id, t.label AS other_label FROM edges e LEFT JOIN nodes t ON t.id = e.target UNION ALL SELECT e.target, s.label FROM edges e LEFT JOIN nodes s ON s.id = e.source) x ON x.id = n.id GROUP BY ALL""")
def retrieval_units(spark, d):
    n, e = bench_graph(spark, d)
    packed = retrieval.retrieval_units(n, e).select("id", "label", F.explode("edges").alias("e"))
    return packed.groupBy("id", "label").agg(F.count("*").alias("n_edges"), F.count_distinct("e.other_label").alias("n_labels"))


@query("SELECT doc_id AS id, CASE WHEN doc_id % 11 = 0 THEN 'source is gone' ELSE 'source changed' END AS why FROM documents WHERE doc_id % 7 = 0 OR doc_id % 11 = 0", graph=False)
def staleness(spark, d):
    docs = read(spark, d, "documents")
    pinned = docs.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("source"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("hash"))
    now = docs.where("doc_id % 11 <> 0").select(F.col("doc_id").alias("source"), F.sha2(F.when(F.col("doc_id") % 7 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit("!"))).otherwise(F.coalesce("text", F.lit(""))), 256).alias("hash"))
    return retrieval.stale_units(pinned, now).select("id", "why")


@query("""SELECT DISTINCT 'customer/' || c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN 'model changed' WHEN c_custkey % 7 = 0 THEN 'source changed' END AS why FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 7 = 0""", graph=False)
def version_staleness(spark, d):
    """R-04 from units to what is stale: a document a customer, made with version 1 or, every fifth, with another."""
    c = read(spark, d, "customer")
    n = c.select(F.concat(F.lit("d/"), "c_custkey").alias("doc_id"), F.lit(0).alias("ord"), F.concat(F.lit("customer/"), "c_custkey").alias("id"), F.lit("customer").alias("type"), F.col("c_name").alias("label"), F.lit("{}").alias("properties"), F.lit("derived").alias("derivation"))
    e = n.select("doc_id", F.lit("knows").alias("predicate"), F.col("id").alias("source"), F.lit("customer/1").alias("target"), F.lit(None).cast("string").alias("qualifier"), F.lit("derived").alias("derivation"), F.lit(None).cast("string").alias("note"))
    hashed = lambda text: F.sha2(text, 256)
    docs = c.select(F.concat(F.lit("d/"), "c_custkey").alias("doc_id"), F.when(F.col("c_custkey") % 5 == 0, "0").otherwise("1").alias("ontology_version"), F.array(F.struct(F.concat(F.lit("f"), "c_custkey").alias("path"), hashed(F.col("c_name")).alias("sha256"))).alias("sources"))
    now = c.select(F.concat(F.lit("f"), "c_custkey").alias("source"), hashed(F.when(F.col("c_custkey") % 7 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name"))).alias("hash"))
    return retrieval.stale_units(retrieval.pinned_sources(retrieval.retrieval_units(n, e, documents=docs)), now, "1").select("id", "why").distinct()


# Snapshots


def _snapshots(spark, d):
    a = read(spark, d, "orders")
    b = a.where("o_orderkey % 10 <> 3").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 10 == 5, F.lit("X")).otherwise(F.col("o_orderstatus")))
    return a.where("o_orderkey % 10 <> 4"), b


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN 'gone' WHEN o_orderkey % 10 = 4 THEN 'added' ELSE 'changed' END AS change FROM orders WHERE o_orderkey % 10 IN (3, 4, 5)", graph=False)
def snapshot_nodes(spark, d):
    a, b = _snapshots(spark, d)
    return changes(normalise(a, [], ["o_comment"]), normalise(b, [], ["o_comment"]), ["o_orderkey"], ["o_orderstatus", "o_totalprice", "o_orderpriority", "o_custkey"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN 'removed' ELSE 'added' END AS change FROM orders WHERE o_orderkey % 10 IN (3, 4)", graph=False)
def snapshot_keys(spark, d):
    return g.added_removed(*_snapshots(spark, d), ["o_orderkey"])


@query("""WITH k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS n FROM lineitem) WHERE n = 1)
SELECT l_orderkey, l_partkey, 'l_returnflag' AS field, l_returnflag AS old, 'Z' AS new FROM k WHERE l_partkey % 10 = 0""", graph=False)
def snapshot_edges(spark, d):
    keys = ["l_orderkey", "l_partkey"]
    a = last_per_key(read(spark, d, "lineitem"), keys, ["l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"])
    b = a.withColumn("l_returnflag", F.when(F.col("l_partkey") % 10 == 0, F.lit("Z")).otherwise(F.col("l_returnflag")))
    return field_changes(a, b, keys, ["l_returnflag", "l_linestatus"])


@query("SELECT doc_id, 1 AS position, sha256(text) AS old, CASE WHEN doc_id % 2 = 0 THEN sha256(text || '!') END AS new FROM documents WHERE doc_id % 3 = 0 AND text IS NOT NULL", graph=False)
def snapshot_sources(spark, d):
    t = read(spark, d, "documents")
    a = t.select("doc_id", F.array(F.sha2("lang", 256), F.sha2("text", 256)).alias("hashes"))
    edited = F.array(F.sha2("lang", 256), F.sha2(F.concat("text", F.lit("!")), 256))
    b = t.select("doc_id", F.when(F.col("doc_id") % 3 > 0, F.array(F.sha2("lang", 256), F.sha2("text", 256))).when(F.col("doc_id") % 2 == 0, edited).otherwise(F.array(F.sha2("lang", 256))).alias("hashes"))
    return diff_sources(a, b)


@query("SELECT doc_id, 'source' AS field, source AS old, 'x' AS new FROM documents WHERE doc_id % 9 = 0", graph=False)
def snapshot_documents(spark, d):
    a = read(spark, d, "documents")
    return diff_documents(a, a.withColumn("source", F.when(F.col("doc_id") % 9 == 0, F.lit("x")).otherwise(F.col("source"))), "doc_id", ["lang", "source"])
