"""Extraction, export and model checks over files that Spark writes out of the trade tables, each beside the SQL that says what must come out."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from graphloom.functions import ids
from graphloom.model import check_model, make_model
from graphloom.operators import coverage, extraction, markup, retrieval, rules, shorthand
from graphloom.operators.frontier import WRITTEN, let_go, remove_between, shared_folder, written
from graphloom.plans.bench_graph import VERSION, bench_documents, bench_graph, bench_model, graph_sql, one_layer, read
from graphloom.sources import documents

QUERIES: dict = {}
SQL: dict[str, str] = {}
NS = "https://example.org/kit"


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


def _dealt(spark, t):
    """Rows over all tasks: a table of a few MB on disk is one task or two, whatever is made of its rows."""
    return t.repartition(4 * spark.sparkContext.defaultParallelism)


def _files(spark, d, table, path, text):
    """(path, text): a file for each row of a table, by SQL expressions."""
    return _dealt(spark, read(spark, d, table)).select(F.expr(path).alias("path"), F.expr(text).alias("text"))


# Process files


_BPMN = """concat('<bpmn:definitions targetNamespace="', CASE WHEN c_custkey % 2 = 0 THEN 'http://example.org/kit/bpmn' ELSE 'https://other.org/x/' END, '" exporter="E" id="Def', c_custkey, '">', CASE WHEN c_custkey % 3 > 0 THEN concat('<bpmn:participant id="P', c_custkey, '" name="', c_name, ' &amp; sons" processRef="R', c_custkey, '"/>') ELSE '' END,
'<bpmn:process id="R', c_custkey, '" isExecutable="', CASE WHEN c_custkey % 4 = 0 THEN 'true' ELSE 'false' END, '"><bpmn:task id="T', c_custkey, '" name="', c_mktsegment, '"/><bpmn:subProcess id="S', c_custkey, '"><bpmn:userTask id="U', c_custkey, '"/><bpmn:exclusiveGateway id="G', c_custkey, '"/></bpmn:subProcess>',
'<bpmn:sequenceFlow id="F', c_custkey, '" name="', CASE WHEN c_custkey % 2 = 0 THEN 'yes' ELSE '' END, '"', CASE WHEN c_custkey % 7 = 0 THEN ' x="conditionExpression"' ELSE '' END, ' sourceRef="T', c_custkey, '" targetRef="S', c_custkey, '">', CASE WHEN c_custkey % 5 = 0 THEN '<bpmn:conditionExpression>x</bpmn:conditionExpression>' ELSE '' END, '</bpmn:sequenceFlow></bpmn:process><bpmn:messageFlow id="M', c_custkey, '" sourceRef="U', c_custkey, '" targetRef="', CASE WHEN c_custkey % 9 = 0 THEN 'gone' ELSE concat('T', c_custkey) END, '"/></bpmn:definitions>')"""


def _processes(spark, d):
    return _files(spark, d, "customer", "concat('in/c', c_custkey, '.bpmn')", _BPMN)


def _people(spark, d):
    """Titles of actors: none for a fourth of the customers, two of one title for another."""
    return read(spark, d, "customer").where("c_custkey % 4 > 0").select(F.concat("c_name", F.lit(" & sons")).alias("title"), F.explode(F.expr("CASE WHEN c_custkey % 4 = 1 THEN array('a.fsh', 'b.fsh') ELSE array('a.fsh') END")).alias("source"))


#: The scope that a customer's file names, as SQL.
_BPMN_SQL = """c AS (SELECT *, ns || '/artifact/Def' || k AS f, 'in/c' || k || '.bpmn' AS path, CASE k % 4 WHEN 0 THEN 'unresolved' WHEN 1 THEN 'ambiguous' ELSE 'resolved' END AS status, ns || '/persona/' || regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS person
  FROM (SELECT c_custkey AS k, c_mktsegment AS seg, c_name || ' & sons' AS title, CASE WHEN c_custkey % 2 = 0 THEN 'https://example.org/kit' ELSE 'https://other.org/x' END AS ns FROM customer))"""


@query(f"""WITH {_BPMN_SQL},
n AS (SELECT k, f AS a, 'bpmn-definitions' AS b, 'Def' || k AS c, 'derived' AS derivation, json_object('id', 'Def' || k, 'source', path, 'targetNamespace', CASE WHEN k % 2 = 0 THEN 'http://example.org/kit/bpmn' ELSE 'https://other.org/x/' END, 'exporter', 'E', 'exporterVersion', NULL) AS p FROM c
  UNION ALL SELECT k, f || '#P' || k, 'bpmn-participant', title, 'derived', json_object('id', 'P' || k, 'name', title, 'processRef', 'R' || k) FROM c WHERE k % 3 > 0
  UNION ALL SELECT k, person, 'persona', title, 'inferred', json_object('title', title, 'resolutionStatus', status) FROM c WHERE k % 3 > 0 AND status <> 'resolved'
  UNION ALL SELECT k, f || '#R' || k, 'bpmn-process', 'R' || k, 'derived', json_object('id', 'R' || k, 'name', NULL, 'isExecutable', k % 4 = 0) FROM c
  UNION ALL SELECT k, f || '#T' || k, 'bpmn-task', seg, 'derived', json_object('id', 'T' || k, 'name', seg, 'taskType', 'task', 'isSubProcess', false) FROM c
  UNION ALL SELECT k, f || '#S' || k, 'bpmn-task', 'S' || k, 'derived', json_object('id', 'S' || k, 'name', NULL, 'taskType', 'subProcess', 'isSubProcess', true) FROM c
  UNION ALL SELECT k, f || '#U' || k, 'bpmn-task', 'U' || k, 'derived', json_object('id', 'U' || k, 'name', NULL, 'taskType', 'userTask', 'isSubProcess', false, 'parent', f || '#S' || k) FROM c
  UNION ALL SELECT k, f || '#G' || k, 'bpmn-gateway', 'G' || k, 'derived', json_object('id', 'G' || k, 'name', NULL, 'gatewayType', 'exclusive', 'parent', f || '#S' || k) FROM c),
e AS (SELECT k, 'contains' AS what, f AS a, f || '#R' || k AS b, NULL AS c, 'derived' AS derivation, NULL AS p FROM c UNION ALL SELECT k, 'contains', f, f || '#P' || k, NULL, 'derived', NULL FROM c WHERE k % 3 > 0
  UNION ALL SELECT k, 'contains', f || '#R' || k, f || '#' || x || k, NULL, 'derived', NULL FROM c, (VALUES ('T'), ('S')) v(x) UNION ALL SELECT k, 'contains', f || '#S' || k, f || '#' || x || k, NULL, 'derived', NULL FROM c, (VALUES ('U'), ('G')) v(x)
  UNION ALL SELECT k, 'performedBy', f || '#P' || k, person, NULL, 'inferred', json_object('resolutionStatus', status, 'matchedOn', 'name of the pool = title of the actor') FROM c WHERE k % 3 > 0
  UNION ALL SELECT k, 'flowsTo', f || '#T' || k, f || '#S' || k, CASE WHEN k % 2 = 0 THEN 'yes' END, 'derived', json_object('flowId', 'F' || k, 'hasConditionExpression', k % 7 = 0) FROM c
  UNION ALL SELECT k, 'messageTo', f || '#U' || k, f || '#' || CASE WHEN k % 9 = 0 THEN 'gone' ELSE 'T' || k END, NULL, 'derived', json_object('flowId', 'M' || k) FROM c)
SELECT c.ns || '/kg/l2-bpmn/' || c.path AS doc_id, 'node' AS what, a, b, n.c, derivation, p::VARCHAR AS properties FROM n JOIN c USING (k) UNION ALL SELECT c.ns || '/kg/l2-bpmn/' || c.path, what, a, b, e.c, derivation, p::VARCHAR FROM e JOIN c USING (k)""")
def process_graph(spark, d):
    g = extraction.processes(_processes(spark, d), _people(spark, d))
    about = F.when(F.col("type") == "bpmn-definitions", F.regexp_replace("properties", '"sha256":"[0-9a-f]{64}",', "")).otherwise(F.col("properties"))
    n = g.nodes.select("doc_id", F.lit("node").alias("what"), F.col("id").alias("a"), F.col("type").alias("b"), F.col("label").alias("c"), "derivation", about.alias("properties"))
    return n.unionByName(g.edges.select("doc_id", F.col("predicate").alias("what"), F.col("source").alias("a"), F.col("target").alias("b"), F.col("qualifier").alias("c"), "derivation", "properties"))


@query("""SELECT 'F' || c_custkey AS flow_id, 'flowsTo' AS predicate, 'T' || c_custkey AS source, CASE WHEN c_custkey % 2 = 0 THEN 'yes' END AS qualifier, c_custkey % 7 = 0 AS conditional FROM customer
UNION ALL SELECT 'M' || c_custkey, 'messageTo', 'U' || c_custkey, NULL, false FROM customer""")
def process_flows(spark, d):
    return markup.flows(_processes(spark, d)).select("flow_id", "predicate", "source", "qualifier", "conditional")


@query("SELECT 'in/c' || c_custkey || '.bpmn' AS path, 'R' || c_custkey AS id FROM customer WHERE c_custkey % 3 = 0")
def unowned_processes(spark, d):
    return markup.unowned_processes(_processes(spark, d)).select("path", "id")


# Decision files


_DMN = """concat('<definitions namespace="', CASE WHEN o_orderkey % 2 = 0 THEN 'http://example.org/kit/dmn/' ELSE 'https://other.org/x' END, '"><decision label="Order" id="D', o_orderkey, '"><question>', o_orderstatus, ' &lt; 3?</question><usingTask href="in/x.bpmn#', o_orderpriority, '%20%2B"/><decisionTable id="T', o_orderkey, '"', CASE WHEN o_orderkey % 2 = 0 THEN ' hitPolicy="FIRST"' ELSE '' END,
'><input id="i" label="Status"><inputExpression typeRef="string"><text>', o_orderstatus, '</text></inputExpression></input><output id="o1" label="Action"/><output id="o2" label="', CASE WHEN o_orderkey % 3 = 0 THEN 'Reference' ELSE 'Source' END, '"><description>', CASE WHEN o_orderkey % 3 = 1 THEN 'Reference for the source content (L1)' ELSE 'plain' END, '</description></output>',
'<rule id="r1"><inputEntry><text>1</text></inputEntry><outputEntry><text>', o_orderpriority, '</text></outputEntry>', CASE WHEN o_orderkey % 2 = 0 THEN concat('<annotationEntry><text>Book ', o_custkey, ' (', o_orderkey, ')\n[later]\n-</text></annotationEntry>') ELSE '' END, '</rule><rule id="r2"><inputEntry><text>2</text></inputEntry><outputEntry><text>wait</text></outputEntry></rule></decisionTable></decision></definitions>')"""


def _decisions(spark, d):
    return _files(spark, d, "orders", "concat('d', o_orderkey, '.dmn')", _DMN)


def _tasks(spark, d):
    """Tasks that decisions are invoked by: one of the name 1-URGENT +, two of the name 2-HIGH +."""
    each = "inline(filter(array(struct(0, '1-URGENT +', 'urn:task/1'), struct(1, '2-HIGH +', 'urn:task/2'), struct(1, '2-HIGH +', 'urn:task/3')), x -> x.col1 = r_regionkey)) AS (k, name, task)"
    return read(spark, d, "region").selectExpr(each).select("name", "task")


def _decided(spark, d, files):
    """Documents of decision files and of what they cite, from one parse."""
    parsed = extraction.parsed_decisions(files)
    return extraction.union(extraction.decisions(files, _tasks(spark, d), parsed=parsed), extraction.citations(files, parsed=parsed))


_DMN_SQL = r"""o AS (SELECT *, ns || '/artifact/D' || k AS f, 'd' || k || '.dmn' AS path, k % 3 < 2 AS referred, 'Book ' || cust || ' (' || k || ')' AS book, CASE prio WHEN '1-URGENT' THEN 'resolved' WHEN '2-HIGH' THEN 'ambiguous' ELSE 'unresolved' END AS status,
  CASE WHEN prio = '1-URGENT' THEN 'urn:task/1' ELSE ns || '/artifact/x.bpmn#' || prio || '%20%2B' END AS task
  FROM (SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS st, o_orderpriority AS prio, CASE WHEN o_orderkey % 2 = 0 THEN 'https://example.org/kit' ELSE 'https://other.org/x' END AS ns, CASE WHEN o_orderkey % 3 = 0 THEN 'Reference' ELSE 'Source' END AS l, CASE WHEN o_orderkey % 3 = 1 THEN 'Reference for the source content (L1)' ELSE 'plain' END AS descr FROM orders)),
cited AS (SELECT o.*, x.t AS cite FROM o, unnest([book, '[later]']) x(t) WHERE k % 2 = 0 AND referred)"""


@query(f"""WITH {_DMN_SQL},
n AS (SELECT k, f AS a, 'dmn-definitions' AS b, 'Order' AS c, 'derived' AS derivation, json_object('id', 'D' || k, 'namespace', CASE WHEN k % 2 = 0 THEN 'http://example.org/kit/dmn/' ELSE 'https://other.org/x' END, 'label', 'Order', 'source', path) AS p FROM o
  UNION ALL SELECT k, f || '#D' || k, 'dmn-decision', 'Order', 'derived', json_object('id', 'D' || k, 'label', 'Order', 'question', st || ' < 3?', 'allowedAnswers', NULL) FROM o
  UNION ALL SELECT k, task, 'external-artifact', prio || ' +', 'inferred', json_object('iri', task, 'targetKind', 'bpmn') FROM o WHERE status <> 'resolved'
  UNION ALL SELECT k, f || '#T' || k || '#table', 'dmn-decision-table', 'T' || k, 'derived', json_object('id', 'T' || k, 'hitPolicy', CASE WHEN k % 2 = 0 THEN 'FIRST' END, 'aggregation', NULL) FROM o
  UNION ALL SELECT k, f || '#i', 'dmn-input-clause', 'Status', 'derived', json_object('id', 'i', 'label', 'Status', 'expression', st, 'typeRef', 'string', 'ordinal', 0) FROM o
  UNION ALL SELECT k, f || '#o1', 'dmn-output-clause', 'Action', 'derived', json_object('id', 'o1', 'label', 'Action', 'description', NULL, 'ordinal', 0, 'serialisedAs', 'outputEntry', 'isReferenceColumn', false) FROM o
  UNION ALL SELECT k, f || '#o2', 'dmn-output-clause', l, 'derived', json_object('id', 'o2', 'label', l, 'description', descr, 'ordinal', 1, 'serialisedAs', 'annotationEntry', 'isReferenceColumn', referred) FROM o
  UNION ALL SELECT k, ns || '/data-element/' || lower(st), 'data-element', st, 'inferred', json_object('name', st, 'extractionRule', 'bare-expression', 'resolutionStatus', 'unresolved') FROM o
  UNION ALL SELECT k, f || '#r1', 'dmn-rule', 'rule 1', 'derived', json_object('id', 'r1', 'ordinal', 0, 'conditions', [{{'clause': 'Status', 'description': NULL, 'text': '1'}}], 'outputs', [{{'clause': 'Action', 'description': NULL, 'text': prio}}], 'annotations', CASE WHEN k % 2 = 0 THEN [{{'clause': l, 'text': book || chr(10) || '[later]' || chr(10) || '-'}}] ELSE [] END) FROM o
  UNION ALL SELECT k, f || '#r2', 'dmn-rule', 'rule 2', 'derived', json_object('id', 'r2', 'ordinal', 1, 'conditions', [{{'clause': 'Status', 'description': NULL, 'text': '2'}}], 'outputs', [{{'clause': 'Action', 'description': NULL, 'text': 'wait'}}], 'annotations', []) FROM o),
e AS (SELECT k, 'contains' AS what, f AS a, f || '#D' || k AS b, 'derived' AS derivation, NULL AS p FROM o UNION ALL SELECT k, 'contains', f || '#D' || k, f || '#T' || k || '#table', 'derived', NULL FROM o
  UNION ALL SELECT k, 'contains', f || '#T' || k || '#table', f || '#' || x, 'derived', NULL FROM o, (VALUES ('i'), ('o1'), ('o2'), ('r1'), ('r2')) v(x)
  UNION ALL SELECT k, 'invokedBy', f || '#D' || k, task, 'inferred', json_object('resolutionStatus', status, 'matchedOn', 'name in the reference = name of the task', 'href', 'in/x.bpmn#' || prio || '%20%2B', 'taskName', prio || ' +') FROM o
  UNION ALL SELECT k, 'reads', f || '#i', ns || '/data-element/' || lower(st), 'inferred', json_object('resolutionStatus', 'unresolved', 'extractionRule', 'bare-expression') FROM o
  UNION ALL SELECT k, 'citesSource', f || '#r1', ns || '/citation/' || substr(sha256(cite), 1, 12), 'derived', json_object('text', cite) FROM cited),
a AS (SELECT DISTINCT ns || '/kg/citations/' || path AS doc_id, 'node' AS what, ns || '/citation/' || substr(sha256(cite), 1, 12) AS a, 'citation' AS b, cite AS c, 'derived' AS derivation, CASE WHEN cite = '[later]' THEN json_object('text', cite, 'citationKind', 'placeholder', 'resolutionStatus', 'unresolved') ELSE json_object('text', cite, 'numbering', k::VARCHAR, 'citationKind', 'reference', 'resolutionStatus', 'unresolved') END::VARCHAR AS p FROM cited)
SELECT o.ns || '/kg/l2-dmn/' || o.path AS doc_id, 'node' AS what, n.a, b, n.c, derivation, p::VARCHAR AS properties FROM n JOIN o USING (k) UNION ALL SELECT o.ns || '/kg/l2-dmn/' || o.path, what, e.a, b, NULL, derivation, p::VARCHAR FROM e JOIN o USING (k)
UNION ALL SELECT * FROM a UNION ALL SELECT ns || '/kg/citations/' || path, 'appearsIn', ns || '/citation/' || substr(sha256(cite), 1, 12), f, NULL, 'derived', NULL FROM cited
UNION ALL SELECT ns || '/kg/citations/' || path, 'node', f, 'external-artifact', 'D' || k, 'derived', json_object('iri', f, 'targetKind', 'dmn')::VARCHAR FROM o""")
def decision_graph(spark, d):
    files = _decisions(spark, d)
    g = _decided(spark, d, files)
    about = F.when(F.col("type") == "dmn-definitions", F.regexp_replace("properties", ',"sha256":"[0-9a-f]{64}"', "")).otherwise(F.col("properties"))
    n = g.nodes.select("doc_id", F.lit("node").alias("what"), F.col("id").alias("a"), F.col("type").alias("b"), F.col("label").alias("c"), "derivation", about.alias("properties"))
    return n.unionByName(g.edges.select("doc_id", F.col("predicate").alias("what"), F.col("source").alias("a"), F.col("target").alias("b"), F.col("qualifier").alias("c"), "derivation", "properties"))


@query(f"""WITH {_BPMN_SQL}, {_DMN_SQL}
SELECT ns || '/kg/l2-bpmn/' || path AS doc_id, 'l2-bpmn' AS layer, 'https://example.org/kg/l2-bpmn.context.jsonld' AS context, path FROM c UNION ALL SELECT ns || '/kg/l2-dmn/' || path, 'l2-dmn', 'https://example.org/kg/l2-dmn.context.jsonld', path FROM o UNION ALL SELECT ns || '/kg/citations/' || path, 'l2', 'https://example.org/kg/l2.context.jsonld', path FROM o""")
def extracted_documents(spark, d):
    """SRC-02, SRC-04: files that lie in a folder, read with their hashes, become documents; the layer is read off the context again, and the hash of a source is that of its file."""
    folder = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    made = _processes(spark, d).union(_decisions(spark, d))
    made.select("path", F.col("text").alias("value")).write.parquet(folder)
    files = spark.read.parquet(folder).select("path", F.col("value").alias("text"), F.sha2("value", 256).alias("sha256"))
    p, q = files.where("path LIKE '%.bpmn'"), files.where("path LIKE '%.dmn'")
    g = extraction.union(extraction.processes(p, _people(spark, d)), _decided(spark, d, q))
    source = g.documents.select("doc_id", documents.layer_of(F.col("context")).alias("layer"), "context", F.explode("sources").alias("s"))
    return source.join(files.select("path", F.col("sha256").alias("now")), F.col("s.path") == F.col("path")).where("s.sha256 = now").select("doc_id", "layer", "context", "path")


_ALLOWED = {"bpmn-task": ["id", "name", "taskType", "isSubProcess"], "bpmn-process": ["id", "name", "isExecutable"], "dmn-decision": ["id", "label", "question", "allowedAnswers"], "citation": ["text", "numbering", "citationKind", "resolutionStatus"]}


def _layers(spark):
    """A model of the layers that extraction makes documents of."""
    classes = {"l2": ["persona", "external-artifact", "citation", "data-element"], "l2-bpmn": ["bpmn-definitions", "bpmn-process", "bpmn-participant", "bpmn-task", "bpmn-gateway", "bpmn-event"], "l2-dmn": ["dmn-definitions", "dmn-decision", "dmn-decision-table", "dmn-input-clause", "dmn-output-clause", "dmn-rule"]}
    bpmn = [("contains", "bpmn-definitions", "bpmn-process"), ("contains", "bpmn-definitions", "bpmn-participant"), ("contains", "bpmn-process", "bpmn-task"), ("contains", "bpmn-process", "bpmn-gateway"), ("contains", "bpmn-process", "bpmn-event"), ("contains", "bpmn-task", "bpmn-task"), ("flowsTo", "bpmn-task", "bpmn-task"), ("messageTo", "bpmn-task", "bpmn-task"), ("performedBy", "bpmn-participant", "persona")]
    dmn = [("contains", "dmn-definitions", "dmn-decision"), ("contains", "dmn-decision", "dmn-decision-table"), *[("contains", "dmn-decision-table", x) for x in ("dmn-input-clause", "dmn-output-clause", "dmn-rule")], ("invokedBy", "dmn-decision", "external-artifact"), ("reads", "dmn-input-clause", "data-element"), ("citesSource", "dmn-rule", "citation")]
    licensed = [("l2-bpmn", *e) for e in bpmn] + [("l2-dmn", *e) for e in dmn] + [("l2", "appearsIn", "citation", "external-artifact")]
    return make_model(
        spark, classes=[(layer, c, "Thing", "external-artifact" if c.endswith("-definitions") else None, None, None) for layer, cs in classes.items() for c in cs], class_properties=[(c, p) for c, ps in _ALLOWED.items() for p in ps],
        predicates=sorted({(layer, p, p == "flowsTo") for layer, p, _, _ in licensed}), licensed=[(layer, p, s, t, None, None) for layer, p, s, t in licensed], imports=[("l2", None, "1", "n"), ("l2-bpmn", "l2", "1", "n"), ("l2-dmn", "l2-bpmn", "1", "n")],
    )


@query(f"""WITH {_BPMN_SQL}, {_DMN_SQL}, b AS (SELECT *, ns || '/kg/l2-bpmn/' || path AS doc_id FROM c)
SELECT doc_id, 'V-12' AS rule_id, f || '#U' || k AS subject FROM b UNION ALL SELECT doc_id, 'V-07', 'contains|' || f || '#S' || k || '|' || f || '#G' || k FROM b
UNION ALL SELECT doc_id, 'V-06', 'messageTo|' || f || '#U' || k || '|' || f || '#gone' FROM b WHERE k % 9 = 0 UNION ALL SELECT doc_id, 'V-06', 'performedBy|' || f || '#P' || k || '|' || person FROM b WHERE k % 3 > 0 AND status = 'resolved'
UNION ALL SELECT ns || '/kg/l2-dmn/' || path, 'V-06', 'invokedBy|' || f || '#D' || k || '|' || task FROM o WHERE status = 'resolved'""")
def extracted_findings(spark, d):
    """EXT-01 to EXT-10 into V-36: files written by Spark, extracted, and held against the model of their layers."""
    p, q, before = _processes(spark, d), _decisions(spark, d), len(WRITTEN)
    g = extraction.union(extraction.processes(p, _people(spark, d)), _decided(spark, d, q))
    parsed = len(WRITTEN)
    g = extraction.Graph(*[written(t) for t in (g.documents.select("doc_id", "layer", "ontology_version"), g.nodes.drop("label", "defined_by", "flag_ref", "skill"), rules.slim_edges(g.edges))])  # what rules look at
    remove_between(spark, before, parsed)
    let_go(spark)
    return rules.validate(*g, _layers(spark)).select("doc_id", "rule_id", "subject")


@query("""SELECT 'D' || o_orderkey AS decision_id, 'Order' AS label, o_orderstatus || ' < 3?' AS question, o_orderpriority || ' +' AS using_task, CASE WHEN o_orderkey % 2 = 0 THEN 'FIRST' END AS hit_policy,
CASE WHEN o_orderkey % 3 < 2 THEN 1 END::INT AS reference FROM orders""")
def decision_tables(spark, d):
    files = _decisions(spark, d)
    ref = markup.reference_column(markup.clauses(files).where("side = 'output'"), ["decision_id"]).withColumnRenamed("ordinal", "reference")
    return markup.decisions(files).join(markup.tables(files).select("decision_id", "hit_policy"), "decision_id").join(ref, "decision_id", "left").select("decision_id", "label", "question", "using_task", "hit_policy", "reference")


@query("""WITH o AS (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 'Reference' ELSE 'Source' END AS l FROM orders)
SELECT 'D' || o_orderkey AS decision_id, 'r1' AS rule_id, 'inputEntry' AS entry, 0::INT AS ordinal, 'Status' AS label, '1' AS text FROM o UNION ALL SELECT 'D' || o_orderkey, 'r2', 'inputEntry', 0, 'Status', '2' FROM o
UNION ALL SELECT 'D' || o_orderkey, 'r1', 'outputEntry', 0, 'Action', o_orderpriority FROM o UNION ALL SELECT 'D' || o_orderkey, 'r2', 'outputEntry', 0, 'Action', 'wait' FROM o
UNION ALL SELECT 'D' || o_orderkey, 'r1', 'annotationEntry', 0, l, CASE WHEN o_orderkey % 2 = 0 THEN 'Book ' || o_custkey || ' (' || o_orderkey || ')' || chr(10) || '[later]' || chr(10) || '-' END FROM o UNION ALL SELECT 'D' || o_orderkey, 'r2', 'annotationEntry', 0, l, NULL FROM o""")
def decision_cells(spark, d):
    return markup.cells(_decisions(spark, d)).select("decision_id", "rule_id", "entry", "ordinal", "label", "text")


# Shorthand files


_FSH = """concat('Alias: $plan = http://x/recommendationdefinition\n', 'Instance: Actor', c_custkey, '\nInstanceOf: ActorDefinition\n', CASE WHEN c_custkey % 4 > 0 THEN concat('* title = "', c_name, ' \\\\"', c_mktsegment, '\\\\""\n') ELSE '' END, '* type = #person\n* description = \"\"\"\nWorks here since 2001.\n**ISCO-08**: 22', 10 + c_nationkey, ', 3221\n\"\"\"\n',
'Instance: Need', c_custkey, '\nInstanceOf: ExampleRequirement\n* title = "Need"\n', CASE c_custkey % 3 WHEN 0 THEN concat('* actor[+] = Canonical(Actor', c_custkey, ')\n* actor[+] = Canonical(Ghost)\n') WHEN 1 THEN concat('* extension[capability].valueString = "see ', c_mktsegment, '"\n* extension[benefit].valueString = "good"\n') ELSE '' END,
'* statement[+].key = "k', c_custkey, '"\n* statement[=].label = "L"\n* statement[=].requirement = "say \\\\"', c_mktsegment, '\\\\""\n* statement[=].conformance[+] = #', CASE WHEN c_custkey % 2 = 0 THEN 'SHALL' ELSE 'SHOULD' END, '\n* statement[+].key = "bare"\n',
'Instance: Plan', c_custkey, '\nInstanceOf: $plan\nTitle: "', CASE WHEN c_custkey % 2 = 0 THEN concat('KIT.D', c_custkey) ELSE 'Plan' END, '"\n* insert Meta(Lib', c_custkey, ',\n  [[x, y]])\n',
'Instance: KITIND', c_custkey, '\nInstanceOf: Measure\n* status = #draft\nInstance: Thing', c_custkey, 'Elements\nInstanceOf: Library\nTitle: "KIT.E"\nInstance: Odd', c_custkey, '\nInstanceOf: Library\nTitle: "KIT.O"\nValueSet: Set', c_custkey, '\nTitle: "Colours"\n',
'RuleSet: Inner.one\n* definitionCanonical = Canonical(Act)\nRuleSet: Meta(lib, more)\n* library = Canonical({lib}Logic)\n* relatedArtifact[+].citation = "Book {more} (3)"\n* insert Inner.one\n')"""


def _shorthand(spark, d):
    return _files(spark, d, "customer", "concat('c', c_custkey, '.fsh')", _FSH)


@query("SELECT 'Actor' || c_custkey AS id, c_name || ' \"' || c_mktsegment || '\"' AS title, 'person' AS persona_type, ['22' || (10 + c_nationkey), '3221'] AS isco FROM customer WHERE c_custkey % 4 > 0")
def shorthand_personas(spark, d):
    return shorthand.personas(shorthand.instances(_shorthand(spark, d))).select("id", "title", "persona_type", "isco")


@query("""SELECT 'Need' || c_custkey AS id, CASE WHEN c_custkey % 3 < 2 THEN 'functional-requirement' ELSE 'non-functional-requirement' END AS type, CASE WHEN c_custkey % 3 = 1 THEN 'see ' || c_mktsegment END AS capability, CASE WHEN c_custkey % 3 = 1 THEN 'good' END AS benefit,
'say "' || c_mktsegment || '"' AS requirement, CASE WHEN c_custkey % 2 = 0 THEN 'SHALL' ELSE 'SHOULD' END AS conformance FROM customer""")
def shorthand_requirements(spark, d):
    req = shorthand.requirements(shorthand.instances(_shorthand(spark, d)))
    return req.join(shorthand.requirement_statements(req).drop("ordinal"), "id").select("id", "type", "capability", "benefit", "requirement", "conformance")


@query("SELECT CASE WHEN c_custkey % 2 = 0 THEN 'SHALL' ELSE 'SHOULD' END AS conformance, count(*)::BIGINT AS n FROM customer GROUP BY 1")
def conformance_tally(spark, d):
    return shorthand.conformance_tally(shorthand.requirement_statements(shorthand.requirements(shorthand.instances(_shorthand(spark, d)))))


@query("""SELECT 'Need' || c_custkey AS id, 'Actor' || c_custkey AS actor, CASE WHEN c_custkey % 4 > 0 THEN 'resolved' ELSE 'unresolved' END AS status FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'Need' || c_custkey, 'Ghost', 'unresolved' FROM customer WHERE c_custkey % 3 = 0""")
def shorthand_actors(spark, d):
    inst = shorthand.instances(_shorthand(spark, d))
    return shorthand.match_actors(shorthand.requirements(inst), shorthand.personas(inst)).select("id", "actor", "status")


@query("SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'deep' ELSE 'top' END AS kit, concat('n', c_custkey) AS target FROM customer")
def kit_membership(spark, d):
    kits = spark.createDataFrame([("", "top"), ("a/b", "deep")], "folder string, id string")
    parts = read(spark, d, "customer").select(F.concat(F.when(F.col("c_mktsegment") == "BUILDING", "a/b/").otherwise("a/"), F.col("c_custkey").cast("string")).alias("path"), F.concat(F.lit("n"), "c_custkey").alias("id"), F.lit("personas").alias("qualifier"))
    return shorthand.kit_membership(kits, parts).select("kit", "target")


_KIT = '{"id":"kit","title":"The kit","canonicalUrl":"http://example.org/kit/","copyrightYear":2024,"publisher":{"name":"P"}}'


def _kit_files(spark, d):
    """The shorthand files of all customers below a folder with a kit's own file."""
    fsh = _shorthand(spark, d).select(F.concat(F.lit("kits/one/"), "path").alias("path"), "text")
    return fsh.union(read(spark, d, "region").where("r_regionkey = 0").select(F.lit("kits/one/kit.json"), F.lit(_KIT)))


@query(f"""WITH c AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS seg, c_custkey % 4 > 0 AS titled, '{NS}/requirement/need' || c_custkey AS req, '{NS}/persona/' || CASE WHEN c_custkey % 4 > 0 THEN regexp_replace(lower(c_name || '-' || c_mktsegment), '[^a-z0-9]+', '-', 'g') ELSE 'actor' || c_custkey END AS person, '{NS}/kg/l2/kits/one/c' || c_custkey || '.fsh' AS doc FROM customer), kit AS (SELECT '{NS}/kg/dak' AS kit)
SELECT '{NS}/kg/l2/kits/one/kit.json' AS doc_id, 'dak' AS what, kit AS a, 'The kit' AS b, NULL AS c, 'derived' AS derivation FROM kit UNION ALL SELECT doc, 'persona', person, name || ' "' || seg || '"', 'resolved', 'derived' FROM c WHERE titled
UNION ALL SELECT doc, CASE WHEN k % 3 < 2 THEN 'functional-requirement' ELSE 'non-functional-requirement' END, req, 'Need', NULL, 'derived' FROM c UNION ALL SELECT doc, 'requirement-statement', req || '/statement/k' || k, 'k' || k, NULL, 'derived' FROM c
UNION ALL SELECT doc, 'persona', '{NS}/persona/ghost', 'Ghost', 'unresolved', 'inferred' FROM c WHERE k % 3 = 0 UNION ALL SELECT doc, 'persona', person, 'Actor' || k, 'unresolved', 'inferred' FROM c WHERE k % 12 = 0
UNION ALL SELECT doc, 'hasComponent', kit, person, 'personas', 'inferred' FROM c, kit WHERE titled UNION ALL SELECT doc, 'hasComponent', kit, req, 'requirements', 'inferred' FROM c, kit UNION ALL SELECT doc, 'hasStatement', req, req || '/statement/k' || k, NULL, 'derived' FROM c
UNION ALL SELECT doc, 'fulfilledBy', req, person, CASE WHEN titled THEN 'resolved' ELSE 'unresolved' END, 'inferred' FROM c WHERE k % 3 = 0 UNION ALL SELECT doc, 'fulfilledBy', req, '{NS}/persona/ghost', 'unresolved', 'inferred' FROM c WHERE k % 3 = 0""")
def kit_graph(spark, d):
    files = _kit_files(spark, d)
    g = extraction.kit_components(files, extraction.kits(files))
    status = F.get_json_object("properties", "$.resolutionStatus")
    n = g.nodes.select("doc_id", F.col("type").alias("what"), F.col("id").alias("a"), F.col("label").alias("b"), status.alias("c"), "derivation")
    return n.unionByName(g.edges.select("doc_id", F.col("predicate").alias("what"), F.col("source").alias("a"), F.col("target").alias("b"), F.coalesce("qualifier", status).alias("c"), "derivation"))


_INDEX = f"""ix(canonical, resource_type, type, title) AS (
SELECT '{NS}/ActorDefinition/Actor' || c_custkey, 'ActorDefinition', 'actor-definition', NULL FROM customer UNION ALL SELECT '{NS}/PlanDefinition/Plan' || c_custkey, 'PlanDefinition', 'plan-definition', CASE WHEN c_custkey % 2 = 0 THEN 'KIT.D' || c_custkey ELSE 'Plan' END FROM customer
UNION ALL SELECT '{NS}/Measure/KITIND' || c_custkey, 'Measure', 'measure', NULL FROM customer UNION ALL SELECT '{NS}/Library/Thing' || c_custkey || 'Elements', 'Library', 'library', 'KIT.E' FROM customer UNION ALL SELECT '{NS}/Library/Odd' || c_custkey, 'Library', 'library', 'KIT.O' FROM customer
UNION ALL SELECT '{NS}/ValueSet/Set' || c_custkey, 'ValueSet', 'value-set', 'Colours' FROM customer UNION ALL SELECT '{NS}/Questionnaire/q' || s_suppkey, 'Questionnaire', 'questionnaire', s_name FROM supplier UNION ALL SELECT '{NS}/cql/logic-' || s_suppkey, 'cql', 'cql-library', 'Logic ' || s_suppkey FROM supplier
UNION ALL SELECT '{NS}/StructureMap/m' || s_suppkey, 'StructureMap', 'structure-map', 'm' || s_suppkey FROM supplier)"""


def _index_files(spark, d):
    more = _files(spark, d, "supplier", "concat('q', s_suppkey, '.json')", """concat('{"resourceType":"Questionnaire","id":"q', s_suppkey, '","title":"', s_name, '"}')""")
    more = more.union(_files(spark, d, "supplier", "concat('r', s_suppkey, '.json')", """'{"resourceType":"QuestionnaireResponse","id":"no"}'""")).union(_files(spark, d, "supplier", "concat('x/Logic ', s_suppkey, '.cql')", "'library'")).union(_files(spark, d, "supplier", "concat('m', s_suppkey, '.fml')", "'map'"))
    return _shorthand(spark, d).union(more)


def _index(spark, d):
    return shorthand.artifact_index(_index_files(spark, d), NS)


@query(f"WITH {_INDEX} SELECT canonical, resource_type, type, title FROM ix")
def artifact_index(spark, d):
    return _index(spark, d).select("canonical", "resource_type", "type", "title")


@query(f"""SELECT '{NS}/PlanDefinition/Plan' || c_custkey AS canonical, 'KIT.D' || c_custkey AS component_id, '{NS}/decision-support-logic/kit-d' || c_custkey AS component FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT '{NS}/Measure/KITIND' || c_custkey, 'KIT.IND.' || c_custkey, '{NS}/program-indicator/kit-ind-' || c_custkey FROM customer UNION ALL SELECT '{NS}/Library/Thing' || c_custkey || 'Elements', 'KIT.E', '{NS}/data-element/kit-e' FROM customer""")
def component_match(spark, d):
    return shorthand.match_components(_index(spark, d), NS).select("canonical", "component_id", "component")


@query(f"""WITH c AS (SELECT c_custkey AS k, '{NS}/PlanDefinition/Plan' || c_custkey AS plan, '{NS}/kg/l3/c' || c_custkey || '.fsh' AS doc FROM customer), {_INDEX},
m AS (SELECT doc, plan AS canonical, 'KIT.D' || k AS id, 'decision-support-logic/kit-d' || k AS slug FROM c WHERE k % 2 = 0 UNION ALL SELECT doc, '{NS}/Measure/KITIND' || k, 'KIT.IND.' || k, 'program-indicator/kit-ind-' || k FROM c UNION ALL SELECT doc, '{NS}/Library/Thing' || k || 'Elements', 'KIT.E', 'data-element/kit-e' FROM c)
SELECT type AS what, canonical AS a, coalesce(title, regexp_extract(canonical, '[^/]+$')) AS b, NULL AS c, 'derived' AS derivation FROM ix UNION ALL SELECT 'citation', '{NS}/citation/' || substr(sha256('Book x, y (3)'), 1, 12), 'Book x, y (3)', doc, 'derived' FROM c
UNION ALL SELECT regexp_extract(slug, '^[^/]+'), '{NS}/' || slug, id, doc, 'inferred' FROM m UNION ALL SELECT 'implementedBy', '{NS}/' || slug, canonical, 'unresolved', 'inferred' FROM m
UNION ALL SELECT 'uses', plan, '{NS}/Library/Lib' || k || 'Logic', NULL, 'derived' FROM c UNION ALL SELECT 'uses', plan, '{NS}/ActivityDefinition/Act', NULL, 'derived' FROM c UNION ALL SELECT 'citesSource', plan, '{NS}/citation/' || substr(sha256('Book x, y (3)'), 1, 12), NULL, 'derived' FROM c
UNION ALL SELECT 'uses', '{NS}/Library/Odd' || k, '{NS}/' || x, NULL, 'derived' FROM c, (VALUES ('Library/{{lib}}Logic'), ('ActivityDefinition/Act'), ('ActivityDefinition/Act')) v(x)
UNION ALL SELECT 'citesSource', '{NS}/Library/Odd' || k, '{NS}/citation/' || substr(sha256('Book {{more}} (3)'), 1, 12), NULL, 'derived' FROM c UNION ALL SELECT 'citation', '{NS}/citation/' || substr(sha256('Book {{more}} (3)'), 1, 12), 'Book {{more}} (3)', doc, 'derived' FROM c""")
def guide_graph(spark, d):
    """EXT-17 to EXT-21 and JON-06 as nodes and edges; what stands behind the last instance of a file, its rule sets here, is read as its own."""
    g = extraction.guide_artifacts(_index_files(spark, d), NS)
    minted = (F.col("derivation") == "inferred") | (F.col("type") == "citation")
    n = g.nodes.select(F.col("type").alias("what"), F.col("id").alias("a"), F.col("label").alias("b"), F.when(minted, F.col("doc_id")).alias("c"), "derivation")
    return n.unionByName(g.edges.select(F.col("predicate").alias("what"), F.col("source").alias("a"), F.col("target").alias("b"), F.get_json_object("properties", "$.resolutionStatus").alias("c"), "derivation"))


@query("SELECT DISTINCT 'Library' AS type FROM customer")
def undecided_types(spark, d):
    return shorthand.undecided_types(_index(spark, d))


@query(f"""SELECT 'Plan' || c_custkey AS id, 'uses' AS what, '{NS}/Library/Lib' || c_custkey || 'Logic' AS target FROM customer UNION ALL SELECT 'Plan' || c_custkey, 'uses', '{NS}/ActivityDefinition/Act' FROM customer
UNION ALL SELECT 'Plan' || c_custkey, 'cites', 'Book x, y (3)' FROM customer""")
def ruleset_references(spark, d):
    files = _shorthand(spark, d)
    plans = shorthand.instances(files).where("id LIKE 'Plan%'")
    whole = shorthand.expand_rulesets(plans, shorthand.rulesets(files), ["id"])
    return shorthand.canonical_refs(whole, ["id"], NS).select("id", F.lit("uses").alias("what"), "target").unionByName(shorthand.artifact_citations(whole, ["id"]).select("id", F.lit("cites").alias("what"), F.col("citation").alias("target")))


@query("""SELECT 'actor without a title' AS warning, 'Actor' || c_custkey AS subject FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT 'unknown actor', 'Need' || c_custkey || '|Ghost' FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'unknown actor', 'Need' || c_custkey || '|Actor' || c_custkey FROM customer WHERE c_custkey % 12 = 0
UNION ALL SELECT 'task name is not unique', c_mktsegment FROM customer GROUP BY c_mktsegment HAVING count(*) > 1 UNION ALL SELECT 'few rules are cited', l_returnflag || l_linestatus FROM lineitem GROUP BY l_returnflag || l_linestatus HAVING sum((l_tax > 0.06)::INT) < 0.5 * count(*)
UNION ALL SELECT 'join is not resolved', c_name FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'scheme rewritten', url FROM pages WHERE regexp_matches(url, '^http://example\\.com\\b')""")
def extraction_warnings(spark, d):
    inst, c = shorthand.instances(_shorthand(spark, d)), read(spark, d, "customer")
    cited = read(spark, d, "lineitem").groupBy(F.concat("l_returnflag", "l_linestatus").alias("table")).agg(F.count("*").alias("rules"), F.count_if(F.col("l_tax") > 0.06).alias("cited"))
    joins = c.select(F.col("c_name").alias("name"), F.when(F.col("c_acctbal") < 0, "ambiguous").otherwise("resolved").alias("status"))
    return shorthand.extraction_warnings(read(spark, d, "pages").select(F.col("url").alias("raw")), c.select(F.lit("p").alias("path"), F.col("c_mktsegment").alias("name")), shorthand.actors(inst), shorthand.match_actors(shorthand.requirements(inst), shorthand.personas(inst)), joins, cited, "example.com")


# Ids


_S = lambda c: f"regexp_replace(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g')"
_N = lambda c: f"regexp_replace(regexp_replace(trim({c}), '\\s+', '-', 'g'), '[^A-Za-z0-9.-]', '', 'g')"


@query(f"""WITH p AS (SELECT *, '{NS}/publication/isbn-' || p_partkey || 'X' AS pub FROM part)
SELECT p_partkey, pub, '{NS}/publication/url-' || {_S("'books.example.org/' || p_name")} AS by_url, '{NS}/publication/doi-' || {_S("'10.1/' || p_name")} AS by_doi, '{NS}/persona/' || {_S('p_name')} AS persona, '{NS}/data-element/' || {_S('p_type')} AS element, pub || '/section/' || {_N('p_name')} AS section,
pub || '/element/' || {_S('p_name')} || '/row-' || p_size AS row_id, pub || '/recommendation/' || CASE WHEN p_size % 2 = 0 THEN 'A.' || p_size ELSE 'h-' || substr(sha256(lower(p_name)), 1, 12) END AS recommendation, pub || '/recommendation/1/a' AS sub, pub || '/remark/' || p_size AS remark, pub || '/key-question/' || {_N('p_brand')} AS question,
pub || '/outcome/' || {_S('p_type')} AS outcome, pub || '/evidence/' || {_N('p_brand')} || '/' || {_S('p_type')} AS evidence, pub || '/indicator/' || {_N('p_brand')} AS indicator, '{NS}/health-intervention/' || {_S('p_brand')} || '-' || p_size AS intervention, '{NS}/artifact/f/reference/' || p_size AS entry FROM p""")
def l1_ids(spark, d):
    p, ns = _dealt(spark, read(spark, d, "part")), F.lit(NS)
    name, brand, kind, size = F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.col("p_size").cast("string")
    one = lambda t, v: F.struct(F.lit(t).alias("type"), v.alias("value"))
    pub = ids.publication_id(F.array(one("url", name), one("isbn", F.concat(F.lit("ISBN "), F.col("p_partkey").cast("string"), F.lit("-x")))), NS)
    by_url = ids.publication_id(F.array(one("url", F.concat(F.lit("HTTPS://WWW.books.example.org/"), name, F.lit("/?q=1#top")))), NS)
    return p.select(
        "p_partkey", pub.alias("pub"), by_url.alias("by_url"), ids.publication_id(F.array(one("doi", F.concat(F.lit("10.1/"), name))), NS).alias("by_doi"), ids.persona_id(ns, name).alias("persona"), ids.data_element_id(ns, kind).alias("element"), ids.section_id(pub, name).alias("section"), ids.publication_element_id(pub, name, F.concat(F.lit("row "), size)).alias("row_id"),
        ids.recommendation_id(pub, F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("A."), size)).otherwise(F.lit("")), name).alias("recommendation"), ids.sub_recommendation_id(F.concat(pub, F.lit("/recommendation/1")), F.lit("a")).alias("sub"), ids.remark_id(pub, F.col("p_size")).alias("remark"), ids.key_question_id(pub, brand).alias("question"),
        ids.outcome_id(pub, kind).alias("outcome"), ids.evidence_id(pub, brand, kind).alias("evidence"), ids.indicator_id(pub, brand).alias("indicator"), ids.health_intervention_id(NS, brand, size).alias("intervention"), ids.reference_entry_id(F.lit(f"{NS}/artifact/f"), size).alias("entry"),
    )


# Rules about documents, duplicates and criteria; the model


@query("""SELECT concat('c/', conv_id) AS doc_id, 'V-01' AS rule_id, concat('c/', conv_id) AS subject FROM conversations WHERE conv_id % 4 = 0 GROUP BY conv_id
UNION ALL SELECT concat('c/', conv_id), 'V-02', concat('turn/', turn // 2) FROM conversations WHERE conv_id % 4 > 0 GROUP BY conv_id, turn // 2 HAVING count(*) > 1
UNION ALL SELECT concat('c/', conv_id), 'V-13', concat('turn/', turn // 2) FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn // 2 ORDER BY turn DESC) AS k FROM conversations) WHERE k = 1 AND conv_id % 4 > 0 AND turn % 3 > 0""")
def document_rules(spark, d):
    c = read(spark, d, "conversations").withColumns({"doc_id": F.concat(F.lit("c/"), "conv_id"), "half": F.expr("concat('turn/', turn div 2)")})
    docs = c.select("doc_id", F.lit("talk").alias("layer"), F.when(F.col("conv_id") % 4 == 0, "0").otherwise(VERSION).alias("ontology_version")).distinct()
    nodes = c.select("doc_id", F.col("turn").alias("ord"), F.col("half").alias("id"), F.lit("requirement-statement").alias("type"), F.when(F.col("turn") % 3 == 0, F.lit('{"successCriteria":[{"key":"k"}]}')).when(F.col("turn") % 3 == 1, F.lit('{"successCriteria":[]}')).alias("properties"))
    _, m = one_layer(spark, "talk", nodes)
    index = rules.indexed(nodes, m)
    found = rules.node_findings(nodes, docs, m, {"V-02", "V-13"}, twice=index.twice).unionByName(rules.v01_version(docs, m.seen()))
    return found.select("doc_id", "rule_id", "subject").distinct()


@query("""WITH l AS (SELECT n_nationkey AS k, concat('layer-', n_nationkey) AS layer, CASE WHEN n_nationkey > 0 THEN concat('layer-', n_nationkey - 1) END AS imported, CASE WHEN n_regionkey = 0 THEN '2' ELSE '1' END AS v FROM nation)
SELECT 'M-06' AS rule_id, a.layer || '|' || a.imported AS subject FROM l a JOIN l b ON b.layer = a.imported WHERE a.v <> b.v
UNION ALL SELECT 'M-05', a.layer || '|same' FROM l a WHERE a.k > 20 AND a.k % 2 = 0 AND EXISTS (SELECT 1 FROM l b WHERE b.k < a.k AND b.k % 2 = 0 AND b.k > 20)
UNION ALL SELECT 'M-04', 'same|' || r_name FROM region WHERE r_regionkey > 0 UNION ALL SELECT 'M-04', 'set-' || r_regionkey FROM region WHERE r_regionkey % 2 = 1""")
def model_layers(spark, d):
    n, r = read(spark, d, "nation"), read(spark, d, "region")
    layer = F.concat(F.lit("layer-"), "n_nationkey")
    m = make_model(spark, kinds=[("layer-0", "Thing", "anything")])
    m.imports = n.select(layer.alias("layer"), F.when(F.col("n_nationkey") > 0, F.concat(F.lit("layer-"), F.col("n_nationkey") - 1)).alias("imported"), F.when(F.col("n_regionkey") == 0, "2").otherwise("1").alias("schema_version"), F.lit("n").alias("namespace"))
    m.classes = n.where("n_nationkey > 20 AND n_nationkey % 2 = 0").select(layer.alias("layer"), F.lit("same").alias("id"), F.lit("Thing").alias("kind"), *[F.lit(None).cast("string").alias(c) for c in ("elaborates", "iri_pattern", "min_derivation")])
    m.class_properties = r.where("r_regionkey = 0").select(F.lit("same").alias("class"), F.col("r_name").alias("property"))
    m.bindings = r.select(F.lit("same").alias("class"), F.col("r_name").alias("property"), F.concat(F.lit("set-"), "r_regionkey").alias("value_set"), F.lit("error").alias("severity"))
    m.codes = r.where("r_regionkey % 2 = 0").select(F.concat(F.lit("set-"), "r_regionkey").alias("value_set"), F.lit("1").alias("code"))
    return check_model(m).select("rule_id", "subject")


# Documents out and in


_RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"


@query(f"""WITH {graph_sql()}, n AS (SELECT * FROM nodes), e AS (SELECT *, '<urn:statement:' || sha256(doc_id || '|' || ord || '|' || predicate || '|' || source || '|' || target) || '>' AS s FROM edges)
SELECT '<' || id || '> <{_RDF}type> <http://v/' || type || '> .' AS value FROM n UNION ALL SELECT '<' || id || '> <http://www.w3.org/2000/01/rdf-schema#label> "' || label || '" .' FROM n
UNION ALL SELECT unnest([s || ' <{_RDF}type> <{_RDF}Statement> .', s || ' <{_RDF}subject> <' || source || '> .', s || ' <{_RDF}predicate> <http://v/' || predicate || '> .', s || ' <{_RDF}object> <' || target || '> .', s || ' <http://v/derivation> "' || derivation || '" .']) FROM e
UNION ALL SELECT s || ' <http://v/' || k || '> "' || v || '" .' FROM (SELECT s, unnest(['note', 'qualifier', 'evidence']) AS k, unnest([note, qualifier, ev_location]) AS v FROM e) WHERE v IS NOT NULL""")
def triples(spark, d):
    n, e = bench_graph(spark, d)
    return documents.ntriples(n, e, "http://v/")


@query(f"""WITH {graph_sql()} SELECT 0 AS part, 'MERGE (:Node {{id:''' || id || ''', type:''' || type || ''', label:''' || label || '''}});' AS value FROM nodes
UNION ALL SELECT 1, 'MATCH (s:Node {{id:''' || source || '''}}), (t:Node {{id:''' || target || '''}}) MERGE (s)-[:' || upper(predicate) || ' {{predicate:''' || predicate || '''' || coalesce(', qualifier:''' || qualifier || '''', '') || '}}]->(t);' FROM edges""")
def merge_statements(spark, d):
    n, e = bench_graph(spark, d)
    return documents.cypher(n, e)


@query(f"WITH {graph_sql()} SELECT 'node' AS what, doc_id, id AS a, type AS b, label AS c, note FROM nodes UNION ALL SELECT 'edge', doc_id, source, target, predicate, note FROM edges")
def documents_round_trip(spark, d):
    n, e = bench_graph(spark, d)
    docs = bench_documents(spark).select("doc_id", "layer", "ontology_version", F.concat(F.lit("http://x/"), "layer", F.lit(".context.jsonld")).alias("context"), F.lit("2024-01-02T03:04:05Z").cast("timestamp").alias("generated_at"), F.array(F.struct(F.lit("p").alias("path"), F.lit("0" * 64).alias("sha256"))).alias("sources"))
    path = f"{shared_folder(spark)}/documents-{uuid.uuid4().hex}"
    extra = {"defined_by": F.lit(None).cast("string"), "skill": F.lit(None).cast("string")}
    documents.write_parts(docs, n.withColumns(extra), e.withColumns({"skill": F.lit(None).cast("string")}), path, codec="gzip")
    _, nodes, edges = documents.read_parts(spark, path)
    return nodes.select(F.lit("node").alias("what"), "doc_id", F.col("id").alias("a"), F.col("type").alias("b"), F.col("label").alias("c"), "note").unionByName(edges.select(F.lit("edge").alias("what"), "doc_id", F.col("source").alias("a"), F.col("target").alias("b"), F.col("predicate").alias("c"), "note"))


@query("""SELECT (page_id % 50)::VARCHAR AS folder, count(*)::INT AS n_files, sha256(string_agg(lpad(page_id::VARCHAR, 9, '0') || chr(0) || html, '' ORDER BY page_id)) AS sha256 FROM pages GROUP BY 1""")
def folder_hashes(spark, d):
    files = read(spark, d, "pages").select(F.lpad(F.col("page_id").cast("string"), 9, "0").alias("path"), F.col("html").cast("binary").alias("content"), (F.col("page_id") % 50).cast("string").alias("folder"))
    return documents.tree_hash(files, F.col("folder"))


# Normative sentences by the default lists


_MARK = "should not|should|shall|must|recommendations|recommendation|recommended|recommends|recommend|is not a reason|are not a contraindication|may be given|may be administered|may be offered|may be considered|may be used|may be co-administered|may be implemented"
_TOLD = f"""s0 AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents), s1 AS (SELECT doc_id, generate_subscripts(l, 1) AS i, trim(unnest(l), chr(32) || chr(9) || chr(13)) AS t FROM s0), s2 AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS ordinal, CASE WHEN doc_id % 5 = 0 THEN 'You Must. ' || t WHEN doc_id % 5 = 1 THEN 'Zinc may  be given: ' || t ELSE t END AS t FROM s1 WHERE t <> ''),
no AS (SELECT *, len(regexp_extract_all(t, '(?i)(?:^|[^a-zA-Z0-9_])(' || replace('{_MARK}', ' ', '\\s+') || ')(?:$|[^a-zA-Z0-9_])')) > 0 AS hit FROM s2)"""


def _told(spark, d):
    s = coverage.sentences(read(spark, d, "documents"), "doc_id", "text", "\n")
    return s.withColumn("sentence", F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("You Must. "), "sentence")).when(F.col("doc_id") % 5 == 1, F.concat(F.lit("Zinc may  be given: "), "sentence")).otherwise(F.col("sentence")))


@query(f"WITH {_TOLD} SELECT doc_id, ordinal, t AS sentence FROM no WHERE hit")
def coverage_default(spark, d):
    return coverage.normative(_told(spark, d)).select("doc_id", "ordinal", "sentence")


_HASH = lambda t, cols: "(SELECT sha256(concat_ws('|', count(*)::VARCHAR, " + ", ".join(f"coalesce(sum(('0x' || substr(h, {8 * i + 1}, 8))::BIGINT)::VARCHAR, '0')" for i in range(8)) + ")) FROM (SELECT sha256(concat_ws(chr(31), " + ", ".join(f"coalesce(sha256({c}::VARCHAR), '')" for c in cols) + f")) AS h FROM {t}))"


@query(f"""WITH {_TOLD}, st AS (SELECT doc_id, ordinal, t, CASE WHEN ordinal = 0 AND doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0) THEN 'excluded' ELSE 'unaccounted' END AS state FROM no WHERE hit), g AS (
SELECT CASE WHEN doc_id IS NULL THEN 'total' ELSE 'page' END AS level, doc_id, NULL::INT AS ordinal, count(*)::BIGINT AS normative, count(*) FILTER (state = 'excluded')::BIGINT AS excluded, NULL AS state, NULL AS reason FROM st GROUP BY ROLLUP (doc_id)
UNION ALL SELECT 'sentence', doc_id, ordinal, NULL, NULL, state, CASE WHEN state = 'excluded' THEN 'editorial' END FROM st)
SELECT *, CASE WHEN level = 'sentence' THEN doc_id || '#' || ordinal END AS location, 'lists-1' AS definition_version, 'urn:publication/1' AS publication, TIMESTAMP '2024-01-02 03:04:05' AS generated_at, 'documents.parquet' AS source_path, 'labels.parquet' AS graph_path, {_HASH('documents', ['doc_id', 'text'])} AS source_sha256, {_HASH('labels', ['doc_id', 'toxic'])} AS graph_sha256 FROM g""")
def coverage_report(spark, d):
    docs, labels = read(spark, d, "documents"), read(spark, d, "labels")
    out = labels.where("toxic = 0").select("doc_id", F.lit(0).alias("ordinal"), F.lit("editorial").alias("reason"), F.lit("reviewer").alias("signed_by"))
    states = coverage.sentence_states(coverage.normative(_told(spark, d)), "doc_id", spark.createDataFrame([], "sentence string"), out)
    inputs = {"source": ("documents.parquet", coverage.table_hash(docs, ["doc_id", "text"])), "graph": ("labels.parquet", coverage.table_hash(labels, ["doc_id", "toxic"]))}
    report = coverage.coverage_report(states, "doc_id", inputs, "lists-1", "urn:publication/1", "2024-01-02T03:04:05Z")
    return report.select("level", "doc_id", "location", "ordinal", "normative", "excluded", "state", "reason", "definition_version", "publication", "generated_at", "source_path", "source_sha256", "graph_path", "graph_sha256")


@query("""WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'p' || c_custkey ELSE 'd/' || c_custkey END AS doc FROM customer)
SELECT doc AS doc_id, doc AS subject, 'document: id is missing' AS message FROM c WHERE k % 5 = 0 UNION ALL SELECT doc, doc, 'unknown field of a document: extra' FROM c WHERE k % 3 = 0 UNION ALL SELECT doc, doc, 'document is not of type Entity' FROM c WHERE k % 7 = 0
UNION ALL SELECT doc, 'f', 'sha256 has no sound form' FROM c WHERE k % 4 = 0 UNION ALL SELECT doc, 'n', 'unknown field of a node: colour' FROM c WHERE k % 11 = 0 UNION ALL SELECT doc, 'p|n|n', 'edge is not of type Statement' FROM c WHERE k % 13 = 0
UNION ALL SELECT doc, doc, 'generatedAt is no date and time' FROM c WHERE k % 17 = 0 UNION ALL SELECT 'bad' || n_nationkey, 'bad' || n_nationkey, 'document cannot be parsed' FROM nation""")
def raw_documents(spark, d):
    """T1-01 on documents as they stand in files."""
    text = """concat('{"@context":"http://x/l1.context.jsonld",', CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat('"id":"d/', c_custkey, '",') END, CASE WHEN c_custkey % 3 = 0 THEN '"extra":1,' ELSE '' END, '"type":"', CASE WHEN c_custkey % 7 = 0 THEN 'Thing' ELSE 'Entity' END,
'","ontologyVersion":"1","generatedAt":"', CASE WHEN c_custkey % 17 = 0 THEN 'today' ELSE '2024-01-01T00:00:00Z' END, '","wasDerivedFrom":[{"path":"f","sha256":"', CASE WHEN c_custkey % 4 = 0 THEN 'zz' ELSE sha2(c_name, 256) END, '"}],"nodes":[{"id":"n","type":"t","label":"l","derivation":"derived"', CASE WHEN c_custkey % 11 = 0 THEN ',"colour":"red"' ELSE '' END,
'}],"edges":[{"type":"', CASE WHEN c_custkey % 13 = 0 THEN 'Edge' ELSE 'Statement' END, '","predicate":"p","source":"n","target":"n","derivation":"derived"}]}')"""
    raw = read(spark, d, "customer").select(F.expr("concat('p', c_custkey)").alias("path"), F.expr(text).alias("value"))
    bad = read(spark, d, "nation").select(F.expr("concat('bad', n_nationkey)").alias("path"), F.lit('{"id":').alias("value"))
    return rules.document_findings(raw.union(bad)).select("doc_id", "subject", "message")


# Retrieval units


@query(f"""WITH {graph_sql()}, x AS (SELECT source AS id, 'out' AS direction, * FROM edges UNION ALL SELECT target, 'in', * FROM edges)
SELECT x.id, x.direction, x.predicate, coalesce(x.qualifier, '') AS qualifier, CASE WHEN x.direction = 'out' THEN x.target ELSE x.source END AS other, o.label AS other_label, x.derivation, coalesce(x.note, '') AS note, coalesce(x.ev_location, '') AS location, repeat('0', 64) AS sha256, count(*)::BIGINT AS n
FROM x JOIN nodes n ON n.id = x.id LEFT JOIN nodes o ON o.id = CASE WHEN x.direction = 'out' THEN x.target ELSE x.source END GROUP BY ALL""")
def retrieval_edges(spark, d):
    n, e = bench_graph(spark, d)
    docs = bench_documents(spark).withColumn("sources", F.array(F.struct(F.lit("p").alias("path"), F.lit("0" * 64).alias("sha256"))))
    again = n.where("type = 'nation'").withColumns({"doc_id": F.lit("zz"), "label": F.upper("label")})  # ids that two documents define: the first counts, once
    units = retrieval.retrieval_units(n.unionByName(again), e, documents=docs)
    one = units.select("id", F.explode("edges").alias("e"), F.get("sources", 0)["sha256"].alias("sha256"))
    flat = one.select("id", "e.direction", "e.predicate", "e.qualifier", "e.other", "e.other_label", "e.derivation", F.coalesce("e.note", F.lit("")).alias("note"), F.coalesce(F.get_json_object("e.evidence", "$.location"), F.lit("")).alias("location"), "sha256")
    return flat.groupBy("id", "direction", "predicate", "qualifier", "other", "other_label", "derivation", "note", "location", "sha256").agg(F.count("*").alias("n"))


@query(f"WITH {graph_sql()} SELECT id, type FROM nodes WHERE note IS NOT NULL")
def open_units(spark, d):
    n, e = bench_graph(spark, d)
    return retrieval.open_flags(retrieval.retrieval_units(n.withColumn("flag_ref", F.col("note")), e)).where("part = 0").select("id", "type")


@query(f"WITH {graph_sql()} SELECT e.predicate, e.source, e.target FROM edges e WHERE (e.source = 'nation/1' AND e.predicate = 'partOf') OR (e.target = 'nation/1' AND e.predicate = 'locatedIn')")
def edges_at(spark, d):
    from graphloom.operators import graph as g

    e = bench_graph(spark, d)[1]
    return g.out(e, "nation/1", "partOf").unionByName(g.into(e, "nation/1", "locatedIn")).select("predicate", "source", "target")


@query(f"""WITH {graph_sql()}, k AS (SELECT doc_id, string_agg(id, ',' ORDER BY id) AS ids FROM nodes WHERE doc_id = 'geo' GROUP BY 1) SELECT doc_id, layer, schema_version, classes FROM (VALUES ('geo', 'geo', '{VERSION}', 2::BIGINT), ('party', 'party', '{VERSION}', 4), ('trade', 'trade', '{VERSION}', 6)) v(doc_id, layer, schema_version, classes) WHERE EXISTS (SELECT 1 FROM k)""")
def layer_scope(spark, d):
    n, _ = bench_graph(spark, d)
    seen = bench_model(spark).seen()
    has = n.select("doc_id").distinct()
    return has.join(bench_documents(spark), "doc_id").join(seen.layers.select("layer", "schema_version"), "layer").join(seen.classes.groupBy("layer").agg(F.count("*").alias("classes")), "layer").select("doc_id", "layer", "schema_version", "classes")
