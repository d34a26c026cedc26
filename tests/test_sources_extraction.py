import hashlib
import json

from pyspark.sql import functions as F

from graphloom.functions import ids
from graphloom.operators import extraction, markup, questions, shorthand
from graphloom.sources import documents

BPMN = """<?xml version="1.0"?><bpmn:definitions id="D1" targetNamespace="http://example.org/kit/bpmn/">
<bpmn:collaboration id="C"><bpmn:participant id="P1" name="Nurse" processRef="Pr1"/><bpmn:participant id="P2" name="Nobody"/>
<bpmn:messageFlow id="M1" sourceRef="T1" targetRef="T2"/></bpmn:collaboration>
<bpmn:process id="Pr1"><bpmn:startEvent id="S"/><bpmn:task id="T1" name="Weigh &amp; measure"/>
<bpmn:subProcess id="Sub"><bpmn:task id="T2" name="Inner"/><bpmn:subProcess id="Deep"><bpmn:userTask id="T3"/></bpmn:subProcess><bpmn:task id="T4"/></bpmn:subProcess>
<bpmn:exclusiveGateway id="G"/><bpmn:endEvent id="E"/>
<bpmn:sequenceFlow id="F1" name="yes" sourceRef="G" targetRef="T1"><bpmn:conditionExpression>x</bpmn:conditionExpression></bpmn:sequenceFlow>
<bpmn:sequenceFlow id="F2" sourceRef="T1" targetRef="E"/></bpmn:process>
<bpmn:process id="Pr2"/></bpmn:definitions>"""
DMN = """<definitions id="D"><decision id="Dec" label="Give iron?"><question>Is &lt;iron&gt; low?</question><usingTask href="x.bpmn#Weigh%20+%20measure"/>
<decisionTable id="DT" hitPolicy="FIRST"><input id="i1" label="Hb"><inputExpression><text>Haemoglobin</text></inputExpression></input>
<input id="i2"><inputExpression><text>"Age" &gt; 3 and "Sex" = "F"</text></inputExpression></input>
<output id="o1" label="Action"/><output id="o2" label="Note"/><output id="o3" label="Reference(s)"><description>Reference for the source content (L1)</description></output>
<rule id="r1"><inputEntry><text>1</text></inputEntry><inputEntry><text>2</text></inputEntry><outputEntry><text>give</text></outputEntry><outputEntry><text>n</text></outputEntry><annotationEntry><text>Book A (1)
[later]
-</text></annotationEntry></rule>
<rule id="r2"><inputEntry><text>3</text></inputEntry><outputEntry><text>wait</text></outputEntry></rule></decisionTable></decision></definitions>"""
FSH = '''Alias: $plan = http://x/recommendationdefinition
Instance: Nurse
InstanceOf: ActorDefinition
* title = "Nurse \\"A\\""
* type = #person
* description = """
Cares for people, by the ISCO of 2008.
**ISCO-08**: 2221, 3221
Since 2024.
"""
Instance: Nobody
InstanceOf: ActorDefinition
* name = "n"
Instance: REQ1
InstanceOf: SGRequirements
* title = "Record weight"
* actor[+] = Canonical(Nurse)
* actor[+] = Canonical(Ghost)
* statement[+].key = "a"
* statement[=].label = "A"
* statement[=].requirement = "must weigh"
* statement[=].conformance[+] = #SHALL
* statement[+].key = "b"
* statement[=].conformance = #SHOULD
Instance: REQ2
InstanceOf: ExampleRequirement
* title = "Be fast"
* extension[capability].valueString = "be fast"
* extension[benefit].valueString = "time"
Instance: REQ3
InstanceOf: ExampleRequirement
* title = "Be there"
Instance: Plan
InstanceOf: $plan
Title: "DT.1"
* insert Meta-data.1(Plan,
   [[a, b]])
* library = Canonical(Lib)
* action.definitionCanonical = Canonical(Act)
* relatedArtifact[+].citation = "Book A (1)"
RuleSet: Meta-data.1(name, more)
* publisher = "{name} {more}"
* insert Inner
RuleSet: Inner
* status = #draft
ValueSet: Colours
Id: colours
Title: "Colours"
'''


def files(spark, **texts):
    return spark.createDataFrame([(k.replace("__", "."), v) for k, v in texts.items()], "path string, text string")


def test_process_files(spark):
    f = files(spark, a__bpmn=BPMN, broken__bpmn="<bpmn:task id='x' <bpmn:task id=\"T9\" name=\"n\"/>")
    kinds = {(r.id, r.type, r.name) for r in markup.elements(f).collect() if r.path == "a.bpmn"}
    assert {("T1", "bpmn-task", "Weigh & measure"), ("Sub", "bpmn-task", None), ("G", "bpmn-gateway", None), ("S", "bpmn-event", None), ("P2", "bpmn-participant", "Nobody")} <= kinds and len(kinds) == 13
    parents = {r.id: (r.parent, r.depth) for r in markup.nesting(f, ["process", "subProcess"], ["task", "userTask", "startEvent"]).collect() if r.path == "a.bpmn"}
    assert parents["T1"] == ("Pr1", 1) and parents["T2"] == ("Sub", 2) and parents["T3"] == ("Deep", 3) and parents["T4"] == ("Sub", 2) and parents["Pr1"] == (None, 0) and parents["Pr2"] == (None, 0)
    flows = {r.flow_id: (r.predicate, r.source, r.target, r.qualifier, r.conditional) for r in markup.flows(f).collect()}
    assert flows == {"F1": ("flowsTo", "G", "T1", "yes", False), "F2": ("flowsTo", "T1", "E", None, False), "M1": ("messageTo", "T1", "T2", None, False)}
    assert [r.id for r in markup.unowned_processes(f).collect()] == ["Pr2"]
    g = extraction.processes(f, spark.createDataFrame([("Nurse", "x.fsh")], "title string, source string"))
    own = "https://example.org/kit/artifact/D1"
    nodes = {r.id: r for r in g.nodes.collect() if r.doc_id.endswith("a.bpmn")}
    assert nodes[f"{own}#T2"].type == "bpmn-task" and json.loads(nodes[f"{own}#T2"].properties)["parent"] == f"{own}#Sub"
    assert json.loads(nodes[own].properties)["sha256"] == hashlib.sha256(BPMN.encode()).hexdigest()
    edges = {(r.predicate, r.source, r.target): r for r in g.edges.collect()}
    assert ("contains", f"{own}#Deep", f"{own}#T3") in edges and ("contains", own, f"{own}#P1") in edges and ("contains", f"{own}#Pr1", f"{own}#T1") in edges
    held = {r.source.split("#")[1]: (json.loads(r.properties)["resolutionStatus"], r.target, r.evidence.location) for r in edges.values() if r.predicate == "performedBy"}
    assert held == {"P1": ("resolved", "https://example.org/kit/persona/nurse", "x.fsh"), "P2": ("unresolved", "https://example.org/kit/persona/nobody", "a.bpmn")}
    assert nodes["https://example.org/kit/persona/nobody"].derivation == "inferred" and "https://example.org/kit/persona/nurse" not in nodes
    assert {r.sources[0].path for r in g.documents.collect()} == {r.path for r in f.collect()}


def test_tasks_for_decisions(spark):
    f = files(spark, a__bpmn=BPMN, d__dmn=DMN.replace('<definitions id="D">', '<definitions namespace="http://example.org/kit/dmn">').replace("Weigh%20+%20measure", "Weigh%20%26%20measure"))
    t = extraction.process_tags(f.where("path = 'a.bpmn'"))
    names = extraction.task_names(t)
    assert {(r.name, r.task) for r in names.collect()} == {("Weigh & measure", "https://example.org/kit/artifact/D1#T1"), ("Inner", "https://example.org/kit/artifact/D1#T2")}
    dmn = f.where("path = 'd.dmn'")
    for known, status, target in ((names, "resolved", "https://example.org/kit/artifact/D1#T1"), (names.union(names), "ambiguous", "https://example.org/kit/artifact/x.bpmn#Weigh%20%26%20measure"), (None, "unresolved", "https://example.org/kit/artifact/x.bpmn#Weigh%20%26%20measure")):
        g = extraction.decisions(dmn, known)
        e = g.edges.where("predicate = 'invokedBy'").first()
        assert (json.loads(e.properties)["resolutionStatus"], e.target) == (status, target)
        assert g.nodes.where("type = 'external-artifact'").count() == (0 if status == "resolved" else 1)


def test_decision_files(spark):
    f = files(spark, d__dmn=DMN)
    d = markup.decisions(f).first()
    assert (d.decision_id, d.label, d.question, d.using_task) == ("Dec", "Give iron?", "Is <iron> low?", "Weigh + measure")
    assert markup.tables(f).first().hit_policy == "FIRST"
    cells = {(r.rule_id, r.entry, r.ordinal): (r.label, r.text) for r in markup.cells(f).collect()}
    assert cells["r1", "outputEntry", 1] == ("Note", "n") and cells["r1", "annotationEntry", 0][0] == "Reference(s)" and cells["r2", "annotationEntry", 0] == ("Reference(s)", None) and cells["r2", "inputEntry", 1] == (None, None)
    assert [r.ordinal for r in markup.reference_column(markup.clauses(f).where("side = 'output'"), ["path"]).collect()] == [2]
    expr = {(r.element, r.rule) for r in markup.data_elements(markup.clauses(f).where("side = 'input'"), ["path"], "expression").collect()}
    assert expr == {("Haemoglobin", "bare-expression"), ("Age", "quoted-left-of-comparison"), ("Sex", "quoted-left-of-comparison")}
    g = extraction.union(extraction.decisions(f), extraction.citations(f))
    nodes, edges = g.nodes.collect(), g.edges.collect()
    assert {r.label for r in nodes if r.type == "citation"} == {"Book A (1)", "[later]"}
    ends = {r.id for r in nodes}
    assert all(r.target in ends and r.source in ends for r in edges)
    assert {r.type for r in nodes} == {"dmn-definitions", "dmn-decision", "dmn-decision-table", "dmn-input-clause", "dmn-output-clause", "dmn-rule", "citation", "data-element", "external-artifact"}
    rule = json.loads(next(r.properties for r in nodes if r.id == "urn:unknown/artifact/Dec#r1"))
    assert rule["conditions"] == [{"clause": "Hb", "description": None, "text": "1"}, {"clause": None, "description": None, "text": "2"}] and rule["annotations"][0]["clause"] == "Reference(s)"
    table = next(r for r in nodes if r.type == "dmn-decision-table")
    assert table.id == "urn:unknown/artifact/Dec#DT#table" and json.loads(table.properties) == {"id": "DT", "hitPolicy": "FIRST", "aggregation": None}


def test_kit_files(spark):
    kit = json.dumps({"id": "k", "title": "Kit", "canonicalUrl": "http://example.org/kit/", "copyrightYear": 2024, "publisher": {"name": "P"}})
    f = files(spark, x__fsh=FSH).union(files(spark, **{"kit__json": kit}))
    g = extraction.kit_components(f, extraction.kits(f))
    nodes, edges = {r.id: r for r in g.nodes.collect()}, g.edges.collect()
    ns = "https://example.org/kit"
    assert json.loads(nodes[f"{ns}/kg/dak"].properties) == {"id": "k", "title": "Kit", "canonicalUrl": "http://example.org/kit/", "copyrightYear": 2024, "publisherName": "P"}
    assert nodes[f"{ns}/persona/nurse-a"].type == "persona" and nodes[f"{ns}/persona/ghost"].derivation == "inferred"
    assert nodes[f"{ns}/requirement/req1"].type == "functional-requirement" and nodes[f"{ns}/requirement/req3"].type == "non-functional-requirement" and "capability" not in json.loads(nodes[f"{ns}/requirement/req3"].properties)
    assert json.loads(nodes[f"{ns}/requirement/req1/statement/a"].properties) == {"key": "a", "label": "A", "requirement": "must weigh", "conformance": "SHALL"}
    assert {(r.source, r.target, json.loads(r.properties)["resolutionStatus"]) for r in edges if r.predicate == "fulfilledBy"} == {(f"{ns}/requirement/req1", f"{ns}/persona/nurse-a", "resolved"), (f"{ns}/requirement/req1", f"{ns}/persona/ghost", "unresolved")}
    assert {(r.target, r.qualifier) for r in edges if r.predicate == "hasComponent"} == {(f"{ns}/persona/nurse-a", "personas"), *[(f"{ns}/requirement/req{i}", "requirements") for i in (1, 2, 3)]}
    assert all(r.note and r.evidence.location for r in edges if r.derivation == "inferred") and all(r.target in nodes and r.source in nodes for r in edges)
    assert g.documents.count() == 2


def test_guide_files(spark):
    f = files(spark, x__fsh=FSH, m__fml="map", l__cql="library", q__json=json.dumps({"resourceType": "Questionnaire", "id": "q", "title": "A.B.1", "status": "draft", "experimental": False, "meta": {"profile": ["p"]}}))
    g = extraction.guide_artifacts(f, "http://example.org/kit", "9")
    ns = "https://example.org/kit"
    nodes, edges = {(r.doc_id, r.id): r for r in g.nodes.collect()}, g.edges.collect()
    by = {k[1]: r for k, r in nodes.items()}
    assert json.loads(by[f"{ns}/Questionnaire/q"].properties) == {"canonical": f"{ns}/Questionnaire/q", "resourceType": "Questionnaire", "profile": "p", "status": "draft", "version": "9", "title": "A.B.1", "name": None, "publisher": None, "experimental": False, "source": "q.json", "sha256": hashlib.sha256(f.where("path = 'q.json'").first().text.encode()).hexdigest()}
    assert by[f"{ns}/cql/l"].type == "cql-library" and by[f"{ns}/StructureMap/m"].type == "structure-map" and by[f"{ns}/ValueSet/Colours"].label == "Colours"
    plan = f"{ns}/PlanDefinition/Plan"
    assert json.loads(by[plan].properties)["profile"] == "http://x/recommendationdefinition"
    assert {(r.predicate, r.source, r.target) for r in edges if r.predicate != "citesSource"} == {("uses", plan, f"{ns}/Library/Lib"), ("uses", plan, f"{ns}/ActivityDefinition/Act"), ("implementedBy", f"{ns}/decision-support-logic/dt-1", plan)}
    (c,) = [r for r in edges if r.predicate == "citesSource"]
    assert c.source == plan and by[c.target].type == "citation" and json.loads(by[c.target].properties) == {"text": "Book A (1)", "numbering": "1", "citationKind": "reference", "resolutionStatus": "unresolved"}
    assert by[f"{ns}/decision-support-logic/dt-1"].derivation == "inferred" and by[f"{ns}/decision-support-logic/dt-1"].evidence.location == "x.fsh#Plan"
    assert {r.doc_id.rsplit("/", 1)[1] for r in g.documents.collect()} == {"x.fsh", "m.fml", "l.cql", "q.json"}


def test_shorthand_files(spark):
    f = files(spark, x__fsh=FSH, m__fml="map", l__cql="library", q__json=json.dumps({"resourceType": "Questionnaire", "id": "q", "title": "A.B.1"}), r__json=json.dumps({"resourceType": "QuestionnaireResponse", "id": "no"}))
    inst = shorthand.instances(f)
    people = shorthand.personas(inst)
    assert {(r.id, r.title, r.persona_type, tuple(r.isco)) for r in people.collect()} == {("Nurse", 'Nurse "A"', "person", ("2221", "3221"))}
    req = shorthand.requirements(inst)
    assert {r.id: (r.type, r.capability, r.benefit) for r in req.collect()} == {"REQ1": ("functional-requirement", None, None), "REQ2": ("functional-requirement", "be fast", "time"), "REQ3": ("non-functional-requirement", None, None)}
    assert [(r.key, r.label, r.requirement, r.conformance) for r in shorthand.requirement_statements(req).orderBy("ordinal").collect()] == [("a", "A", "must weigh", "SHALL")]
    assert {(r.actor, r.status, r.match) for r in shorthand.match_actors(req, people).collect()} == {("Nurse", "resolved", "Nurse"), ("Ghost", "unresolved", None)}
    plan = shorthand.expand_rulesets(inst.where("id = 'Plan'"), shorthand.rulesets(f), ["path", "id"])
    text = plan.first().block
    assert '* publisher = "Plan a, b"' in text and "* status = #draft" in text and "insert" not in text
    assert [(r.target, r.target_path) for r in shorthand.canonical_refs(plan, ["id"], "ns").collect()] == [("ns/Library/Lib", None), ("ns/ActivityDefinition/Act", "PlanDefinition.action.definitionCanonical")]
    assert [(r.citation, r.numbering) for r in shorthand.artifact_citations(plan, ["id"]).collect()] == [("Book A (1)", "1")]
    index = shorthand.artifact_index(f, "http://c")
    assert {(r.type, r.id) for r in index.collect()} == {("actor-definition", "Nurse"), ("actor-definition", "Nobody"), ("requirements", "REQ1"), ("plan-definition", "Plan"), ("value-set", "Colours"), ("structure-map", "m"), ("cql-library", "l"), ("questionnaire", "q")}
    linked = {r.canonical: (r.component_type, r.component_id, r.component) for r in shorthand.match_components(index, "http://c").collect()}
    assert linked == {"http://c/PlanDefinition/Plan": ("decision-support-logic", "DT.1", "http://c/decision-support-logic/dt-1")}
    assert shorthand.undecided_types(index).collect() == []
    kits = spark.createDataFrame([("", "top"), ("a/b", "deep")], "folder string, id string")
    comps = spark.createDataFrame([("a/b/x.fsh", "p1", "personas"), ("c.fsh", "p2", "personas")], "path string, id string, qualifier string")
    assert {(r.kit, r.target) for r in shorthand.kit_membership(kits, comps).collect()} == {("deep", "p1"), ("top", "p2")}
    none = spark.createDataFrame([], "name string, status string")
    w = shorthand.extraction_warnings(spark.createDataFrame([("http://example.org/x",)], "raw string"), spark.createDataFrame([("p", "T"), ("p", "T")], "path string, name string"), shorthand.actors(inst), shorthand.match_actors(req, people), none, spark.createDataFrame([("t", 10, 1)], "table string, rules int, cited int"), "example.org")
    assert {r.warning for r in w.collect()} == {"scheme rewritten", "task name is not unique", "actor without a title", "unknown actor", "few rules are cited"}


DOC = {
    "@context": "http://example.org/l2-x.context.jsonld", "id": "doc/1", "type": "Entity", "ontologyVersion": "1", "generatedAt": "2024-01-02T03:04:05Z", "wasDerivedFrom": [{"path": "a/b.txt", "sha256": "0" * 64}],
    "nodes": [{"id": "n/1", "type": "thing", "label": 'A "b"\n', "derivation": "derived", "properties": {"aliases": ["x", None], "count": 3, "flag": True, "none": None}}, {"id": "n/2", "type": "thing", "label": "it's", "derivation": "inferred", "note": "why", "evidence": {"location": "p. 1"}, "properties": {}}],
    "edges": [{"type": "Statement", "predicate": "hasPart", "source": "n/1", "target": "n/2", "derivation": "derived", "qualifier": "q"}, {"type": "Statement", "predicate": "hasPart", "source": "n/1", "target": "n/2", "derivation": "derived"}],
}


def test_documents_round_trip(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(DOC, indent=1))
    d, n, e = documents.read_graph(spark, str(tmp_path / "in"))
    assert d.first().layer == "l2-x" and n.count() == 2 and e.count() == 2
    assert json.loads(n.orderBy("ord").first().properties) == DOC["nodes"][0]["properties"]
    documents.write_documents(d, n, e, str(tmp_path / "out"))
    (line,) = [x for p in (tmp_path / "out").glob("part-*") for x in p.read_text().splitlines()]
    back = json.loads(line)
    assert [x["label"] for x in back["nodes"]] == ['A "b"\n', "it's"] and back["nodes"][0]["properties"] == DOC["nodes"][0]["properties"] and back["edges"][0]["qualifier"] == "q" and back["generatedAt"] == DOC["generatedAt"]
    triples = {r.value for r in documents.ntriples(n, e, "http://v/").collect()}
    assert '<n/1> <http://www.w3.org/2000/01/rdf-schema#label> "A \\"b\\"\\n" .' in triples and sum("22-rdf-syntax-ns#Statement>" in t for t in triples) == 2
    statements = [r.value for r in documents.cypher(n, e).collect()]
    assert "MERGE (:Node {id:'n/2', type:'thing', label:'it\\'s'});" in statements and any("[:HASPART {predicate:'hasPart', qualifier:'q'}]" in s for s in statements)


def test_artifacts_and_tree_hash(spark, tmp_path):
    for name, data in {"a/x.txt": b"one", "a/b/y.txt": b"two", ".git/z": b"no"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    a = documents.read_artifacts(spark, str(tmp_path))
    assert {r.path: r.sha256 for r in a.collect()} == {"a/x.txt": hashlib.sha256(b"one").hexdigest(), "a/b/y.txt": hashlib.sha256(b"two").hexdigest()}
    want = hashlib.sha256(b"a/b/y.txt\0two" + b"a/x.txt\0one").hexdigest()
    assert documents.tree_hash(a, F.lit("all")).first().sha256 == want


def test_layers(spark):
    df = spark.createDataFrame([("http://x/l2-bpmn.context.jsonld",), ("http://x/other.jsonld",)], "c string")
    assert [r[0] for r in df.select(documents.layer_of(F.col("c"))).collect()] == ["l2-bpmn", "l1"]


def test_text_functions(spark):
    row = spark.createDataFrame([(" Café  du  Musée! ", "é", None)], "a string, b string, c string").select(
        ids.slug(F.col("a")).alias("slug"), ids.norm_text(F.col("a")).alias("norm"), (ids.norm_text(F.col("b")) == "é").alias("nfc"), ids.content_text(F.col("c"), F.col("a")).alias("content"), ids.content_text(F.col("c")).alias("none"),
        ids.publication_id(F.array(F.struct(F.lit("url").alias("type"), F.lit("https://a.b/c?x").alias("value")), F.struct(F.lit("isbn").alias("type"), F.lit("978-0x").alias("value"))), "n").alias("pub"), ids.num(F.lit(" 3.A 1*")).alias("num"), ids.decode_entities(F.lit("&amp;lt;")).alias("amp"),
    ).first()
    assert tuple(row) == ("cafe-du-musee", "Café du Musée!", True, "Café du Musée!", None, "n/publication/isbn-9780X", "3.A-1", "&lt;")


def test_ids_of_published_content(spark):
    row = spark.range(1).select(
        ids.publication_id(F.array(F.struct(F.lit("url").alias("type"), F.lit("https://www.books.example/a/b---c/?q=1").alias("value"))), "n").alias("url"), ids.publication_element_id(F.lit("p"), F.lit("Table 1"), F.lit("row 2"), F.lit("footnote a")).alias("cell"), ids.persona_id(F.lit("n"), F.lit("Data Clérk")).alias("persona"),
        ids.health_intervention_id("n", F.lit("UHC x"), F.lit("a b.1")).alias("hi"), ids.remark_id(F.lit("r"), F.lit(1)).alias("remark"), ids.kit_namespace(F.lit("http://example.orgs/x/")).alias("other"), ids.kit_namespace(F.lit("http://example.org/x/bpmn/")).alias("own"),
    ).first()
    assert tuple(row) == ("n/publication/url-books-example-a-b-c", "p/element/table-1/row-2/footnote-a", "n/persona/data-clerk", "n/health-intervention/uhc-x-a-b.1", "r/remark/1", "http://example.orgs/x", "https://example.org/x")


def test_questions(spark):
    edges = spark.createDataFrame([("d", i, p, s, t, "derived") for i, (p, s, t) in enumerate([("supersedes", "r2", "r1"), ("supersedes", "r3", "r2"), ("supersedes", "r1", "r3"), ("supportedBy", "r3", "ev"), ("forOutcome", "ev", "out"), ("implementedBy", "r2", "art"), ("resolvesTo", "c", "r1"), ("numberedAs", "c0", "c"), ("numberedAs", "c1", "c0"), ("resolvesTo", "c", "r2"), ("justifiedBy", "ind", "r2"), ("numberedAs", "loop", "loop2"), ("numberedAs", "loop2", "loop")])], "doc_id string, ord int, predicate string, source string, target string, derivation string")
    nodes = spark.createDataFrame([("d", i, n, t) for i, (n, t) in enumerate([("r1", "recommendation"), ("r2", "recommendation"), ("c", "citation"), ("c0", "reference-entry"), ("loop", "citation"), ("loop2", "citation")])], "doc_id string, ord int, id string, type string")
    seeds = spark.createDataFrame([("r1",), ("ghost",)], "seed string")
    want = {("r1", "visited", x) for x in ("r1", "r2", "r3")} | {("r1", "supersededBy", "r2"), ("r1", "supersededBy", "r3"), ("r1", "evidence", "ev"), ("r1", "outcome", "out"), ("r1", "implementedBy", "art"), ("r1", "citedBy", "c"), ("r1", "citedBy", "c0"), ("r1", "indicator", "ind"), ("ghost", "visited", "ghost")}
    assert {tuple(r) for r in questions.impact(nodes, edges, seeds).collect()} == want == {tuple(r) for r in questions.impact_of_all(edges, seeds).collect()}
    steps, ends = questions.resolve_citation(nodes, edges, spark.createDataFrame([("c1",), ("loop",), ("x",)], "seed string"))
    assert [(r.seed, r.step, r.target) for r in steps.orderBy("seed", "step").collect()] == [("c1", 1, "c0"), ("c1", 2, "c"), ("c1", 3, "r1"), ("loop", 1, "loop2"), ("loop", 2, "loop")]
    assert {r.seed: r.target for r in ends.collect()} == {"c1": "r1", "loop": None, "x": None}
    assert {r.id for r in questions.uncovered(nodes, edges).collect()} == {"r1"}
    assert {(r.node, r.depth) for r in questions.dependents(edges, spark.createDataFrame([("out",)], "seed string"), ["forOutcome", "supportedBy"]).collect()} == {("ev", 1), ("r3", 2)}


def test_documents_in_parts(spark, tmp_path):
    """Many parts of one document, one behind the other, are its JSON; what is read has all in order."""
    none, ev = "CAST(NULL AS STRING)", "IF(id % 5 = 0, named_struct('location', concat('l', id), 'quote', CAST(NULL AS STRING), 'artifact', CAST(NULL AS STRING), 'by', CAST(NULL AS STRING), 'at', CAST(NULL AS STRING)), NULL) AS evidence"
    base = spark.range(500).selectExpr("IF(id % 50 = 0, 'small/one', 'http://x/large') AS doc_id", "CAST(500 - id AS INT) AS ord", "id", ev)
    nodes = base.selectExpr("doc_id", "ord", "concat('n', id, ',') AS id", "'t' AS type", "concat('a\\n\"],\"edges\":[', id) AS label", f"{none} AS defined_by", "concat('{\"k\":', id, ',\"l\":[1,\"é\"]}') AS properties", "'derived' AS derivation", f"{none} AS note", "evidence", f"{none} AS flag_ref", f"{none} AS skill")
    edges = base.selectExpr("doc_id", "ord", "'knows' AS predicate", "concat('n', id) AS source", "concat('n', id + 1) AS target", f"{none} AS qualifier", "'derived' AS derivation", f"{none} AS note", "evidence", f"{none} AS flag_ref", f"{none} AS skill", f"{none} AS properties")
    docs = spark.createDataFrame([(d, f"http://x/{d[0]}/l2-bpmn.context.jsonld", "1") for d in ("small/one", "http://x/large", "empty")], "doc_id string, context string, ontology_version string").withColumns({"generated_at": F.lit("2024-01-02 03:04:05").cast("timestamp"), "sources": F.array(F.struct(F.lit("p").alias("path"), F.lit("s").alias("sha256")))})
    path = tmp_path / "out"
    documents.write_parts(docs, nodes, edges, str(path), parts=9)
    folders = {p.name: sorted(p.glob("part-*")) for p in path.iterdir() if p.is_dir()}
    assert len(folders) == 3 and max(map(len, folders.values())) > 4
    for parts in folders.values():
        whole = json.loads("".join(p.read_text() for p in parts))
        own = [r for r in nodes.where(F.col("doc_id") == whole["id"]).orderBy("ord").collect()]
        assert [n["id"] for n in whole["nodes"]] == [r.id for r in own] and [n["label"] for n in whole["nodes"]] == [r.label for r in own] and len(whole["edges"]) == len(own)
        assert all(n["properties"] == json.loads(r.properties) for n, r in zip(whole["nodes"], own))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        d, n, e = documents.read_parts(spark, str(path))
        assert {(r.doc_id, r.layer, r.sources[0].path) for r in d.collect()} == {(x, "l2-bpmn", "p") for x in ("small/one", "http://x/large", "empty")}
        for doc in ("small/one", "http://x/large"):
            for back, made, by in ((n, nodes, "id"), (e, edges, "source")):
                got = [(r[by], r.evidence and r.evidence.location) for r in back.where(F.col("doc_id") == doc).orderBy("ord").collect()]
                assert got == [(r[by], r.evidence and r.evidence.location) for r in made.where(F.col("doc_id") == doc).orderBy("ord").collect()]
        assert n.where("id = 'n7,'").first().properties == '{"k":7,"l":[1,"é"]}'
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_tree_hash_goes_by_in_pieces(spark):
    content = {"a/x": b"", "a/y": bytes(range(256)) * 200, "a/z": b"1" * documents.PIECE, "b/x": b"q", "B/x": b"r"}
    t = spark.createDataFrame([(k, bytearray(v)) for k, v in content.items()], "path string, content binary")
    got = {r.folder: (r.n_files, r.sha256) for r in documents.tree_hash(t, F.regexp_extract("path", "^[^/]*", 0)).collect()}
    want = {f: (sum(k.startswith(f + "/") for k in content), hashlib.sha256(b"".join(k.encode() + b"\0" + content[k] for k in sorted(content) if k.startswith(f + "/"))).hexdigest()) for f in ("a", "b", "B")}
    assert got == want
