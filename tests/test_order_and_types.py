"""The first licence that asks for a derivation stands; a code is a text; ids that two documents define."""

from pyspark.sql import functions as F

from graphloom.model import make_model, read_model
from graphloom.operators import graph, retrieval, rules

EVIDENCE = "struct<location:string,quote:string,artifact:string,by:string,at:string>"
NODE = f"doc_id string, ord int, id string, type string, label string, properties string, derivation string, note string, evidence {EVIDENCE}"
EDGE = f"doc_id string, ord int, predicate string, source string, target string, qualifier string, derivation string, note string, evidence {EVIDENCE}, properties string"


def told(spark, m):
    nodes = spark.createDataFrame([("d", i, x, "a", x, None, "derived", None, None) for i, x in enumerate("xy")], NODE)
    edges = spark.createDataFrame([("d", 0, "p", "x", "y", None, "derived", None, None, None)], EDGE)
    docs = spark.createDataFrame([("d", "top", "1")], "doc_id string, layer string, ontology_version string")
    return [r.message for r in rules.edge_findings(edges, nodes, docs, m, {"V-09"}).collect()]


def test_first_licence_stands(spark):
    base = {"classes": [("low", "a", "K", None, None, None)], "predicates": [("low", "p", False)], "imports": [("low", None, "1", "n"), ("top", "low", "1", "n")]}
    one = lambda layer, least: (layer, "p", "a", "a", None, least)
    for licences, least in (
        ([one("low", "inferred"), one("low", "decided")], "inferred"), ([one("low", "decided"), one("low", "inferred")], "decided"),
        ([one("low", None), one("low", "decided")], "decided"), ([one("low", "inferred"), one("top", "decided")], "decided"), ([one("low", None)], None),
    ):
        assert told(spark, make_model(spark, licensed=licences, **base)) == ([] if least is None else [f"must be at least {least}"]), licences


def test_order_of_authored_licences(spark, tmp_path):
    (tmp_path / "top.json").write_text('{"layer":"top","schemaVersion":"1","namespace":"n","classes":[{"id":"a"}],"predicates":[{"predicate":"p"}],"edges":[{"predicate":"p","source":"a","target":"a"},{"predicate":"p","source":"a","target":"a","qualifier":"q","minDerivation":"inferred"},{"predicate":"p","source":"a","target":"a","qualifier":"r","minDerivation":"decided"}]}')
    assert told(spark, read_model(spark, str(tmp_path / "*.json"))) == ["must be at least inferred"]


def test_codes_are_texts(spark):
    m = make_model(spark, classes=[("top", "a", "K", None, None, None)], imports=[("top", None, "1", "n")], bindings=[("a", "k", "s", "error")], codes=[("s", "1"), ("s", "true"), ("s", "ok")])
    values = ['"1"', "1", "true", '"true"', '"ok"', '["ok"]', "null", '"no"', '{"ok":1}', "1.0"]
    nodes = spark.createDataFrame([("d", i, f"n{i}", "a", "l", f'{{"k":{v},"other":1}}', "derived", None, None) for i, v in enumerate(values)], NODE)
    docs = spark.createDataFrame([("d", "top", "1")], "doc_id string, layer string, ontology_version string")
    bad = {values[int(r.subject[1:])] for r in rules.node_findings(nodes, docs, m, {"V-14"}).collect()}
    assert bad == {"1", "true", '["ok"]', '"no"', '{"ok":1}', "1.0"}


def test_ids_in_two_documents(spark):
    nodes = spark.createDataFrame([("b", 0, "x", "t2", "second", None, "derived", None, None), ("a", 1, "x", "t1", "first", None, "derived", None, None), ("a", 0, "y", "t1", "y", None, "derived", None, None)], NODE).withColumn("layer", F.concat(F.lit("layer-"), "doc_id"))
    edges = spark.createDataFrame([("a", 0, "p", "y", "x", None, "derived", None, None, None)], EDGE)
    units = {r.id: r for r in retrieval.retrieval_units(nodes, edges).collect()}
    assert set(units) == {"x", "y"} and units["x"].label == "first" and [e.other_label for e in units["y"].edges] == ["first"]
    assert [(r.source_layer, r.target_layer, r.target_type) for r in graph.with_layers(edges, nodes).collect()] == [("layer-a", "layer-a", "t1")]
