"""What keeps jobs within bounds on large tables, seen in the plans of small ones; results are held against SQL in test_queries."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from graphloom.operators import extraction, frontier, graph, questions, retrieval, rules, text_index
from graphloom.operators.frontier import WRITTEN
from graphloom.plans import catalog
from tests.oracle import compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["quoted_slots", "one_copy", "parent_status"])
def test_rules_send_no_table_of_nodes_to_every_task(spark, name):
    """files of a few MB are millions of nodes; Spark would judge them by the files."""
    p = plan(catalog.queries()[name](spark, FOLDER))
    assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p


@pytest.mark.parametrize("name, sign", [("decision_graph", "orders.parquet"), ("process_graph", "regexp_extract_all(")])
def test_files_are_parsed_once(spark, name, sign):
    """F2, F8: each kind of node and edge reads parsed rows, not the text of all files again."""
    p = plan(catalog.queries()[name](spark, FOLDER))
    assert sign not in p and "Window" not in p


def test_lines_of_documents_are_read_where_they_lie(spark):
    """the document of a line is its folder; a join by folder would put all of a large document into one task."""
    p = plan(catalog.queries()["documents_round_trip"](spark, FOLDER))
    assert "Join" not in p and "Exchange" not in p


@pytest.mark.parametrize("name", ["l1_ids", "process_flows"])
def test_work_on_a_small_table_is_dealt_over_the_tasks(spark, name):
    """twenty thousand parts lie in one task, a million in one or two."""
    assert catalog.queries()[name](spark, FOLDER).rdd.getNumPartitions() > spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("name", ["join_status", "top_findings", "unlicensed_edges", "node_explanations"])
def test_rows_are_not_dealt_by_document(spark, name):
    """of three documents one holds nearly all nodes and edges; only the first six findings of each task go to their document's."""
    p = plan(catalog.queries()[name](spark, FOLDER))
    assert p.count("Exchange hashpartitioning(doc_id#") == (name == "top_findings") and ("6, Partial" in p) == (name == "top_findings")


@pytest.mark.parametrize("name", ["unit_split", "retrieval_edges"])
def test_units_are_gathered_where_they_are_numbered(spark, name):
    """edges are dealt by the other end for its label and by their own for their unit; units by neither part, bucket nor document."""
    p = plan(catalog.queries()[name](spark, FOLDER))
    assert not [x for x in p.splitlines() if "Exchange hashpartitioning" in x and ("part#" in x or "bucket#" in x or "(doc_id#" in x)]


@pytest.mark.parametrize("name", ["unit_split", "retrieval_units", "retrieval_edges"])
def test_units_of_large_nodes(spark, name, monkeypatch):
    """nodes with more edges than LARGE are numbered in buckets; parts run on from one bucket to the next."""
    monkeypatch.setattr(retrieval, "LARGE", 30)
    compare(spark, name, catalog.queries()[name], catalog.oracle_sql()[name], FOLDER)


def test_used_keys_are_made_distinct_before_they_meet_the_declared(spark):
    """F16: a predicate stands in most edges; its rows would lie sorted in one task. Of suppliedBy pairs of keys are made distinct, not the texts that follow from them."""
    p = plan(catalog.queries()["unused_predicates"](spark, FOLDER))
    assert p.count("HashAggregate(keys=[predicate#") == 4 and "HashAggregate(keys=[l_partkey#" in p


def test_grams_are_taken_without_a_shuffle(spark):
    """a row's grams are made distinct in the row; only the deal by ranges moves them. Rows of one key count a gram once."""
    t = spark.sql("SELECT * FROM VALUES ('a', array('xabc', 'abcd', null, 'zz')), ('a', array('abc')), ('b', null) AS t(key, texts)")
    grams = text_index.grams_of(t, "key", t["texts"])
    assert "Exchange" not in plan(grams) and sorted((r.gram, r.key) for r in grams.collect()) == [("abc", "a"), ("abc", "a"), ("bcd", "a"), ("xab", "a")]


def test_a_statement_is_hashed_once(spark):
    """the hash that names an edge's statement is a column, not part of each of its lines."""
    p = plan(catalog.queries()["triples"](spark, FOLDER))
    assert "sha2(" in p and not [x for x in p.splitlines() if "Generate" in x and "sha2(" in x]


def test_a_search_reads_edges_once(spark):
    """ids of hits go to every task; edges are neither dealt by an end nor read once for each end."""
    p = plan(catalog.queries()["node_search"](spark, FOLDER))
    assert p.count("[lag(") == 1 and "hashpartitioning(source#" not in p and "hashpartitioning(target#" not in p


@pytest.mark.parametrize("most", [0, 500_000])
def test_a_search_gives_each_edge_once(spark, monkeypatch, most):
    """hits at both ends, at one and at none, sent and merged."""
    monkeypatch.setattr(graph, "MOST_SENT", most)
    n = spark.sql("SELECT *, '{}' AS properties FROM VALUES ('Ab', 'x', 't'), ('Ab', 'x', 't'), ('c', 'aB', 't'), ('d', null, 't') AS t(id, label, type)")
    e = spark.sql("SELECT * FROM VALUES ('Ab', 'c'), ('Ab', 'c'), ('d', 'Ab'), ('c', null), ('d', 'd'), (null, 'c') AS t(source, target)")
    hits, touched = graph.search(n, e, "AB")
    assert hits.count() == 3 and sorted(map(str, map(tuple, touched.collect()))) == sorted(map(str, [("Ab", "c"), ("Ab", "c"), ("d", "Ab"), ("c", None), (None, "c")]))


def test_an_index_is_dealt_over_the_tasks(spark):
    """rows of artefacts are many and their files small; AQE would join them to a few tasks by their size."""
    p = plan(catalog.queries()["component_match"](spark, FOLDER))
    assert f"{4 * spark.sparkContext.defaultParallelism}), REPARTITION_BY_NUM" in p


def test_a_guide_is_parsed_once(spark):
    """nodes and edges of a guide read parsed rows; rule sets are put in once and go to every task."""
    p = plan(catalog.queries()["guide_graph"](spark, FOLDER))
    assert "customer.parquet" not in p and "supplier.parquet" not in p


def test_ids_defined_once_are_dealt_once(spark):
    """the index of ids that stand once is one table; a second one is for what is defined again."""
    n = spark.sql("SELECT 'd' AS doc_id, ord, concat('n', ord) AS id, 't' AS type, '{}' AS properties FROM (SELECT id AS ord FROM range(20))")
    before = len(WRITTEN)
    index = rules.indexed(n)
    assert len(WRITTEN) == before + 1 and index.best.count() == 20 and index.own.isEmpty() and index.twice.isEmpty() and index.clashes.isEmpty()
    index = rules.indexed(n.unionByName(n.where("ord < 2").withColumns({"type": F.lit("u"), "doc_id": F.lit("e")})).unionByName(n.where("ord = 5").withColumn("ord", F.lit(30).cast("long"))))
    assert index.best.count() == 20 and index.own.count() == 5 and [(r.id, r.last, r.copies) for r in index.twice.collect()] == [("n5", 30, 2)] and sorted(r.id for r in index.clashes.collect()) == ["n0", "n1"]


def test_columns_of_a_table_meet_what_it_holds_once(spark):
    """cells are not joined with columns again, and lines are made distinct as numbers."""
    p = plan(catalog.queries()["one_copy"](spark, FOLDER))
    assert "hashpartitioning(doc_id#" in p and not [x for x in p.splitlines() if "Exchange hashpartitioning" in x and "pos#" in x] and "lineitem.parquet" not in p


def test_what_hangs_on_a_line_is_made_distinct_for_the_line(spark):
    """pairs of seeds and targets, several times the edges, are not dealt to be made distinct."""
    p = plan(catalog.queries()["impact"](spark, FOLDER))
    assert not [x for x in p.splitlines() if "Aggregate(keys=[seed#" in x and "target#" in x.split("functions")[0]]


@pytest.mark.parametrize("more", ["", ", ('supersedes', 'k', 'c')", ", ('supersedes', 'a', 'd')"])
def test_impact_of_all_is_that_of_each(spark, more):
    """a target at two places of a line, twice at one, on a ring, behind a branch and at a seed of no line."""
    e = spark.sql(f"SELECT * FROM VALUES ('supersedes', 'b', 'a'), ('supersedes', 'c', 'b'), ('supersedes', 'd', 'c'), ('supersedes', 'y', 'x'), ('supersedes', 'x', 'y'), ('implementedBy', 'a', 'p'), ('implementedBy', 'c', 'p'), ('implementedBy', 'c', 'p'), ('implementedBy', 'b', 'q'), ('implementedBy', 'x', 'p'), ('implementedBy', 'y', 'r'), ('implementedBy', 'z', 'p'), ('implementedBy', 'k', 's'), ('presentedIn', 'd', 'p'){more} AS t(predicate, source, target)")
    seeds = spark.sql("SELECT * FROM VALUES ('a'), ('b'), ('c'), ('d'), ('x'), ('y'), ('z'), ('k'), ('a') AS t(seed)")
    rows = lambda t: sorted(map(tuple, t.select("seed", "relation", "target").collect()))
    assert rows(questions.impact_of_all(e, seeds)) == rows(questions.impact(None, e, seeds))


def test_rules_and_report_share_the_ends(spark, monkeypatch):
    """ids are indexed once, and the ends of edges looked up once for rules and report (and once for the few edges near recommendations)."""
    calls = []
    for name in ("indexed", "with_endpoints"):
        monkeypatch.setattr(rules, name, lambda *a, f=getattr(rules, name), n=name, **k: calls.append(n) or f(*a, **k))
    catalog.queries()["conformance_summary"](spark, FOLDER)
    assert sorted(calls) == ["indexed", "with_endpoints", "with_endpoints"]


def test_components_are_dealt_by_the_number_of_edges(spark, monkeypatch):
    """a task joins and counts so many edges at most, whatever few bytes Spark packs them into; counting deals them no further."""
    monkeypatch.setattr(graph, "ROWS_OF_A_TASK", 500)
    df = catalog.queries()["kit_components"](spark, FOLDER)
    tasks = -(-spark.read.parquet(f"{FOLDER}/lineitem.parquet").count() // 500)
    found = [x for x in plan(df).splitlines() if "Exchange hashpartitioning(" in x and "REPARTITION_BY_NUM" in x]
    assert tasks > spark.sparkContext.defaultParallelism and len(found) == 2 and all(f", {tasks})" in x for x in found) and "hashpartitioning(kit#" not in plan(df)
    compare(spark, "kit_components", catalog.queries()["kit_components"], catalog.oracle_sql()["kit_components"], FOLDER)


def test_of_extracted_graphs_only_what_rules_look_at_is_kept(spark, monkeypatch):
    """F1 of round 4: with more documents than go to every task; parsed files are removed, and edges are dealt by their ends without their texts."""
    monkeypatch.setattr(frontier, "MOST_LOCAL", 100)
    before = len(WRITTEN)
    compare(spark, "extracted_findings", catalog.queries()["extracted_findings"], catalog.oracle_sql()["extracted_findings"], FOLDER)
    left = [set(spark.read.parquet(p).columns) for p in WRITTEN[before:]]
    assert not [c for c in left if c & {"label", "rules", "attributes"}] and [c for c in left if "__marks" in c]


def test_blocks_of_a_guide_are_not_sent_to_every_task(spark, monkeypatch):
    """F2 of round 4: blocks of all instances meet the index by a merge; they are many times the tables that they are made of, by which Spark would judge them."""
    plans = []
    monkeypatch.setattr(extraction, "written", lambda df, f=extraction.written: plans.append(plan(df)) or f(df))
    catalog.queries()["guide_graph"](spark, FOLDER)
    assert [p for p in plans if "SortMergeJoin [path#" in p and "pos#" in p] and not [x for p in plans for x in p.splitlines() if "BroadcastHashJoin [path#" in x]


def test_parts_of_documents_are_packed(spark):
    """F3 of round 4: lines of a document repeat each other; as plain text they were a hundred GB."""
    files = catalog.queries()["documents_round_trip"](spark, FOLDER).inputFiles()
    assert files and all(f.endswith(".gz") for f in files)
