"""Searches by index against scans, and joins with hot ids apart against plain joins."""

import statistics

import pytest
from pyspark.sql import functions as F

from graphloom.operators import graph, hot, text_index


def nodes(spark):
    rows = [(f"d/{i % 3}", i, f"urn:x/Part-{i}", ("part", "order", None)[i % 3], (None, "", "Große Übersicht", "red\nblue", "aaaa", "a_b%c")[i % 6], ('{"colourName": 1}', "{}", None)[i % 3]) for i in range(60)]
    rows += [("d/9", 0, "urn:x/Part-3", "part", "again", "{}"), ("d/9", 1, "urn:y", "x", "𝔘𝔫𝔦 " + "very long " * 20_000 + "the end", "{}")]
    return spark.createDataFrame(rows, "doc_id string, ord int, id string, type string, label string, properties string")


def test_index_gives_what_a_scan_gives(spark, tmp_path):
    n = nodes(spark)
    index = text_index.build_index(n, "id", text_index.node_texts, str(tmp_path), buckets=8)
    none = spark.createDataFrame([], "source string, target string")
    at = lambda df: sorted((r.doc_id, r.ord) for r in df.collect())
    for text in ("part-1", "PART", "übersicht", "d\nb", "aaaa", "aaaaa", "aa", "", "colourname", "_b%", "the end", "𝔫𝔦 ", "nowhere", "urn:x/part-59", "long very"):
        assert at(index.search(text)) == at(graph.search(n, none, text)[0]), text


def test_index_opens_few_files(spark, tmp_path):
    index = text_index.build_index(nodes(spark), "id", text_index.node_texts, str(tmp_path), buckets=8)
    assert len([f for f in index.search("urn:x/part-59").inputFiles() if "/rows/" in f]) == 1
    assert "In(gram" in index.candidates("part-59")._jdf.queryExecution().toString()


def test_index_of_nothing(spark, tmp_path):
    index = text_index.build_index(nodes(spark).limit(0), "id", text_index.node_texts, str(tmp_path), buckets=4)
    assert index.search("part").isEmpty() and index.search("a").isEmpty()


def test_hot_ids_are_found(spark):
    t = spark.range(30_000).selectExpr("CASE WHEN id % 2 = 0 THEN 'hub' WHEN id % 10 = 1 THEN 'small hub' WHEN id % 10 = 3 THEN NULL ELSE concat('n', id) END AS id")
    assert {r.id for r in hot.hot_ids(t, "id", 0.05).collect()} == {"hub", "small hub"}
    assert hot.hot_ids(t.limit(0), "id").isEmpty()
    with pytest.raises(ValueError):
        hot.hot_ids(t, "id", 0.0001)


def test_no_task_holds_the_hub(spark):
    """Half of all rows at one id: the plain join puts them into one task, this one does not, and both give the same rows."""
    t = spark.range(40_000).selectExpr("id AS n", "CASE WHEN id % 2 = 0 THEN 'hub' WHEN id % 9 = 1 THEN NULL ELSE concat('n', id % 3000) END AS target")
    table = spark.range(2500).selectExpr("concat('n', id) AS target", "id AS place", "IF(id % 3 = 0, NULL, 'kind') AS type").union(spark.sql("SELECT 'hub', -1L, 'big'"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(before, ("false", "-1", "16")):
            spark.conf.set(k, v)
        ids = hot.hot_ids(t, "target", 0.01)
        got = hot.look_up(t, table, "target", ids)
        sizes = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        ours, plain = sizes(got.withColumn("m", F.col("n") + 1)), sizes(t.join(table, "target", "left").withColumn("m", F.col("n") + 1))
        assert max(ours) <= 3 * statistics.median(ours) and max(plain) > 3 * statistics.median(plain)
        rows = lambda df: sorted((r.n, r.target or "", r.place or 0, r.type or "") for r in df.collect())
        assert rows(got) == rows(t.join(table, "target", "left"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_no_hot_ids(spark):
    t = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "id string, n int")
    table = spark.createDataFrame([("a", "x")], "id string, v string")
    got = hot.look_up(t, table, "id", t.select("id").limit(0))
    assert sorted((r.n, r.v) for r in got.collect()) == [(1, "x"), (2, None), (3, None)]
