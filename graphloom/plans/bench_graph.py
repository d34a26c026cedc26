"""One graph over the trade tables, for every operator that works on graphs; and the same graph as SQL.

Nodes are regions and nations (document geo), customers and suppliers (party), parts and orders (trade). Edges:
nation partOf region; customer, supplier locatedIn nation; order placedBy customer; order contains part (one for
each line, so parallel edges are many); part suppliedBy supplier; order supersedes the customer's order before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.model import Model, make_model

VERSION = "1"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


NODES_SQL = """
nodes AS (
  SELECT 'geo' AS doc_id, CAST(r_regionkey AS BIGINT) AS ord, concat('region/', r_regionkey) AS id, 'region' AS type, r_name AS label, 'derived' AS derivation, CAST(NULL AS {text}) AS note, CAST(NULL AS {text}) AS ev_location, CAST(NULL AS {text}) AS ev_by, 'geo' AS layer FROM region
  UNION ALL SELECT 'geo', 100 + n_nationkey, concat('nation/', n_nationkey), 'nation', n_name, 'derived', NULL, NULL, NULL, 'geo' FROM nation
  UNION ALL SELECT 'party', c_custkey, concat('customer/', c_custkey), 'customer', c_name, CASE WHEN c_acctbal < 0 THEN 'inferred' ELSE 'derived' END, CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END, CASE WHEN c_nationkey % 4 = 0 THEN c_mktsegment END, NULL, 'party' FROM customer
  UNION ALL SELECT 'party', 10000000000 + s_suppkey, concat('supplier/', s_suppkey), 'supplier', s_name, 'derived', NULL, NULL, NULL, 'party' FROM supplier
  UNION ALL SELECT 'trade', p_partkey, concat('part/', p_partkey), 'part', p_name, CASE WHEN p_size > 40 THEN 'inferred' ELSE 'derived' END, p_brand, NULL, NULL, 'trade' FROM part
  UNION ALL SELECT 'trade', 10000000000 + o_orderkey, concat('order/', o_orderkey), 'order', o_orderpriority,
    CASE o_orderstatus WHEN 'F' THEN 'derived' WHEN 'O' THEN 'inferred' ELSE 'decided' END, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END,
    CASE WHEN o_orderkey % 2 = 0 THEN 'ledger' END, CASE WHEN o_orderkey % 4 = 0 THEN 'clerk' END, 'trade' FROM orders),
edges AS (
  SELECT 'geo' AS doc_id, CAST(n_nationkey AS BIGINT) AS ord, 'partOf' AS predicate, concat('nation/', n_nationkey) AS source, concat('region/', n_regionkey) AS target, CAST(NULL AS {text}) AS qualifier, 'derived' AS derivation, CAST(NULL AS {text}) AS note, CAST(NULL AS {text}) AS ev_location, CAST(NULL AS {text}) AS ev_by, CAST(NULL AS {text}) AS status FROM nation
  UNION ALL SELECT 'party', c_custkey, 'locatedIn', concat('customer/', c_custkey), concat('nation/', c_nationkey), NULL, 'derived', NULL, NULL, NULL, 'resolved' FROM customer
  UNION ALL SELECT 'party', 10000000000 + s_suppkey, 'locatedIn', concat('supplier/', s_suppkey), concat('nation/', s_nationkey), NULL, 'inferred', s_name, NULL, NULL, CASE WHEN s_acctbal < 0 THEN 'unresolved' ELSE 'resolved' END FROM supplier
  UNION ALL SELECT 'trade', o_orderkey, 'placedBy', concat('order/', o_orderkey), concat('customer/', o_custkey), NULL, CASE o_orderstatus WHEN 'F' THEN 'derived' WHEN 'O' THEN 'inferred' ELSE 'decided' END,
    NULL, CASE WHEN o_orderkey % 2 = 0 THEN 'ledger' END, CASE WHEN o_orderkey % 4 = 0 THEN 'clerk' END, CASE WHEN o_orderkey % 5 = 0 THEN 'ambiguous' WHEN o_orderkey % 7 = 0 THEN 'odd' ELSE 'resolved' END FROM orders
  UNION ALL SELECT 'trade', 10000000000 + l_orderkey * 10 + l_linenumber, 'contains', concat('order/', l_orderkey), concat('part/', l_partkey), l_returnflag, CASE l_linestatus WHEN 'O' THEN 'inferred' ELSE 'derived' END,
    CASE WHEN l_tax > 0.02 THEN 'line' END, NULL, NULL, NULL FROM lineitem
  UNION ALL SELECT DISTINCT 'trade', 30000000000 + l_partkey, 'suppliedBy', concat('part/', l_partkey), concat('supplier/', l_suppkey), CAST(NULL AS {text}), 'derived', CAST(NULL AS {text}), CAST(NULL AS {text}), CAST(NULL AS {text}), CAST(NULL AS {text}) FROM lineitem
  UNION ALL SELECT 'trade', 20000000000 + o_orderkey, 'supersedes', concat('order/', o_orderkey), concat('order/', prior), NULL, 'derived', NULL, NULL, NULL, NULL
    FROM (SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prior FROM orders) WHERE prior IS NOT NULL)"""


def graph_sql() -> str:
    """CTEs nodes and edges for DuckDB."""
    return NODES_SQL.replace("{text}", "VARCHAR")


def bench_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges). Both are plain projections of the tables; only `supersedes` and `suppliedBy` shuffle."""
    cte = NODES_SQL.replace("{text}", "STRING")
    head, rest = cte.split("SELECT DISTINCT 'trade'")  # what it selects tells the two keys apart: those are made distinct, before there are texts
    rest = rest.replace("FROM lineitem", "FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)", 1)
    cte = f"{head}SELECT 'trade'{rest}"
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        cte = cte.replace(f"FROM {t}", f"FROM parquet.`{sf_dir}/{t}.parquet`")
    evidence = "CASE WHEN ev_location IS NOT NULL THEN named_struct('location', ev_location, 'quote', CAST(NULL AS STRING), 'artifact', CAST(NULL AS STRING), 'by', ev_by, 'at', CASE WHEN ev_by IS NOT NULL THEN '2024-01-01' END) END AS evidence"
    tail = "'{}' AS properties, CAST(NULL AS STRING) AS flag_ref"
    nodes = spark.sql(f"WITH {cte} SELECT doc_id, ord, id, type, label, derivation, note, {evidence}, layer, {tail} FROM nodes")
    edges = spark.sql(f"WITH {cte} SELECT doc_id, ord, predicate, source, target, qualifier, derivation, note, {evidence}, status, CASE WHEN status IS NULL THEN '{{}}' ELSE concat('{{\"resolutionStatus\":\"', status, '\"}}') END AS properties, CAST(NULL AS STRING) AS flag_ref FROM edges")
    return nodes, edges


def bench_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d, d, VERSION) for d in ("geo", "party", "trade")], "doc_id string, layer string, ontology_version string")


def bench_model(spark: SparkSession) -> Model:
    """The model of the bench graph. It licenses no suppliedBy and returns of kind R only, and asks for more than some rows have."""
    kinds = [("geo", "region"), ("geo", "nation"), ("party", "customer"), ("party", "supplier"), ("trade", "part"), ("trade", "order")]
    return make_model(
        spark,
        classes=[(layer, k, "Thing", None, None, "inferred" if k == "customer" else None) for layer, k in kinds],
        predicates=[(layer, p, False) for layer, p in (("geo", "partOf"), ("party", "locatedIn"), ("trade", "placedBy"), ("trade", "contains"), ("trade", "supersedes"), ("trade", "refines"))],
        licensed=[("geo", "partOf", "nation", "region", None, None), ("party", "locatedIn", "customer", "nation", None, "inferred"), ("party", "locatedIn", "customer", "nation", None, "decided"), ("party", "locatedIn", "supplier", "nation", None, "inferred"), ("trade", "placedBy", "order", "customer", None, None), ("trade", "contains", "order", "part", "R", None), ("trade", "contains", "order", "part", "N", None), ("trade", "supersedes", "order", "order", None, None)],
        codes=[("resolution-status", c) for c in ("resolved", "unresolved", "ambiguous")],
        imports=[("geo", None, "1", "n"), ("party", "geo", "1", "n"), ("trade", "party", "1", "n")],
        kinds=[("geo", "Thing", "anything")],
    )


def one_layer(spark: SparkSession, layer: str, types: DataFrame) -> tuple[DataFrame, Model]:
    """(documents, model) of one document and layer with the classes in types (type)."""
    m = make_model(spark, imports=[(layer, None, VERSION, "n")])
    m.classes = types.select(F.lit(layer).alias("layer"), F.col("type").alias("id")).distinct().withColumns({c: F.lit(None).cast("string") for c in ("kind", "elaborates", "iri_pattern", "min_derivation")})
    return spark.createDataFrame([(layer, layer, VERSION)], "doc_id string, layer string, ontology_version string"), m
