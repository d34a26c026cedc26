"""Connected components of a table of links, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm._shared import table


def components(links: DataFrame) -> DataFrame:
    """(node, label) for each node of links (a, b): label is the least node that it can reach.

    Each round takes the least label among neighbours and then the label's own label, so a path of n links
    ends after about log n rounds. Each round is written to the shared folder. Nodes without links are absent.
    """
    ends = links.where("a <> b").select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
    edges = table(ends.select("e.a", "e.b").distinct())
    labels = table(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label"), F.lit(True).alias("moved")))
    while labels.where("moved").limit(1).count():
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "m").alias("new"))
        over = labels.select(F.col("node").alias("new"), F.col("label").alias("jump"))
        labels = table(step.join(over, "new").select("node", F.least("new", "jump").alias("label"), (F.least("new", "jump") != F.col("label")).alias("moved")))
    return labels.select("node", "label")
