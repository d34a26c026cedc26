"""Recursive questions as loops over a frontier. Each round is a join of the newest rows with the edges; rounds are
written to the shared folder, so neither the plan nor a lost executor brings earlier rounds back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where that is unset and Spark runs in one process."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = spark.conf.get("spark.graphloom.folder", None)
    if folder:
        return folder
    folder = tempfile.mkdtemp(prefix="graphloom-")
    spark.conf.set("spark.graphloom.folder", folder)
    return folder


WRITTEN: list[str] = []
"""Paths of the tables that this process has written on its way and not yet removed."""


def written(df: DataFrame) -> DataFrame:
    """df in the shared folder, read again: cuts the lineage and outlives executors. `remove_written` clears it away."""
    path = f"{shared_folder(df.sparkSession)}/graphloom-{uuid.uuid4().hex}"
    WRITTEN.append(path)
    df.write.option("compression", "zstd").parquet(path)  # half of what hashes and ids take by Spark's own choice
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_written(spark: SparkSession, since: int = 0) -> None:
    """Remove what was written on the way since a length of WRITTEN: call it when results that read it have been stored."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while len(WRITTEN) > since:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)


def remove_between(spark: SparkSession, since: int, until: int) -> None:
    """`remove_written` of what was written on the way from one length of WRITTEN to another; what came after stays."""
    later = WRITTEN[until:]
    del WRITTEN[until:]
    remove_written(spark, since)
    WRITTEN.extend(later)


def let_go(spark: SparkSession) -> None:
    """Files of shuffles that nothing refers to any more. Spark removes them when the driver happens to collect its garbage, in half an hour at the latest: of one job after another all would stay."""
    spark.sparkContext._jvm.System.gc()


MOST_LOCAL = 10_000
"""Rows of a table that `kept` holds in the plan itself."""


def kept(df: DataFrame) -> DataFrame:
    """df worked out once: a table of few rows becomes part of the plan, so that Spark knows its size and joins it without a shuffle; others are written."""
    few = df.limit(MOST_LOCAL + 1).toArrow()
    return written(df) if few.num_rows > MOST_LOCAL else df.sparkSession.createDataFrame(few, df.schema)


def at_hand(df: DataFrame) -> DataFrame:
    """`kept`, for a slim table that most rows of another hang on: of few rows it goes to every task, so that those are not dealt by it. Documents may be three, of which one holds nearly all rows."""
    here = len(WRITTEN)
    out = kept(df)
    return out if len(WRITTEN) > here else F.broadcast(out)


def reach(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """(seed, node, depth): all nodes on paths along edges (source, target) from each seed (seed), the seed itself at depth 0.

    Safe with cycles: a node is met once for each seed, at its least depth.
    """
    links = edges.select(F.col("source").alias("node"), F.col("target").alias("next")).distinct()
    front = written(seeds.select("seed", F.col("seed").alias("node"), F.lit(0).alias("depth")).distinct())
    met = front
    while not front.isEmpty():
        step = front.join(links, "node").select("seed", F.col("next").alias("node"), (F.col("depth") + 1).alias("depth")).distinct()
        front = written(step.join(met.select("seed", "node"), ["seed", "node"], "left_anti"))
        met = met.unionByName(front)
    return met


def closure(edges: DataFrame) -> DataFrame:
    """(source, target) for each pair with a path of one edge or more; source = target where a cycle runs through it.

    Each round doubles the length: paths of exactly n edges are joined with themselves, and those shorter than n with them, so that a
    pair with one path is formed once. A round that adds no pair ends it; the number of rounds grows with the logarithm of the longest path.
    """

    def through(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.select("source", F.col("target").alias("mid")).join(b.select(F.col("source").alias("mid"), "target"), "mid").select("source", "target")

    power = pairs = written(edges.select("source", "target").distinct())
    found = pairs.count()
    while found:
        power = written(through(power, power).distinct())
        pairs = written(pairs.union(power).union(through(pairs, power)).distinct())
        before, found = found, pairs.count()
        if found == before:
            break
    return pairs


def first_hop(edges: DataFrame, predicates: list[str], order: list[str]) -> DataFrame:
    """One out-edge a node: of the first predicate that it has, the first by order."""
    turn = F.array_position(F.array(*[F.lit(p) for p in predicates]), F.col("predicate"))
    own = Window.partitionBy("source").orderBy(turn, *order)
    return edges.where(F.col("predicate").isin(predicates)).withColumn("__n", F.row_number().over(own)).where("__n = 1").drop("__n")


def follow(seeds: DataFrame, hops: DataFrame, last: str | None = None) -> DataFrame:
    """(seed, step, source, predicate, target, derivation): the walk from each seed along one hop a node. It ends after a step of the predicate `last` or onto a node met before."""
    h = hops.select("source", "predicate", "target", "derivation")
    front = written(seeds.select("seed", F.col("seed").alias("at"), F.lit(0).alias("step")).distinct())
    met, walk = front.select("seed", "at"), None
    while not front.isEmpty():
        taken = written(front.join(h, front["at"] == h["source"]).select("seed", (F.col("step") + 1).alias("step"), "source", "predicate", "target", "derivation"))
        walk = taken if walk is None else walk.unionByName(taken)
        on = taken if last is None else taken.where(F.col("predicate") != last)
        front = written(on.select("seed", F.col("target").alias("at"), "step").join(met, ["seed", "at"], "left_anti"))
        met = met.unionByName(front.select("seed", "at"))
    return walk.select("seed", "step", "source", "predicate", "target", "derivation")
