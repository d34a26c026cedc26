"""Where intermediate tables go, and small helpers that all operators use."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only if that is unset and Spark runs in one process."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = spark.conf.get("spark.graphloom.folder", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="graphloom-")
        spark.conf.set("spark.graphloom.folder", folder)
    return folder


WRITTEN: list[str] = []
"""Paths of the tables that this process has written and not yet removed."""


def table(df: DataFrame) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/graphloom-{uuid.uuid4().hex}"
    WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """df without the columns that an operator is about to add: results replace input columns of the same name."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def remove_tables(spark: SparkSession, since: int = 0) -> None:
    """Remove intermediate tables written since a length of WRITTEN. Call it when nothing reads them any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while len(WRITTEN) > since:
        path = hadoop(WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)


def on_plain_names(docs: DataFrame, run: Callable[..., DataFrame], *roles: str, added: list[str] = []) -> DataFrame:
    """run(docs with columns c0, c1, ..., the plain names of the roles), with the names of docs put back and what run added after them.

    Names of docs may clash with those that an operator uses, or hold dots. added: columns of run's result to keep; they
    replace columns of docs of the same name, in any case.
    """
    names = docs.columns
    low = {a.lower() for a in added}
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    out = run(plain, *[f"c{names.index(r)}" for r in roles])
    kept = [(f"c{i}", n) for i, n in enumerate(names) if n.lower() not in low]
    return out.select(*[F.col(c) for c, _ in kept], *added).toDF(*[n for _, n in kept], *added)
