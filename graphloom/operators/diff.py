"""What changed between two snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.ids import strip_path


def normalise(t: DataFrame, paths: list[str], dropped: list[str]) -> DataFrame:
    """D-01: without columns that change on every run, and paths without their folders."""
    return t.drop(*dropped).withColumns({p: strip_path(F.col(p)) for p in paths})


def canonical(columns: list[str]) -> Column:
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def changes(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """D-02, SET-03: (keys, change): gone, added or changed, by key; rows that are alike are left out."""
    side = lambda t, n: t.select(*keys, canonical(columns).alias(n))
    both = side(a, "old").join(side(b, "new"), keys, "full_outer")
    change = F.when(F.col("new").isNull(), "gone").when(F.col("old").isNull(), "added").when(F.col("old") != F.col("new"), "changed")
    return both.withColumn("change", change).where("change IS NOT NULL").select(*keys, "change")


def last_per_key(t: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    own = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return t.withColumn("__n", F.row_number().over(own)).where("__n = 1").drop("__n")


def field_changes(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """D-03: (keys, field, old, new) for each field that differs between rows of one key."""
    side = lambda t, n: t.select(*keys, *[F.col(c).cast("string").alias(f"{n}_{c}") for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"old_{c}").alias("old"), F.col(f"new_{c}").alias("new")) for c in columns])
    both = side(a, "old").join(side(b, "new"), keys).select(*keys, F.explode(pairs).alias("f"))
    return both.where("NOT f.old <=> f.new").select(*keys, "f.field", "f.old", "f.new")


def diff_sources(a: DataFrame, b: DataFrame, doc: str = "doc_id", hashes: str = "hashes") -> DataFrame:
    """D-04: source hashes of each document by position."""
    side = lambda t, n: t.select(doc, F.posexplode(hashes).alias("position", n))
    return side(a, "old").join(side(b, "new"), [doc, "position"], "full_outer").where("NOT old <=> new")


def diff_documents(a: DataFrame, b: DataFrame, doc: str, columns: list[str]) -> DataFrame:
    """D-05: top-level fields of documents that differ."""
    return field_changes(a, b, [doc], columns)
