"""Shards by a hierarchical weighted hash tree, in DataFrame functions only.

Shards are the leaves of a tree of regions and racks. A document descends it: at each level every child draws
-ln(u) / weight from a hash of the document's key and the child's place, and the least draw wins. A child's
weight is the number (or capacity) of the shards below it. A change of weights moves documents only into
subtrees whose weight grows and out of those whose weight falls. Shards beyond the last full region are regions
of their own, and so is one more shard: it takes documents only into itself, whatever the number of shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RACKS, PER_RACK = 3, 2
PARTS = 64
"""Hash ranges that a shard is numbered in: a constant, so that slots hang on the rows alone."""
ADDED = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def tree(shards: int, opened: int | None = None, racks: int = RACKS, per_rack: int = PER_RACK) -> list[list[int]]:
    """Number of shards in each rack of each region; shards are numbered in this order.

    The first `opened` shards (by default as many as fill whole regions) fill regions, each of the rest is one of its own. Who
    grows from a number of shards keeps `opened` as it was.
    """
    whole = shards // (racks * per_rack) if opened is None else opened // (racks * per_rack)
    return [[per_rack] * racks for _ in range(whole)] + [[1] for _ in range(shards - whole * racks * per_rack)]


def _winner(key: list[Column], place: list[Column], weights: Column) -> Column:
    """Number of the child with the least draw. weights: one a child, 0 for none."""

    def draw(w: Column, child: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(*place, child, *key), 11).cast("double") + 0.5) / F.lit(2.0**53)
        return F.struct(F.when(w > 0, -F.log(u) / w).otherwise(F.lit(float("inf"))).alias("d"), child.alias("c"))

    return F.array_min(F.transform(weights, draw))["c"]


def descend(docs: DataFrame, key: str, layout: list[list[int]], name: str) -> DataFrame:
    """docs with a column `name`: the shard of each key in a layout. Weights: one a shard."""
    k = [F.col(key)]
    literal = lambda rows: F.array(*[F.array(*[F.lit(x) for x in r]) for r in rows])
    regions = F.array(*[F.lit(sum(r)) for r in layout])
    before = F.array(*[F.lit(sum(sum(x) for x in layout[:i])) for i in range(len(layout))])
    out = docs.withColumn("__region", _winner(k, [F.lit(1)], regions))
    out = out.withColumn("__rack", _winner(k, [F.lit(2), F.col("__region")], F.get(literal(layout), F.col("__region"))))
    leaves = F.get(F.get(F.array(*[literal([[1] * n for n in r]) for r in layout]), F.col("__region")), F.col("__rack"))
    out = out.withColumn("__leaf", _winner(k, [F.lit(3), F.col("__region"), F.col("__rack")], leaves))
    return out.withColumn(name, (F.get(before, F.col("__region")) + F.col("__rack") * PER_RACK + F.col("__leaf")).cast("int")).drop("__region", "__rack", "__leaf")


def shard_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 24, carry: list[str] | None = None, opened: int | None = None) -> DataFrame:
    """docs (or the columns in carry) with size (UTF-8 bytes + 8), text_crc32, law = 'key', shard, slot and grown_shard.

    The key and the tree decide the shard. grown_shard is the shard with one more shard, a region of its own: equal to
    shard or the new one. slot numbers a shard's rows from 0 without gaps, by part, key and checksum; rows that are alike in
    both may swap slots. Parts are hash ranges of a shard, so that no task orders a whole shard. Null text: 8 bytes and a
    null checksum; null keys count as one key. Texts may be of any length. Columns of docs named like an added one are
    replaced, others may have any name.
    """
    layout = tree(shards, opened)
    wanted = {c.lower() for c in (docs.columns if carry is None else carry)}

    def run(d: DataFrame, k: str, t: str) -> DataFrame:
        out = d.withColumns({"size": (F.coalesce(F.octet_length(F.col(t)), F.lit(0)) + 8).cast("long"), "text_crc32": F.crc32(F.col(t).cast("binary")).cast("long"), "law": F.lit("key")})
        out = descend(descend(out, k, layout, "shard"), k, [*layout, [1]], "grown_shard")
        out = out.withColumn("__part", F.pmod(F.xxhash64(F.col(k), F.col("text_crc32"), F.col("size")), F.lit(PARTS)).cast("int")).withColumn("__key", F.col(k))
        held = [c for c, n in zip(d.columns, docs.columns, strict=True) if n.lower() in wanted]
        out = out.select(*held, "__key", "size", "text_crc32", "law", "shard", "grown_shard", "__part")
        counts = out.groupBy("shard", "__part").agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
        starts = counts.select("shard", "__part", F.coalesce(before, F.lit(0)).alias("__start"))
        own = Window.partitionBy("shard", "__part").orderBy("__key", "text_crc32")
        out = out.withColumn("__at", F.row_number().over(own) - 1).join(starts, ["shard", "__part"])
        return out.withColumn("slot", (F.col("__start") + F.col("__at")).cast("long"))

    names = [c for c in docs.columns if c.lower() in wanted and c.lower() not in ADDED]
    places = {n: f"c{i}" for i, n in enumerate(docs.columns)}
    out = run(docs.toDF(*places.values()), places[key], places[text])
    return out.select(*[places[n] for n in names], *ADDED).toDF(*names, *ADDED)
