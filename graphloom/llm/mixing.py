"""Mixing sources to target weights by repeating and dropping whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm._shared import on_plain_names, table
from graphloom.llm._words_sql import word_count

ADDED = ["size", "source_size", "target", "rate", "copies", "taken"]


def draw(key: Column, seed: str = "mix") -> Column:
    """A number in [0, 1) that only the key and the seed decide: 52 bits of MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def source_targets(sizes: DataFrame, source: str, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, target, rate): target = least(most * size, level * weight), where the level is such
    that targets add up to share * all sizes. A source that would exceed its limit stops there and the excess is
    shared again by weight; with sources in order of limit / weight that level is the largest of the levels that
    are left after each of them. One row a source is ordered in one task; documents are not."""
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    limit = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))).withColumn("cap", most * F.col("source_size"))
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col(source).asc_nulls_last())
    every = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = limit.withColumn("level", (share * F.sum("source_size").over(every) - before) / after)
    target = F.least(F.col("cap"), F.col("w") * F.max("level").over(every))
    out = level.withColumn("target", F.greatest(target, F.lit(0.0)))
    return out.select(source, "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))


def _mixed(docs: DataFrame, key: str, text: str, source: str, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    docs = docs.withColumn("size", word_count(F.col(text)))
    sizes = docs.groupBy(source).agg(F.sum("size").alias("source_size"))
    targets = table(source_targets(sizes, source, weights, share, most).withColumnRenamed(source, "__source").coalesce(1))
    out = docs.join(targets, F.col(source).eqNullSafe(F.col("__source"))).drop("__source")
    whole = F.floor("rate")
    out = out.withColumn("copies", (whole + F.when(draw(F.col(key)) < F.col("rate") - whole, 1).otherwise(0)).cast("long"))
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """docs with size (words), source_size, target (words of the source), rate, copies and taken = copies * size.

    copies = floor(rate) + 1 with probability rate - floor(rate), drawn from the key alone, so reruns agree and
    rows with one key share a draw. Sources weigh `weights` in turn by code point, null last. Null texts have
    size 0. A source without words has rate 0. Documents are joined to one row a source, read from a written
    table: Spark broadcasts it only if its known size allows that. Columns of docs named like an added one are
    replaced, others may have any name.
    """
    return on_plain_names(docs, lambda d, k, t, s: _mixed(d, k, t, s, weights, share, most), key, text, source, added=ADDED)


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself: each row of docs as often as its copies say, with the columns of docs as they are."""

    def run(d: DataFrame, k: str, t: str, s: str) -> DataFrame:
        out = _mixed(d, k, t, s, weights, share, most)
        return out.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))

    return on_plain_names(docs, run, key, text, source)
