"""A written index of short texts, for searches that open only what may hold the text sought.

Postings are (gram, key): each three characters in a row that stand in one of a row's texts, lower-cased. They are dealt by ranges of gram and
key and sorted, so that a frequent gram is split over files and a search reads by the statistics of the files the row groups that hold its
grams. Rows lie in a store in buckets by key, and only buckets with candidates are opened. A candidate holds all grams; what it
really holds is verified on the row. A text sought of fewer than three characters has no gram: then all rows are looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.store import Store


def node_texts() -> Column:
    """PRJ-03: id, label, type and names of properties."""
    names = F.coalesce(F.json_object_keys("properties"), F.array().cast("array<string>"))
    return F.concat(F.array("id", "label", "type"), names)


def grams_of(rows: DataFrame, key: str, texts: Column) -> DataFrame:
    """(gram, key), each once a row; rows of one key may repeat it. No shuffle: a row's texts are all there."""
    letters = F.transform(texts, lambda t: F.split(F.lower(t), ""))  # once a text, each then bound to c
    three = lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - 3), lambda i: F.concat(F.get(c, i), F.get(c, i + 1), F.get(c, i + 2)))
    held = F.flatten(F.array_compact(F.transform(letters, lambda c: F.when(F.size(c) >= 3, three(c)))))
    return rows.select(F.explode(F.array_distinct(held)).alias("gram"), F.col(key).alias("key"))


@dataclass
class TextIndex:
    """key: a column that is not null; several rows may share one. texts: gives an array of texts of a row; null texts hold nothing."""

    store: Store
    postings: str
    key: str
    texts: Callable[[], Column]

    def candidates(self, text: str) -> DataFrame | None:
        """(key) of rows that hold all grams of a text; None where it has none."""
        word = text.lower()
        grams = sorted({word[i : i + 3] for i in range(len(word) - 2)})
        if not grams:
            return None
        there = self.store.spark.read.parquet(self.postings).where(F.col("gram").isin(grams))
        return there.groupBy("key").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(grams)).select(F.col("key").alias(self.key))

    def search(self, text: str) -> DataFrame:
        """Rows with the text in one of their texts, whatever the case: what a scan gives."""
        some = self.candidates(text)
        rows = self.store.read("rows") if some is None else self.store.near("rows", some)
        word = text.lower()
        return rows.where(F.exists(self.texts(), lambda t: F.coalesce(F.lower(t).contains(word), F.lit(False))))


def build_index(rows: DataFrame, key: str, texts: Callable[[], Column], path: str, buckets: int = 64) -> TextIndex:
    """Index rows by the texts that `texts` takes from each: one shuffle of their grams, one of the rows."""
    spark = rows.sparkSession
    grams = grams_of(rows, key, texts())
    grams.repartitionByRange("gram", "key").sortWithinPartitions("gram", "key").write.parquet(f"{path}/postings")
    store = Store(spark, f"{path}/rows", {"rows": key}, buckets)
    store.write(rows=rows)
    return TextIndex(store, f"{path}/postings", key, texts)
