"""Tables in buckets by a key, of which a change replaces only those that it touches.

A store is a folder. Each change is a generation: it writes the buckets that it touches, whole, below its own number, and then a small
table of heads that says, for each table and bucket, in which generation it lives. A reader follows the last heads that were
written to the end, so it sees all of a change or nothing of it; a change that was cut off leaves files that nothing points to. Two stores' or
generations' heads tell which buckets are the same without reading them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


HEADS = "name string, bucket int, place string"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _with_bucket(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("__bucket", IntegerType())])


@dataclass
class Store:
    """keys: the column that each table is dealt by. buckets: a number for the life of the store; a bucket is the least that a change rewrites."""

    spark: SparkSession
    path: str
    keys: dict[str, str]
    buckets: int = 64
    schemas: dict = field(default_factory=dict)
    at: str | None = None  # the heads that this object reads

    def heads(self) -> dict[tuple[str, int], str]:
        """At most tables times buckets rows."""
        if self.at is None:
            return {}
        return {(r.name, r.bucket): r.place for r in self.spark.read.schema(HEADS).parquet(self.at).collect()}

    def read(self, name: str, buckets: set[int] | None = None) -> DataFrame:
        """A table, or some buckets of it: no other file is opened."""
        places = sorted(p for (n, b), p in self.heads().items() if n == name and (buckets is None or b in buckets))
        if not places:
            return self.spark.createDataFrame([], self.schemas[name])
        return self.spark.read.schema(self.schemas[name]).parquet(*places)

    def touched(self, name: str, changed: DataFrame) -> set[int]:
        """Buckets of a table that hold the keys in changed: at most as many numbers as there are buckets."""
        return {r[0] for r in changed.select(bucket_of(self.keys[name], self.buckets)).distinct().collect()}

    def near(self, name: str, changed: DataFrame) -> DataFrame:
        """Rows of a table whose key stands in changed; only their buckets are read."""
        key = self.keys[name]
        return self.read(name, self.touched(name, changed)).join(changed.select(key).distinct(), key, "left_semi")

    def write(self, **tables: DataFrame) -> None:
        """All rows of some tables: the first generation."""
        self._commit({name: (t, None) for name, t in tables.items()})

    def replace(self, **changes: tuple[DataFrame, DataFrame]) -> None:
        """For some tables (rows, keys): rows take the place of those whose key stands in keys. Their buckets are read and written anew, no others."""
        self._commit({name: (rows, keys) for name, (rows, keys) in changes.items()})

    def _commit(self, changes: dict[str, tuple[DataFrame, DataFrame | None]]) -> None:
        made, heads = f"{self.path}/{uuid.uuid4().hex}", self.heads()
        for name, (rows, keys) in changes.items():
            key = self.keys[name]
            self.schemas.setdefault(name, rows.schema)
            rows = rows.select(*self.schemas[name].fieldNames())
            hit = set(range(self.buckets))
            if keys is not None:
                hit = self.touched(name, keys.select(key).union(rows.select(key)))
                rows = self.read(name, hit).join(keys.select(key).distinct(), key, "left_anti").unionByName(rows)
            out = f"{made}/{name}"
            rows.withColumn("__bucket", bucket_of(key, self.buckets)).repartition("__bucket").write.partitionBy("__bucket").parquet(out)
            there = self.spark.read.schema(_with_bucket(self.schemas[name])).parquet(out)  # of an empty table there is no file
            full = {r[0] for r in there.select("__bucket").distinct().collect()}
            for b in hit:
                heads.pop((name, b), None)
                if b in full:
                    heads[name, b] = f"{out}/__bucket={b}"
        last = f"{made}/heads"
        self.spark.createDataFrame([(n, b, p) for (n, b), p in sorted(heads.items())], HEADS).coalesce(1).write.parquet(last)
        self.at = last


def changed_rows(old: Store, new: Store, name: str) -> tuple[DataFrame, DataFrame]:
    """D-02: (old rows, new rows) of the buckets that two states of a store do not share; the rest is equal and not read."""
    a, b = old.heads(), new.heads()
    differ = {k for k in {*a, *b} if k[0] == name and a.get(k) != b.get(k)}
    return tuple(s.read(name, {bucket for _, bucket in differ}) for s in (old, new))


