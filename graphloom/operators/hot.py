"""Ids that much of a graph hangs on, joined apart from the rest.

A sketch of frequent items, built where the rows are and merged by Spark, names the hot ids: at most `most` of them, so that what a table
says of them is a small relation of known size that goes to every task. Rows with a hot id keep their tasks or are dealt by their other
columns; all others are dealt by the id. One pass over the rows for the sketch, and no row is read or joined twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST = 1000


def hot_ids(t: DataFrame, key: str, share: float = 0.01, most: int = MOST, tracked: int = 10_000) -> DataFrame:
    """(key): values that stand in a share or more of t's rows; nulls are no value. `tracked` counters go from each task.

    No value of that share is missed while share exceeds 2 / tracked; the sketch may count a value too high, so that one of less share is named too.
    A value named or missed changes only where its rows are joined, never what they give.
    """
    if not 2 / tracked < share or most * share < 1:
        raise ValueError("share has to be above 2 / tracked, and most at least 1 / share")
    kind = t.schema[key].dataType
    top = t.where(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top"), F.count("*").alias("n"))
    found = [r[0] for r in top.select(F.explode("top").alias("x"), "n").where(F.col("x.count") >= share * F.col("n")).select("x.item").collect()]  # at most `most`
    return t.sparkSession.createDataFrame([(x,) for x in found], f"`{key}` {kind.simpleString()}")


def look_up(t: DataFrame, table: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """t with the columns of table, of which each key has one row at most; nulls where it has none. The key is a text. hot: (key), from `hot_ids`.

    A row with a hot key is dealt by a hash of the whole row. Repeated rows of one key go together; where those alone are many, t should have a column that tells them apart.
    """
    values = [c for c in table.columns if c != key]
    told = F.struct(*values)
    few = table.join(F.broadcast(hot), key, "left_semi").select(key, told.alias("__hot"))  # as many rows as hot has, at most
    rest = table.join(F.broadcast(hot), key, "left_anti").select(F.col(key).alias("__key"), told.alias("__rest"))
    spread = F.concat(F.lit("\0"), F.xxhash64(*t.columns).cast("string"))
    out = t.join(F.broadcast(few), key, "left").withColumn("__key", F.when(F.col("__hot").isNotNull() | F.col(key).isNull(), spread).otherwise(F.col(key)))
    out = out.join(rest, "__key", "left")
    found = F.when(F.col("__hot").isNotNull(), F.col("__hot")).when(F.col(key) == F.col("__key"), F.col("__rest"))
    return out.select(*t.columns, *[found[v].alias(v) for v in values])
