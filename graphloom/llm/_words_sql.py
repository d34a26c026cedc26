"""Word counts and word arrays as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATORS = " \t\n\x0b\f\r"
GAPS = r"[\x20\x09-\x0D]+"


def bare(text: Column) -> Column:
    """text without separators at its ends; null is as empty."""
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(SEPARATORS))


def word_array(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of text."""
    return F.when(bare(text) == "", F.array().cast("array<string>")).otherwise(F.split(bare(text), GAPS))


def word_count(text: Column) -> Column:
    return F.when(bare(text) == "", F.lit(0)).otherwise(F.size(F.split(bare(text), GAPS))).cast("long")


def count_of(text: Column, characters: str) -> Column:
    """How many code points of text are among characters."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")
