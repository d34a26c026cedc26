"""How much of the normative text of a publication a graph accounts for."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.ids import squeezed

#: The closed lists of the report contract (docs/COVERAGE.md, sections 1 and 2); another list is another definition of normative.
MARKERS = [
    "should", "shall", "must", "recommend", "recommends", "recommended", "recommendation", "recommendations", "should not", "is not a reason", "are not a contraindication",
    *[f"may be {v}" for v in ("given", "administered", "offered", "considered", "used", "co-administered", "implemented")],
]
DUPLICATE = "duplicate-of"
REASONS = ["background-fact", "manufacturer-statement", DUPLICATE, "editorial", "research-question"]
BOUNDARY = r"(?<=[.!?])\s+|\n+"


def sentences(pages: DataFrame, key: str, text: str, boundary: str = BOUNDARY) -> DataFrame:
    """C-01: (key, ordinal, sentence); blank ones are not counted."""
    parts = F.filter(F.transform(F.split(text, boundary), lambda s: F.btrim(s, F.lit(" \t\r\n"))), lambda s: s != "")
    return pages.select(key, F.posexplode(parts).alias("ordinal", "sentence"))


def normative(sentences_: DataFrame, markers: list[str] = MARKERS) -> DataFrame:
    """C-02: sentences with a marker as a whole word, and the markers found; the longest wins where two start alike."""
    words = "|".join(re.escape(m).replace(r"\ ", r"\s+") for m in sorted(markers, key=len, reverse=True))
    found = F.regexp_extract_all("sentence", F.lit(rf"(?i)\b({words})\b"), F.lit(1))
    return sentences_.withColumn("markers", F.array_distinct(F.transform(found, lambda m: F.lower(F.regexp_replace(m, r"\s+", " "))))).where("size(markers) > 0")


def sentence_states(normative_: DataFrame, key: str, captured: DataFrame, exclusions: DataFrame, nodes: DataFrame | None = None, reasons: list[str] = REASONS) -> DataFrame:
    """C-03: captured (a node carries the sentence: captured has columns sentence and, if it is to be named, node), excluded (an
    exclusion for (key, ordinal) that C-04 passes), else unaccounted; with the node, or the reason and who signed it when.

    A sentence is carried by a text that is equal but for white space. duplicate-of resolves among the ids of nodes; without nodes it resolves to nothing.
    """
    named = F.min("node") if "node" in captured.columns else F.lit(None).cast("string")
    held = captured.groupBy(squeezed(F.col("sentence")).alias("__norm")).agg(named.alias("node")).withColumn("__captured", F.lit(True))
    if nodes is None:
        nodes = normative_.sparkSession.createDataFrame([], "id string")
    when = F.col("signed_at").cast("string") if "signed_at" in exclusions.columns else F.lit(None).cast("string")
    one = F.min(F.struct("reason", "signed_by", when.alias("signed_at")))
    out = judged(exclusions, nodes, reasons).where("size(messages) = 0").groupBy(key, "ordinal").agg(one.alias("__out"))
    joined = normative_.withColumn("__norm", squeezed(F.col("sentence"))).join(held, "__norm", "left").join(out, [key, "ordinal"], "left")
    joined = joined.withColumn("state", F.when(F.col("__captured"), "captured").when(F.col("__out").isNotNull(), "excluded").otherwise("unaccounted"))
    told = lambda c: F.when(F.col("state") == "excluded", F.col(f"__out.{c}"))
    return joined.withColumns({"reason": told("reason"), "signed_by": told("signed_by"), "signed_at": told("signed_at")}).drop("__norm", "__captured", "__out")


def judged(exclusions: DataFrame, nodes: DataFrame, reasons: list[str] = REASONS) -> DataFrame:
    """exclusions with messages: what is wrong with each. A reason is one of the list as it stands, or duplicate-of:<id>; ids may hold colons."""
    of = F.when(F.col("reason").rlike(f"^{DUPLICATE}(:|$)"), F.substr("reason", F.lit(len(DUPLICATE) + 2)))
    e = exclusions.withColumn("of", of).join(nodes.select(F.col("id").alias("of"), F.lit(True).alias("known")).distinct(), "of", "left")
    listed = F.when(F.col("of").isNotNull(), F.lit(DUPLICATE)).otherwise(F.col("reason")).isin(*reasons)
    told = F.array_compact(F.array(
        F.when(F.col("reason").isNull() | ~listed, F.lit("unknown reason")),
        F.when(F.col("of").isNotNull() & F.col("known").isNull(), F.lit("duplicate of nothing")),
        F.when(F.trim(F.coalesce("signed_by", F.lit(""))) == "", F.lit("not signed off")),
    ))
    return e.withColumn("messages", told).drop("of", "known")


def check_exclusions(exclusions: DataFrame, nodes: DataFrame, key: str, reasons: list[str] = REASONS) -> DataFrame:
    """C-04: exclusions with an unknown reason, a duplicate of nothing, or nobody's signature."""
    return judged(exclusions, nodes, reasons).select(key, "ordinal", F.explode("messages").alias("message"))


def coverage_numbers(states: DataFrame, key: str) -> DataFrame:
    """C-05: counts and percentages for each key, and for all under a null key; percentages are null without normative sentences."""
    n = lambda s: F.count_if(F.col("state") == s).alias(s)
    out = states.rollup(key).agg(F.count("*").alias("normative"), n("captured"), n("excluded"), n("unaccounted"))
    whole = F.nullif(F.col("normative"), F.lit(0))
    return out.withColumns({"captured_pct": 100.0 * F.col("captured") / whole, "accounted_pct": 100.0 * (F.col("captured") + F.col("excluded")) / whole})


def table_hash(t: DataFrame, columns: list[str]) -> str:
    """A SHA-256 that stands for the rows of a table in any order: that of the sums of the eight parts of each row's SHA-256.

    Sums are added up where the rows are, so tables of any size end in one row. Repeated rows count.
    """
    row = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.sha2(F.col(c).cast("string"), 256), F.lit("")) for c in columns]), 256)
    parts = [F.sum(F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("decimal(20,0)")).cast("string").alias(f"s{i}") for i in range(8)]
    sums = t.select(row.alias("h")).agg(F.count("*").cast("string").alias("n"), *parts)
    return sums.select(F.sha2(F.concat_ws("|", "n", *[F.coalesce(f"s{i}", F.lit("0")) for i in range(8)]), 256)).first()[0]


def coverage_report(states: DataFrame, key: str, sources: dict[str, tuple[str, str]], version: str, publication: str, generated_at: str) -> DataFrame:
    """C-06: totals (level total, a null key), pages and sentences as rows that name the publication, both inputs by path and hash
    ({input: (path, hash)}), the definition of normative by version, and when the report was made.

    Sentence rows have location, ordinal, text, markers, state and node, or reason and signature; numbers are null there.
    """
    numbers = coverage_numbers(states, key).withColumn("level", F.when(F.col(key).isNull(), "total").otherwise("page"))
    held = [c for c in ("node", "reason", "signed_by", "signed_at") if c in states.columns]
    location = F.concat_ws("#", F.col(key).cast("string"), F.col("ordinal").cast("string"))
    rows = states.select(F.lit("sentence").alias("level"), key, location.alias("location"), "ordinal", F.col("sentence").alias("text"), "markers", "state", *held)
    out = numbers.unionByName(rows, allowMissingColumns=True)
    inputs = {f"{k}_{what}": F.lit(v) for k, pair in sources.items() for what, v in zip(("path", "sha256"), pair, strict=True)}
    return out.withColumns({"publication": F.lit(publication), "generated_at": F.to_timestamp(F.lit(generated_at)), "definition_version": F.lit(version), **inputs})
