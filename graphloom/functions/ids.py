"""Stable ids and text normalisation as Column expressions. Only Unicode normalisation leaves the JVM, and only for texts that are not ASCII."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\t\n\x0B\f\r \x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
IDENTIFIER_ORDER = ["isbn", "iris-handle", "doi", "issn", "url"]
"""Fixed values: kinds of identifier in the order in which one names a publication."""


def _unicode(form: str):
    @F.pandas_udf("string")
    def normal(s: pd.Series) -> pd.Series:
        return s.map(lambda x: x if x is None else unicodedata.normalize(form, x), na_action="ignore")

    return normal


def is_ascii(c: Column) -> Column:
    return c.rlike(r"^\p{ASCII}*$")


def nfc(c: Column) -> Column:
    return F.when(is_ascii(c), c).otherwise(_unicode("NFC")(F.when(~is_ascii(c), c)))


def nfkd(c: Column) -> Column:
    return F.when(is_ascii(c), c).otherwise(_unicode("NFKD")(F.when(~is_ascii(c), c)))


def sha256_hex(c: Column) -> Column:
    return F.sha2(c, 256)


def short_hash(c: Column) -> Column:
    """The first 12 hex digits of SHA-256."""
    return F.substring(F.sha2(c, 256), 1, 12)


def ascii_slug(c: Column) -> Column:
    """slug() for texts known to be ASCII: no Python at all."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-|-$", "")


def slug(c: Column) -> Column:
    return ascii_slug(F.regexp_replace(nfkd(c), r"[\x{0300}-\x{036F}]", ""))


def squeezed(c: Column) -> Column:
    """White space runs to one space, none at the ends; Unicode form untouched."""
    return F.regexp_replace(F.regexp_replace(c, SPACE + "+", " "), "^ | $", "")


def norm_text(c: Column) -> Column:
    return squeezed(nfc(c))


def norm(c: Column) -> Column:
    return F.lower(norm_text(c))


def kit_namespace(c: Column, authority: str = "example.org") -> Column:
    """Where ids of a kit hang: without the last slash and the folder of a file kind, and with https for one authority."""
    bare = F.regexp_replace(F.regexp_replace(c, "/$", ""), "(?i)/(bpmn|dmn|cql|fsh)$", "")
    dots = authority.replace(".", r"\.")
    return F.coalesce(F.regexp_replace(bare, rf"^http://{dots}\b", f"https://{authority}"), F.lit("urn:unknown"))


def scheme_normalised(c: Column, authority: str = "example.org") -> Column:
    return F.coalesce(c.rlike("^http://" + authority.replace(".", r"\.") + r"\b"), F.lit(False))


def path_id(*parts: Column | str) -> Column:
    """Parts joined by slashes: artefact, persona, data element, section and like ids."""
    return F.concat_ws("/", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def artifact_id(ns: Column, file: Column) -> Column:
    return path_id(ns, "artifact", file)


def element_id(ns: Column, file: Column, element: Column) -> Column:
    return F.concat(artifact_id(ns, file), F.lit("#"), element)


def citation_id(ns: Column, text: Column) -> Column:
    return path_id(ns, "citation", short_hash(text))


def num(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(squeezed(c), SPACE + "+", "-"), "[^A-Za-z0-9.-]", "")


def persona_id(ns: Column, name: Column) -> Column:
    return path_id(ns, "persona", slug(name))


def data_element_id(ns: Column, name: Column) -> Column:
    return path_id(ns, "data-element", slug(name))


# Ids of published content hang below one namespace for all kits and are made of what is printed.


def id_value(kind: Column, value: Column) -> Column:
    """An identifier's value as it stands in an id: digits of a number, host and path of an address, else a slug."""
    value = squeezed(value)
    number = F.upper(F.regexp_replace(value, "[^0-9Xx]", ""))
    place = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "(?i)^[a-z]+://", ""), "[?#].*$", ""), "/+$", "")
    return F.when(kind.isin("isbn", "issn"), number).otherwise(slug(F.when(kind == "url", F.regexp_replace(place, r"(?i)^www\.", "")).otherwise(value)))


def publication_id(identifiers: Column, ns: str) -> Column:
    """From array<struct<type,value>>: the first kind of IDENTIFIER_ORDER with a value; null if there is none."""
    def of(kind: str) -> Column:
        hit = F.filter(identifiers, lambda x: (x["type"] == kind) & (F.length(F.coalesce(x["value"], F.lit(""))) > 0))
        return F.when(F.size(hit) > 0, F.struct(F.lit(kind).alias("kind"), F.get(hit, 0)["value"].alias("value")))

    first = F.coalesce(*[of(k) for k in IDENTIFIER_ORDER])
    return F.when(first.isNotNull(), path_id(ns, "publication", F.concat(first["kind"], F.lit("-"), id_value(first["kind"], first["value"]))))


def section_id(publication: Column, number: Column) -> Column:
    return path_id(publication, "section", num(number))


def publication_element_id(publication: Column, label: Column, *parts: Column) -> Column:
    """By printed label; a row or footnote within it by place."""
    return path_id(publication, "element", slug(label), *[slug(p) for p in parts])


def recommendation_id(publication: Column, number: Column, statement: Column, normalise=norm) -> Column:
    """By number, or by the hash of the statement where the number is null or empty."""
    by_text = F.concat(F.lit("h-"), short_hash(normalise(statement)))
    return path_id(publication, "recommendation", F.when(F.length(F.coalesce(number, F.lit(""))) > 0, num(number)).otherwise(by_text))


def sub_recommendation_id(recommendation: Column, letter: Column) -> Column:
    return path_id(recommendation, num(letter))


def remark_id(recommendation: Column, ordinal: Column) -> Column:
    return path_id(recommendation, "remark", ordinal.cast("string"))


def key_question_id(publication: Column, number: Column) -> Column:
    return path_id(publication, "key-question", num(number))


def outcome_id(publication: Column, name: Column) -> Column:
    return path_id(publication, "outcome", slug(name))


def evidence_id(publication: Column, key_question: Column, outcome: Column) -> Column:
    return path_id(publication, "evidence", num(key_question), slug(outcome))


def indicator_id(publication: Column, number: Column) -> Column:
    return path_id(publication, "indicator", num(number))


def health_intervention_id(ns: Column | str, system: Column, code: Column) -> Column:
    """By the code of a catalogue."""
    return path_id(ns, "health-intervention", F.concat(slug(system), F.lit("-"), num(code)))


def reference_entry_id(artifact: Column, number: Column) -> Column:
    """A row of an artefact's own list of references."""
    return path_id(artifact, "reference", num(number))


def content_text(*fields: Column, normalise=norm_text) -> Column:
    """Fields that are not null, normalised, one a line; null if all are null."""
    present = F.array_compact(F.array(*[normalise(f) for f in fields]))
    return F.when(F.size(present) > 0, F.array_join(present, "\n"))


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def decode_entities(c: Column) -> Column:
    """The five XML entities; & last, so that nothing is decoded twice."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def decode_fragment(c: Column) -> Column:
    """Percent-decoding that leaves + alone."""
    return F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def attribute(tag: Column, name: str) -> Column:
    """The first name="..." of a tag, decoded; null if it has none."""
    value = F.regexp_extract(tag, rf'\b{name}="([^"]*)"', 1)
    return F.when(tag.rlike(rf'\b{name}="'), decode_entities(value))


def inner(block: Column, tag: str) -> Column:
    """Trimmed text of the first element of that name in block; null if there is none."""
    pattern = rf"(?s)<(?:\w+:)?{tag}\b[^>]*>(.*?)</(?:\w+:)?{tag}>"
    return F.when(block.rlike(pattern), decode_entities(F.trim(F.regexp_extract(block, pattern, 1))))


def cut_label(c: Column, most: int = 80) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 3), F.lit("..."))).otherwise(c)


def citation_number(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"\((\d+)\)\s*$", 1), F.lit(""))


def is_placeholder(c: Column) -> Column:
    return c.rlike(r"^\[.*\]$")


def strip_path(c: Column) -> Column:
    return F.regexp_replace(c, "^[^#]*/", "")


def cypher_escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))


def turtle_escape(c: Column) -> Column:
    escaped = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.replace(F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def rank(derivation: Column) -> Column:
    """derived 0, inferred 1, decided 2; null for anything else."""
    return F.when(derivation == "derived", 0).when(derivation == "inferred", 1).when(derivation == "decided", 2)


def mint_ids(table: DataFrame, kind: str, natural_key: list[str], minted: Column) -> tuple[DataFrame, DataFrame]:
    """(table with id, findings): ids that two natural keys share, and rows without a usable identifier."""
    out = table.withColumn("id", minted)
    key = F.to_json(F.struct(*natural_key))
    clash = out.where("id IS NOT NULL").groupBy("id").agg(F.count_distinct(key).alias("n")).where("n > 1")
    bad = clash.select(F.lit(f"{kind}-collision").alias("rule_id"), F.col("id").alias("subject"), F.concat(F.col("n").cast("string"), F.lit(" keys mint this id")).alias("message"))
    none = out.where("id IS NULL").select(F.lit(f"{kind}-no-identifier").alias("rule_id"), key.alias("subject"), F.lit("no usable identifier").alias("message"))
    return out, bad.unionByName(none)
