"""Licences named in texts, by ordered signature rules, in DataFrame functions only.

Rules are regular expressions over the lower-cased words of a text (license_rules.py). A rule is tried only where its keyword
stands as a word. What rules find are intervals of words; an interval that lies within that of a rule of the same or a better level is
suppressed: a notice hides the names in it, a name with a version that without. Base phrases are kept wherever they stand.
All work is on the arrays of one row, so that nothing is shuffled; detections of a row are put in order and swept once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.license_rules import rules as own_rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEVELS = 5
CERTAINTY = [0.5, 0.95, 0.9, 0.8, 0.4]
"""How far a detection of each level is trusted; those of a text's labels are put together as independent."""
BLOCK = 256
ADDED = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]


def lower_ascii(text: Column) -> Column:
    """text with only A-Z in lower case; null is as empty."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def spaced(text: Column) -> Column:
    """The lower-cased words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of text with one space around each; a space if there are none."""
    return F.regexp_replace(F.concat(F.lit(" "), lower_ascii(text), F.lit(" ")), GAPS, " ")


def running(items: Column, zero: Column, step: Callable[[Column, Column], Column], give: Callable[[Column, Column], Column], kind: str) -> Column:
    """give(state before the item, item) for each item of an array, with state = step(state, item).

    In blocks, so that appending copies a block and not all that came before.
    """
    empty = F.array().cast(f"array<{kind}>")

    def one(acc: Column, x: Column) -> Column:
        return F.struct(step(acc["state"], x).alias("state"), F.concat(acc["done"], F.array(give(acc["state"], x))).alias("done"))

    def block(acc: Column, b: Column) -> Column:
        inner = F.aggregate(F.slice(items, b * BLOCK + 1, BLOCK), F.struct(acc["state"].alias("state"), empty.alias("done")), one)
        return F.transform(F.array(inner), lambda i: F.struct(i["state"].alias("state"), F.concat(acc["done"], F.array(i["done"])).alias("done")))[0]

    blocks = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
    start = F.struct(zero.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("done"))
    return F.when(F.size(items) > 0, F.flatten(F.aggregate(blocks, start, block)["done"])).otherwise(empty)


def _count_spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def _places(words: Column, rule: Column) -> Column:
    """Detections of one rule: the words between and in its matches, summed up from the begin."""
    pattern = rule["pattern"]
    found = F.call_function("regexp_extract_all", words, pattern, F.lit(0))

    def located(f: Column) -> Column:
        before = F.call_function("split", words, pattern, F.lit(-1))
        pairs = F.arrays_zip(F.transform(F.slice(before, 1, F.size(f)), _count_spaces).alias("gap"), F.transform(f, _count_spaces).alias("own"))
        at = lambda state, x: state + x["gap"] + x["own"]
        give = lambda state, x: F.struct((state + x["gap"] - 1).alias("start"), (state + x["gap"] + x["own"]).alias("end"), rule["level"].alias("level"), rule["number"].alias("number"))
        return running(pairs, F.lit(0), at, give, "struct<start:int,end:int,level:int,number:int>")

    none = F.array().cast("array<struct<start:int,end:int,level:int,number:int>>")
    return F.when(F.size(found) > 0, F.transform(F.array(found), located)[0]).otherwise(none)


def _swept(found: Column) -> Column:
    """Sorted detections (least start, largest end, best level, least number first) that no earlier one of their level or a better one holds."""
    ends = F.array_repeat(F.lit(-1), LEVELS)
    reach = lambda state, x: F.transform(state, lambda e, i: F.when(i >= x["level"], F.greatest(e, x["end"])).otherwise(e))
    give = lambda state, x: F.struct(x.alias("found"), ((x["level"] == 0) | (F.get(state, x["level"]) < x["end"])).alias("kept"))
    out = running(found, ends, reach, give, "struct<found:struct<start:int,end:int,level:int,number:int>,kept:boolean>")
    return F.transform(F.filter(out, lambda x: x["kept"]), lambda x: x["found"])


def scan_licenses(docs: DataFrame, text: str = "text", carry: list[str] | None = None, rules: Iterable[tuple[int, str, str, str]] | None = None) -> DataFrame:
    """docs (or the columns in carry) with n_words, n_base, first_word, last_word, base_labels, labels, score and detections.

    rules: (level 0 to 4, label, keyword, pattern), in order; those of level 0 are the base phrases, which nothing hides. n_base counts
    their places, first_word and last_word are their least and largest start. detections holds start, end (in words), level and
    label of what is left after suppression; labels are its distinct labels, base ones included, score (0 to 1) puts the
    certainties of the best level of each label together. Null or empty texts, and tables without rows, have no words and no labels;
    texts are read whole, of any length; repeated rows are judged alike. Columns of docs named like an added one are replaced,
    others may have any name.
    """
    by: dict[str, list] = {}
    table = list(own_rules() if rules is None else rules)
    for n, (level, _, keyword, pattern) in enumerate(table):
        for k in keyword.split("|"):
            by.setdefault(k, []).append(F.struct(F.lit(level).alias("level"), F.lit(n).alias("number"), F.lit(f"(?<= )(?:{pattern})(?= )").alias("pattern")))
    groups = F.array(*[F.struct(F.lit(k).alias("keyword"), F.array(*r).alias("rules")) for k, r in by.items()])
    labels = F.array(*[F.lit(label) for _, label, _, _ in table])
    names = [c for c in (docs.columns if carry is None else carry) if c.lower() not in ADDED]
    place = {n: f"c{i}" for i, n in enumerate(docs.columns)}
    out = docs.toDF(*place.values()).select(*[place[n] for n in names], spaced(F.col(place[text])).alias("__words"))
    hit = F.array_intersect(F.split("__words", " "), F.array(*[F.lit(k) for k in by]))
    out = out.withColumn("__hit", F.coalesce(hit, F.array().cast("array<string>")))
    tried = F.array_distinct(F.flatten(F.transform(F.filter(groups, lambda g: F.array_contains("__hit", g["keyword"])), lambda g: g["rules"])))
    out = out.withColumn("__tried", F.when(F.size("__hit") > 0, tried).otherwise(F.array().cast("array<struct<level:int,number:int,pattern:string>>")))
    found = F.flatten(F.transform("__tried", lambda r: _places(F.col("__words"), r)))
    order = F.transform(found, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), x["level"].alias("level"), x["number"].alias("number")))
    ordered = F.transform(F.sort_array(order), lambda x: F.struct(x["start"].alias("start"), (-x["back"]).alias("end"), x["level"].alias("level"), x["number"].alias("number")))
    out = out.withColumn("__found", F.when(F.size("__tried") > 0, ordered).otherwise(F.array().cast("array<struct<start:int,end:int,level:int,number:int>>")))
    out = out.withColumn("__kept", F.when(F.size("__found") > 0, _swept(F.col("__found"))).otherwise(F.col("__found")))
    base = F.filter("__found", lambda x: x["level"] == 0)
    label = lambda x: F.get(labels, x["number"])
    best = F.array_sort(F.array_distinct(F.transform("__kept", lambda x: F.struct(label(x).alias("label"), x["level"].alias("level")))))
    out = out.withColumns({"__base": base, "__best": best})
    first = F.filter("__best", lambda x, i: (i == 0) | (F.get(F.col("__best"), i - 1)["label"] != x["label"]))
    doubt = F.aggregate(first, F.lit(1.0), lambda a, x: a * (1 - F.get(F.array(*[F.lit(c) for c in CERTAINTY]), x["level"])))
    out = out.withColumns({
        "n_words": (F.greatest(_count_spaces(F.col("__words")) - 1, F.lit(0))).cast("long"),
        "n_base": F.size("__base").cast("long"),
        "first_word": F.array_min("__base")["start"].cast("long"),
        "last_word": F.array_max("__base")["start"].cast("long"),
        "base_labels": F.array_join(F.array_sort(F.array_distinct(F.transform("__base", label))), ","),
        "labels": F.array_join(F.array_distinct(F.transform("__best", lambda x: x["label"])), ","),
        "score": 1 - doubt,
        "detections": F.transform("__kept", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["level"].alias("level"), label(x).alias("label"))),
    })
    return out.select(*[place[n] for n in names], *ADDED).toDF(*names, *ADDED)
