"""Instances, requirements, personas and an index of artefacts out of shorthand (FSH) and other kit files, one Spark job over all files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions import ids
from graphloom.operators.graph import first_per_key, match_by_name

CLASSES = {
    "PlanDefinition": "plan-definition", "ActivityDefinition": "activity-definition", "Library": "library", "Measure": "measure", "Questionnaire": "questionnaire",
    "StructureMap": "structure-map", "ValueSet": "value-set", "CodeSystem": "code-system", "ConceptMap": "concept-map", "ActorDefinition": "actor-definition", "Requirements": "requirements",
}
PROFILE_KINDS = [
    ("recommendationdefinition|strategydefinition|plandefinition", "PlanDefinition"), ("measure", "Measure"), ("questionnaireresponse", None), ("questionnaire|extr-smap", "Questionnaire"),
    ("immunizationactivity|communicationactivity|activitydefinition", "ActivityDefinition"), ("structuremap", "StructureMap"), ("actordefinition", "ActorDefinition"), ("requirements", "Requirements"),
    ("conceptmap", "ConceptMap"), (r"\blibrary\b", "Library"),
]
COMPONENTS = {
    "Measure": "program-indicator", "Questionnaire": "data-element", "StructureMap": "data-element", "ValueSet": "data-element", "CodeSystem": "data-element", "ConceptMap": "data-element",
    "Profile": "data-element", "Logical": "data-element", "ActorDefinition": "persona", "Requirements": "functional-requirement", "ActivityDefinition": "decision-support-logic",
}
PLAN_COMPONENTS = [("recommendationdefinition|strategydefinition", "decision-support-logic"), ("workflow|shareableplandefinition", "business-process")]
LIBRARY_COMPONENTS = [("IndicatorLogic$", "program-indicator"), ("Elements$", "data-element"), ("Logic$", "decision-support-logic")]
REQUIREMENT = "^SGRequirements?$|Requirement$"
"""Fixed values: classes of resource kinds, words in profiles that tell the kind, and the component that each kind implements (by profile or name where the kind leaves it open)."""


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def quoted(block: Column, field: str) -> Column:
    """Value of `* field = "..."` or `Field: "..."`, with \\" undone; null if it is not there."""
    raw = F.regexp_extract(block, rf'(?m)^\s*(?:\* )?{field}\s*[=:]\s*"((?:[^"\\]|\\.)*)"', 1)
    return _some(F.replace(raw, F.lit('\\"'), F.lit('"')))


def multiline(block: Column, field: str) -> Column:
    return _some(F.trim(F.regexp_extract(block, rf'(?s)(?:\* )?{field}\s*[=:]\s*"""(.*?)"""', 1)))


def code(block: Column, field: str) -> Column:
    return _some(F.regexp_extract(block, rf"(?m)^\s*\* {field}\s*=\s*#([\w-]+)", 1))


def header(block: Column, field: str) -> Column:
    return _some(F.regexp_extract(block, rf"(?m)^{field}:\s*(\S+)", 1))


def flag(block: Column, field: str) -> Column:
    return F.regexp_extract(block, rf"(?m)^\s*\* {field}\s*=\s*(true|false)", 1) == "true"


def instances(files: DataFrame) -> DataFrame:
    """EXT-12: (path, pos, id, instance_of, block) of each `Instance:` of a file."""
    head = r"^Instance:\s*(\S+)[ \t]*\r?\n\s*InstanceOf:\s*(\S+)"
    b = files.select("path", F.posexplode(F.split("text", r"(?m)^(?=Instance:\s*\S)")).alias("pos", "block")).where(F.col("block").rlike(head))
    return b.select("path", "pos", F.regexp_extract("block", head, 1).alias("id"), F.regexp_extract("block", head, 2).alias("instance_of"), "block")


def actors(inst: DataFrame, keep: list[str] = []) -> DataFrame:
    """Actors, with a title or without; isco: four-digit codes on the line of the description that begins with the classification's name."""
    b = F.col("block")
    about = F.coalesce(multiline(b, "description"), quoted(b, "description"))
    line = F.regexp_extract(F.coalesce(about, F.lit("")), r"\*\*ISCO(?:-08)?\*\*:([^\n]*)", 1)
    kind = _some(F.regexp_extract(b, r"(?m)^\*\s+type\s*=\s*#(\S+)", 1))
    return inst.where("instance_of = 'ActorDefinition'").select(*keep, "path", "id", quoted(b, "title").alias("title"), quoted(b, "name").alias("name"), kind.alias("persona_type"), F.coalesce(about, F.lit("")).alias("description"), F.regexp_extract_all(line, F.lit(r"\b(\d{4})\b"), F.lit(1)).alias("isco"))


def personas(inst: DataFrame, keep: list[str] = []) -> DataFrame:
    """EXT-13: actors with a title; those without are left to the warnings."""
    return actors(inst, keep).where("title IS NOT NULL")


def requirements(inst: DataFrame, keep: list[str] = []) -> DataFrame:
    """EXT-14: functional if it has an actor or says what it is a capability for, else non-functional."""
    b = F.col("block")
    named = F.transform(F.regexp_extract_all(b, F.lit(r"actor\[[+=]\]\s*=\s*Canonical\(([^)]+)\)"), F.lit(1)), lambda a: F.trim(a))
    value = lambda name: _some(F.regexp_extract(b, rf'extension\[{name}\]\.valueString\s*=\s*"([^"]*)"', 1))
    out = inst.where(F.col("instance_of").rlike(REQUIREMENT)).select(*keep, "path", "id", F.col("instance_of").alias("profile"), quoted(b, "title").alias("title"), F.coalesce(multiline(b, "description"), quoted(b, "description")).alias("description"), named.alias("actors"), value("capability").alias("capability"), value("benefit").alias("benefit"), "block")
    functional = (F.size("actors") > 0) | F.col("capability").isNotNull()
    return out.withColumns({"type": F.when(functional, "functional-requirement").otherwise("non-functional-requirement"), "benefit": F.when(functional, F.col("benefit"))})


def requirement_statements(req: DataFrame, keep: list[str] = []) -> DataFrame:
    """EXT-15: (keep, id, ordinal, key, label, requirement, conformance): statements that have all four."""
    pieces = F.filter(F.split("block", r"statement\[\+\]\."), lambda b, i: i > 0)
    text = lambda b, name: F.regexp_extract(b, rf'(?m)^(?:\*\s+statement\[=\]\.)?{name}\s*=\s*"((?:[^"\\]|\\.)*)"', 1)
    has = lambda b, name: b.rlike(rf'(?m)^(?:\*\s+statement\[=\]\.)?{name}\s*=\s*"')
    verb = lambda b: F.regexp_extract(b, r"(?m)conformance\[\+\]\s*=\s*#(\S+)", 1)
    whole = F.filter(pieces, lambda b: (text(b, "key") != "") & has(b, "label") & has(b, "requirement") & (verb(b) != ""))
    s = req.select(*keep, "id", F.posexplode(F.transform(whole, lambda b: F.struct(text(b, "key").alias("key"), text(b, "label").alias("label"), F.replace(text(b, "requirement"), F.lit('\\"'), F.lit('"')).alias("requirement"), verb(b).alias("conformance")))).alias("ordinal", "s"))
    return s.select(*keep, "id", "ordinal", "s.key", "s.label", "s.requirement", "s.conformance")


def conformance_tally(statements: DataFrame) -> DataFrame:
    """EXT-15: statements of each conformance verb."""
    return statements.groupBy("conformance").agg(F.count("*").alias("n"))


def match_actors(req: DataFrame, people: DataFrame) -> DataFrame:
    """JON-05: each actor of a requirement against the instances that are personas."""
    asked = req.select("id", F.explode("actors").alias("actor"))
    return match_by_name(asked, people.select(F.col("id").alias("actor"), F.col("id").alias("persona")), "actor", "persona")


def kit_membership(kits: DataFrame, components: DataFrame) -> DataFrame:
    """EXT-16: (kit, predicate, target, qualifier, derivation): what lies in a kit's folder belongs to it, as far as one can infer.

    kits: folder, id. components: path, id, qualifier. A component goes to the kit with the longest folder that holds it.
    """
    folders = components.select("path", "id", "qualifier", F.explode(F.transform(F.sequence(F.lit(0), F.size(F.split("path", "/")) - 1), lambda i: F.when(i == 0, F.lit("")).otherwise(F.array_join(F.slice(F.split("path", "/"), 1, i), "/")))).alias("folder"))
    held = folders.join(kits.select("folder", F.col("id").alias("kit")), "folder").groupBy("id", "qualifier").agg(F.max_by("kit", F.length("folder")).alias("kit"))
    return held.select("kit", F.lit("hasComponent").alias("predicate"), F.col("id").alias("target"), "qualifier", F.lit("inferred").alias("derivation"))


def aliases(files: DataFrame) -> DataFrame:
    """(alias, url) of all files; the last in path order stands."""
    found = lambda i: F.regexp_extract_all("text", F.lit(r"(?m)^Alias:\s*(\$\S+)\s*=\s*(\S+)"), F.lit(i))
    a = files.select("path", F.posexplode(F.arrays_zip(found(1).alias("alias"), found(2).alias("url"))).alias("pos", "a"))
    return a.groupBy("a.alias").agg(F.max_by("a.url", F.struct("path", "pos")).alias("url"))


def resource_type(instance_of: Column, profile: Column) -> Column:
    """EXT-18: the kind of resource that a profile (an alias put in) names, or the instance itself; null if none."""
    word, out = F.lower(profile), None
    for pattern, kind in PROFILE_KINDS:
        hit, value = word.rlike(pattern), F.lit(kind).cast("string")
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.when(instance_of.isin(*CLASSES), instance_of)


def class_of(kind: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for k, v in CLASSES.items() for x in (k, v)]), kind)


NAME = r"[A-Za-z0-9_.-]+"


def rulesets(files: DataFrame) -> DataFrame:
    """(name, parameters, body) of each `RuleSet:`; the last in path order stands. A body ends at the next rule set, instance or profile."""
    b = files.select("path", F.posexplode(F.split("text", r"(?m)^(?=RuleSet:\s*\S)")).alias("pos", "b"))
    head = rf"^RuleSet:\s*({NAME})\s*(?:\(([^)]*)\))?"
    parameters = F.filter(F.transform(F.split(F.regexp_extract("b", head, 2), ","), lambda p: F.trim(p)), lambda p: p != "")
    body = F.get(F.split(F.regexp_replace("b", r"^[^\n]*\n", ""), r"(?m)^(?=RuleSet:|Instance:|Profile:)"), 0)
    one = b.where(F.col("b").rlike(head)).select(F.regexp_extract("b", head, 1).alias("name"), F.struct(parameters.alias("parameters"), body.alias("body")).alias("v"), F.struct("path", "pos").alias("at"))
    return one.groupBy("name").agg(F.max_by("v", "at").alias("v")).select("name", "v.parameters", "v.body")


def expand_rulesets(blocks: DataFrame, sets: DataFrame, keys: list[str], levels: int = 4) -> DataFrame:
    """EXT-19: `* insert Name(a, b)` replaced by the body with {parameter} filled in, nested to some levels.

    Each level cuts blocks where a call begins, joins the calls and puts the pieces together again. A call may run over
    lines. Arguments are cut at commas outside brackets; [[ ]] around one is dropped. What names no rule set stays. Blocks
    without a call stay where they are.
    """
    calls = r"(?m)^\*\s+insert\s"
    bare = blocks.where(~F.coalesce(F.col("block").rlike(calls), F.lit(False))).select(*keys, "block")
    out = blocks.where(F.col("block").rlike(calls)).select(*keys, "block")
    call = rf"(?m)\A\*\s+insert\s+({NAME})\s*(?:\(([\s\S]*?)\))?\s*$"
    for _ in range(levels):
        pieces = out.select(*keys, F.posexplode(F.split("block", r"(?m)^(?=\*\s+insert\s)")).alias("n", "piece"))
        pieces = pieces.withColumns({"name": F.regexp_extract("piece", call, 1), "raw": F.regexp_extract("piece", call, 2), "rest": F.regexp_replace("piece", call, "")})
        args = F.transform(F.split("raw", r",(?![^\[]*\])"), lambda a: F.regexp_replace(F.trim(F.regexp_replace(a, r"^\s+|\s+$", "")), r"^\[\[|\]\]$", ""))
        joined = pieces.withColumn("args", args).join(sets, "name", "left")
        pairs = F.arrays_zip(F.col("parameters").alias("parameters"), F.col("args").alias("args"))
        filled = F.aggregate(pairs, F.col("body"), lambda acc, p: F.when(p["parameters"].isNull(), acc).otherwise(F.replace(acc, F.concat(F.lit("{"), p["parameters"], F.lit("}")), F.coalesce(p["args"], F.lit("")))))
        piece = F.when(F.col("body").isNotNull(), F.concat(F.regexp_replace(filled, r"\n$", ""), "rest")).otherwise(F.col("piece"))
        out = joined.select(*keys, "n", piece.alias("piece")).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("n", "piece"))).alias("l")).select(*keys, F.array_join(F.transform("l", lambda x: x["piece"]), "").alias("block"))
    return bare.unionByName(out)


def canonical_refs(blocks: DataFrame, keys: list[str], ns: str) -> DataFrame:
    """EXT-20: (keys, predicate, target, target_path, derivation) for libraries and activities that a block refers to."""
    found = lambda pattern, kind, path: blocks.select(*keys, F.explode(F.regexp_extract_all("block", F.lit(pattern), F.lit(1))).alias("name")).select(*keys, F.lit("uses").alias("predicate"), F.concat(F.lit(f"{ns}/{kind}/"), F.trim("name")).alias("target"), F.lit(path).cast("string").alias("target_path"), F.lit("derived").alias("derivation"))
    return found(r"(?m)^\*\s+library\s*=\s*Canonical\(([^)]+)\)", "Library", None).unionByName(found(r"definitionCanonical\s*=\s*Canonical\(([^)]+)\)", "ActivityDefinition", "PlanDefinition.action.definitionCanonical"))


def artifact_citations(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """EXT-21: citations of related artefacts, one row each."""
    found = F.regexp_extract_all("block", F.lit(r'citation\s*=\s*"((?:[^"\\]|\\.)*)"'), F.lit(1))
    cited = blocks.select(*keys, F.explode(found).alias("citation")).withColumn("citation", F.replace("citation", F.lit('\\"'), F.lit('"')))
    return cited.withColumns({"kind": F.when(ids.is_placeholder(F.col("citation")), "placeholder").otherwise("reference"), "numbering": ids.citation_number(F.col("citation")), "label": ids.cut_label(F.col("citation"))})


ABOUT = "struct<status:string,version:string,name:string,publisher:string,experimental:boolean,kind:string,base:string>"


def _about(**fields: Column) -> Column:
    """What an artefact says of itself, in the fields of ABOUT."""
    names = [f.split(":")[0] for f in ABOUT[7:-1].split(",")]
    return F.struct(*[fields.get(n, F.lit(None)).alias(n) for n in names]).cast(ABOUT)


def artifact_index(files: DataFrame, canonical: str, version: str | None = None) -> DataFrame:
    """EXT-17: a row for each canonical of shorthand instances and definitions, maps, logic and JSON resources; the first in path order wins.

    (path, pos, origin, resource_type, type, id, title, profile, canonical, about). Logic has no resource kind; its canonical is by slug.
    version: that of the guide, where an artefact has none.
    """
    fsh, none, guide = files.where(F.col("path").endswith(".fsh")), F.lit(None).cast("string"), F.lit(version).cast("string")
    title = _some(F.trim(F.regexp_extract("block", r'(?m)^Title:\s*"?([^"\n]*)"?', 1)))
    b = F.col("block")
    told = F.regexp_extract(b, r"(?m)^\s*\* experimental\s*=\s*(true|false)", 1)
    of_instance = _about(status=F.coalesce(quoted(b, "status"), code(b, "status")), version=F.coalesce(quoted(b, "version"), guide), name=F.coalesce(quoted(b, "name"), "id"), publisher=quoted(b, "publisher"), experimental=F.when(told != "", told == "true"))
    i = instances(fsh).join(aliases(fsh).withColumnRenamed("alias", "instance_of"), "instance_of", "left").withColumn("profile", F.coalesce("url", "instance_of"))
    i = i.select("path", "pos", F.lit("instance").alias("origin"), resource_type(F.col("instance_of"), F.col("profile")).alias("resource_type"), "id", title.alias("title"), "profile", of_instance.alias("about")).withColumn("type", class_of(F.col("resource_type")))
    keyword = r"^(ValueSet|CodeSystem|Logical|Profile):\s*(\S+)"
    d = fsh.select("path", F.posexplode(F.split("text", r"(?m)^(?=(?:ValueSet|CodeSystem|Logical|Profile):\s*\S)")).alias("pos", "block")).where(F.col("block").rlike(keyword)).withColumn("word", F.regexp_extract("block", keyword, 1))
    kind = F.when(F.col("word").isin("Logical", "Profile"), "StructureDefinition").otherwise(F.col("word"))
    own = F.regexp_extract("block", keyword, 2)
    of_definition = _about(status=_some(F.regexp_extract(b, r"\^status\s*=\s*#(\S+)", 1)), version=guide, name=own, kind=F.when(F.col("word") == "Logical", "logical"), base=F.when(F.col("word") == "Profile", _some(F.regexp_extract(b, r"(?m)^Parent:\s*(\S+)", 1))))
    d = d.select("path", (F.col("pos") + 100000).alias("pos"), F.lit("definition").alias("origin"), kind.alias("resource_type"), own.alias("id"), title.alias("title"), none.alias("profile"), F.when(F.col("word") == "Logical", "structure-definition").when(F.col("word") == "Profile", "profile").otherwise(class_of(F.col("word"))).alias("type"), of_definition.alias("about"))
    stem = F.regexp_extract("path", r"([^/]+)\.\w+$", 1)
    row = lambda t, origin, kind, id_, title_, profile, type_, about: t.select("path", F.lit(0).alias("pos"), F.lit(origin).alias("origin"), kind.alias("resource_type"), id_.alias("id"), title_.alias("title"), profile.alias("profile"), type_.alias("type"), about.alias("about"))
    maps = row(files.where(F.col("path").endswith(".fml")), "map", F.lit("StructureMap"), stem, stem, none, F.lit("structure-map"), _about(version=guide))
    logic = row(files.where(F.col("path").endswith(".cql")), "logic", F.lit("cql"), ids.slug(stem), stem, none, F.lit("cql-library"), _about(name=stem))
    j, got = files.where(F.col("path").endswith(".json")), lambda p: F.get_json_object("text", f"$.{p}")
    of_json = _about(status=got("status"), version=F.coalesce(got("version"), guide), name=got("name"), publisher=got("publisher"), experimental=got("experimental") == "true")
    j = row(j.where(got("resourceType").isin(*CLASSES)), "json", got("resourceType"), F.coalesce(got("id"), stem), F.coalesce(got("title"), got("name")), got("meta.profile[0]"), class_of(got("resourceType")), of_json)
    every = reduce(DataFrame.unionByName, [i, d, maps, logic, j]).where("type IS NOT NULL AND id IS NOT NULL")
    every = every.withColumn("canonical", F.concat_ws("/", F.lit(canonical), "resource_type", "id"))
    every = every.repartition(4 * files.sparkSession.sparkContext.defaultParallelism, "canonical")  # rows of words that repeat are few MB as files and many as rows: Spark would join them to a few tasks
    return first_per_key(every, ["canonical"], ["path", "pos"])


def component_type(index: DataFrame) -> DataFrame:
    """Instances of an index with component_type: what their kind implements; by profile for plans, by name for libraries, null if nothing decides."""
    by = lambda c, rules_: F.coalesce(*[F.when(c.rlike("(?i)" + pattern), F.lit(kind)) for pattern, kind in rules_])
    of = F.element_at(F.create_map(*[F.lit(x) for k, v in COMPONENTS.items() for x in (k, v)]), F.col("resource_type"))
    kind = F.when(F.col("resource_type") == "PlanDefinition", by(F.coalesce("profile", F.lit("")), PLAN_COMPONENTS)).when(F.col("resource_type") == "Library", by(F.col("id"), LIBRARY_COMPONENTS)).otherwise(of)
    return index.where("origin = 'instance'").withColumn("component_type", kind)


def match_components(index: DataFrame, ns: str) -> DataFrame:
    """JON-06: (canonical, resource_type, component_type, component_id, component, rule, derivation, status): the component that an instance implements by convention.

    A title that begins with capitals and a dot is the component's id; a measure titled (or, without a title, named) LETTERS + IND +
    number is LETTERS.IND.number. All else gives no row. Always inferred and unresolved.
    """
    measure = r"^([A-Z]+)IND(\d+)$"
    name = F.coalesce("title", "id")
    dotted = F.coalesce(F.col("title").rlike(r"^[A-Z]{2,}\."), F.lit(False))
    of_measure = F.when((F.col("resource_type") == "Measure") & name.rlike(measure), F.regexp_replace(name, measure, "$1.IND.$2"))
    out = component_type(index).where("component_type IS NOT NULL").withColumns({"component_id": F.when(dotted, F.col("title")).otherwise(of_measure), "rule": F.when(dotted, "title is the id").otherwise("id put together from a measure's title")})
    out = out.where("component_id IS NOT NULL").withColumn("component", F.concat_ws("/", F.lit(ns), "component_type", ids.slug(F.col("component_id"))))
    return out.select("canonical", "path", "pos", "id", "title", "resource_type", "component_type", "component_id", "component", "rule", F.lit("inferred").alias("derivation"), F.lit("unresolved").alias("status"))


def undecided_types(index: DataFrame) -> DataFrame:
    """AGG-09: kinds of instances for which no component could be decided."""
    return component_type(index).where("component_type IS NULL").select(F.col("resource_type").alias("type")).distinct()


def extraction_warnings(namespaces: DataFrame, tasks: DataFrame, people: DataFrame, actors: DataFrame, joins: DataFrame, coverage: DataFrame, authority: str, least_cited: float = 0.5) -> DataFrame:
    """EXT-22: (warning, subject). namespaces: raw. tasks: path, name. people: id, title (null too). actors: id, actor, status. joins: name, status.
    coverage: table, rules, cited."""
    row = lambda t, name, subject: t.select(F.lit(name).alias("warning"), subject.cast("string").alias("subject"))
    twice = lambda t, c: t.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n")).where("n > 1")
    return reduce(DataFrame.unionByName, [
        row(namespaces.where(ids.scheme_normalised(F.col("raw"), authority)), "scheme rewritten", F.col("raw")),
        row(twice(tasks, "name"), "task name is not unique", F.col("name")),
        row(twice(people, "title"), "persona title is not unique", F.col("title")),
        row(people.where("title IS NULL"), "actor without a title", F.col("id")),
        row(actors.where("status = 'unresolved'"), "unknown actor", F.concat_ws("|", "id", "actor")),
        row(joins.where("status <> 'resolved'"), "join is not resolved", F.col("name")),
        row(coverage.where(F.col("cited") < least_cited * F.col("rules")), "few rules are cited", F.col("table")),
    ])
