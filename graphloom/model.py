"""The model that graphs are held against: classes, predicates, licensed edges, value sets, imports."""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators.frontier import closure, kept, written

SCHEMAS = {
    "classes": "layer string, id string, kind string, elaborates string, iri_pattern string, min_derivation string",
    "class_properties": "class string, property string",
    "content_fields": "class string, position int, property string",
    "predicates": "layer string, predicate string, open_qualifier boolean",
    "licensed": "layer string, predicate string, source string, target string, qualifier string, min_derivation string",
    "codes": "value_set string, code string",
    "bindings": "class string, property string, value_set string, severity string",
    "imports": "layer string, imported string, schema_version string, namespace string",
    "kinds": "layer string, kind string, description string",
    "value_sets": "layer string, value_set string",
}
MOST_IMPORTS = 10_000
STATUSES = ["unresolved", "resolved", "ambiguous"]
"""Fixed values: what a join can be, where no value set says so."""


@dataclass
class Seen:
    """What each layer sees of the model, as tables that are worked out once (`kept`; small, so Spark broadcasts them by their size)."""

    layers: DataFrame  # layer, schema_version, identifier_codes, status_codes
    classes: DataFrame  # layer, type, iri_pattern, min_derivation, allowed, fields, bindings
    licences: DataFrame  # layer, predicate, source_type, target_type, qualifiers, least, open
    between: DataFrame  # layer, source_type, target_type, allowed


@dataclass
class Model:
    """Tables of SCHEMAS. Those without a column layer (or with a null in it) hold for every layer.

    Of several licences of one triple the first that asks for a derivation stands: a layer's own come first, then by position.
    """

    classes: DataFrame
    class_properties: DataFrame
    content_fields: DataFrame
    predicates: DataFrame
    licensed: DataFrame
    codes: DataFrame
    bindings: DataFrame
    imports: DataFrame
    kinds: DataFrame
    value_sets: DataFrame  # one row a declaration; a set that only codes name is in every layer's scope
    layered: bool = False  # M-01, M-02 and M-04 ask for the layer and its imports; else for any layer
    kept: dict = field(default_factory=dict, repr=False)

    def scope(self) -> DataFrame:
        """(layer, in_scope): each layer with itself and all that it imports.

        Layers and imports are a row for each layer file and what it names. Up to MOST_IMPORTS of them are followed here, more by a Spark loop.
        """
        if self.kept.get("imports") is self.imports:
            return self.kept["scope"]
        layers = self.imports.select("layer")
        for t in (self.classes, self.predicates, self.licensed, self.value_sets):
            layers = layers.union(t.select("layer"))
        layers = layers.where("layer IS NOT NULL").distinct()
        links = self.imports.where("imported IS NOT NULL").select(F.col("layer").alias("source"), F.col("imported").alias("target"))
        few, names = ([tuple(r) for r in t.limit(MOST_IMPORTS + 1).collect()] for t in (links, layers))
        if max(len(few), len(names)) > MOST_IMPORTS:
            own = layers.select("layer", F.col("layer").alias("in_scope"))
            out = written(own.union(closure(links)).distinct())
        else:
            pairs = {(n, n) for (n,) in names} | set(few)
            while more := {(a, d) for a, b in pairs for c, d in few if b == c} - pairs:
                pairs |= more
            out = rows_of(self.imports.sparkSession, sorted(pairs), "layer string, in_scope string")
        self.kept.update(imports=self.imports, scope=out)
        return out

    def in_scope(self, table: DataFrame) -> DataFrame:
        """Rows of a model table once for each layer that sees them; layer is that layer."""
        t = table if "layer" in table.columns else table.withColumn("layer", F.lit(None).cast("string"))
        own = self.scope().join(t.withColumnRenamed("layer", "in_scope"), "in_scope").drop("in_scope")
        everyone = self.scope().select("layer", F.lit(0).alias("__k")).distinct()
        return own.unionByName(t.where("layer IS NULL").drop("layer").withColumn("__k", F.lit(0)).join(everyone, "__k").drop("__k"))

    def seen(self) -> Seen:
        """What each layer sees: its own classes, licences and value sets and those of its imports."""
        listed = lambda t, *by: t.groupBy("layer", *by)
        codes = listed(self.in_scope(self.codes), "value_set").agg(F.collect_set("code").alias("codes"))
        of = lambda name, column: codes.where(F.col("value_set") == name).select("layer", F.col("codes").alias(column))
        versions = listed(self.imports).agg(F.max("schema_version").alias("schema_version"))
        layers = self.scope().select("layer").distinct().join(versions, "layer", "left").join(of("identifier-type", "identifier_codes"), "layer", "left").join(of("resolution-status", "status_codes"), "layer", "left")
        layers = layers.withColumn("status_codes", F.coalesce("status_codes", F.array(*[F.lit(s) for s in STATUSES])))
        given = lambda c: F.col(c) if c in self.classes.columns else F.lit(None).cast("string").alias(c)
        classes = self.in_scope(self.classes.select("layer", F.col("id").alias("class"), given("iri_pattern"), given("min_derivation"))).dropDuplicates(["layer", "class"])
        allowed = listed(self.in_scope(self.class_properties), "class").agg(F.collect_set("property").alias("allowed"))
        fields = listed(self.in_scope(self.content_fields), "class").agg(F.transform(F.array_sort(F.collect_set(F.struct("position", "property"))), lambda x: x["property"]).alias("fields"))
        bound = self.in_scope(self.bindings).join(codes, ["layer", "value_set"], "left")
        bindings = listed(bound, "class").agg(F.collect_set(F.struct("property", "value_set", "severity", F.coalesce("codes", F.array().cast("array<string>")).alias("codes"))).alias("bindings"))
        for t in (allowed, fields, bindings):
            classes = classes.join(t, ["layer", "class"], "left")
        declared = self.licensed if "position" in self.licensed.columns else self.licensed.withColumn("position", F.lit(0))
        rows = self.in_scope(declared.withColumn("home", F.col("layer"))).withColumnsRenamed({"source": "source_type", "target": "target_type"})
        turn = F.struct((F.coalesce("home", F.lit("")) != F.col("layer")).alias("borrowed"), "home", "position", "min_derivation")
        open_ = listed(self.in_scope(self.predicates), "predicate").agg(F.max("open_qualifier").alias("open"))
        licences = listed(rows, "predicate", "source_type", "target_type").agg(F.collect_set("qualifier").alias("qualifiers"), F.min_by("min_derivation", F.when(F.col("min_derivation").isNotNull(), turn)).alias("least")).join(open_, ["layer", "predicate"], "left")
        named = F.when(F.col("qualifier").isNull(), F.col("predicate")).otherwise(F.concat("predicate", F.lit(" («"), "qualifier", F.lit("»)")))
        between = listed(rows, "source_type", "target_type").agg(F.array_join(F.array_sort(F.collect_set(named)), ", ").alias("permitted"))
        return Seen(*[kept(t) for t in (layers, classes.withColumnRenamed("class", "type"), licences, between)])


def make_model(spark: SparkSession, layered: bool = False, **rows: list[tuple]) -> Model:
    """A model from rows in the order of SCHEMAS; tables that are not given are empty. Licences keep the order that they are given in."""
    given = {name: (rows.get(name, []), schema) for name, schema in SCHEMAS.items()}
    given["licensed"] = ([(*r, i) for i, r in enumerate(rows.get("licensed", []))], SCHEMAS["licensed"] + ", position int")
    return Model(layered=layered, **{name: rows_of(spark, r, schema) for name, (r, schema) in given.items()})


def rows_of(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of some rows that is part of the plan: Spark knows its size."""
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"string": pa.string(), "boolean": pa.bool_(), "int": pa.int32()}
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return spark.createDataFrame(pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]))


def read_model(spark: SparkSession, path: str) -> Model:
    """From authored layer files (JSON, one layer a file).

    Layer names have no case. A binding is the name of a value set, then an error, or {set, severity}. Value sets are a
    list of {id, codes: [{code}]}, or {name: [code]}; kinds are {name: description}, or else those that classes name.
    """
    one_class = "struct<id:string,kind:string,elaborates:string,iriPattern:string,minDerivation:string,properties:array<string>,contentFields:array<string>,valueSets:map<string,string>>"
    edge = "struct<predicate:string,source:string,target:string,qualifier:string,minDerivation:string>"
    schema = f"layer string, schemaVersion string, namespace string, imports array<string>, classes array<{one_class}>, predicates array<struct<predicate:string,openQualifier:boolean>>, edges array<{edge}>, valueSets string, kinds map<string,string>"
    raw = spark.read.schema(schema).json(path, multiLine=True).withColumn("layer", F.lower("layer"))
    c = raw.select("layer", F.explode("classes").alias("c"))
    each = F.when(F.col("valueSets").startswith("["), F.from_json("valueSets", "array<struct<id:string,codes:array<string>>>"))
    named = F.transform(F.map_entries(F.when(F.col("valueSets").startswith("{"), F.from_json("valueSets", "map<string,array<string>>"))), lambda e: F.struct(e["key"].alias("id"), e["value"].alias("codes")))
    sets = raw.select("layer", F.explode(F.coalesce(each, named)).alias("v")).select("layer", F.col("v.id").alias("value_set"), "v.codes")
    code = F.when(F.col("code").startswith("{"), F.get_json_object("code", "$.code")).otherwise(F.col("code"))
    bare = ~F.col("b").startswith("{")
    return Model(
        layered=True,
        classes=c.select("layer", "c.id", "c.kind", "c.elaborates", F.col("c.iriPattern").alias("iri_pattern"), F.col("c.minDerivation").alias("min_derivation")),
        class_properties=c.select("layer", F.col("c.id").alias("class"), F.explode("c.properties").alias("property")),
        content_fields=c.select("layer", F.col("c.id").alias("class"), F.posexplode("c.contentFields").alias("position", "property")),
        predicates=raw.select("layer", F.explode("predicates").alias("p")).select("layer", "p.predicate", F.coalesce("p.openQualifier", F.lit(False)).alias("open_qualifier")),
        licensed=raw.select("layer", F.posexplode("edges").alias("position", "e")).select("layer", "e.predicate", "e.source", "e.target", "e.qualifier", F.col("e.minDerivation").alias("min_derivation"), "position"),
        codes=sets.select("layer", "value_set", F.explode("codes").alias("code")).select("layer", "value_set", code.alias("code")),
        bindings=c.select("layer", F.col("c.id").alias("class"), F.explode("c.valueSets").alias("property", "b")).select("layer", "class", "property", F.when(bare, F.col("b")).otherwise(F.get_json_object("b", "$.set")).alias("value_set"), F.coalesce(F.when(~bare, F.get_json_object("b", "$.severity")), F.lit("error")).alias("severity")),
        imports=raw.select("layer", F.explode_outer("imports").alias("imported"), F.col("schemaVersion").alias("schema_version"), "namespace").withColumn("imported", F.lower("imported")),
        kinds=raw.select("layer", F.explode("kinds").alias("kind", "description")).unionByName(raw.where("kinds IS NULL").select("layer", F.explode("classes").alias("c")).select("layer", "c.kind", F.lit(None).cast("string").alias("description")).distinct()),
        value_sets=sets.select("layer", "value_set"),
    )


def read_cypher_model(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(classes, licensed) from exported MERGE statements, one a line: classes with layer, id, kind and elaborates."""
    lines = spark.read.text(path).withColumn("layer", F.regexp_extract(F.input_file_name(), r"([^/]+)\.cypher$", 1))
    take = lambda name: F.replace(F.nullif(F.regexp_extract("value", rf"\b{name}:'((?:[^'\\]|\\.)*)'", 1), F.lit("")), F.lit("\\'"), F.lit("'"))
    classes = lines.where(F.col("value").rlike(r"^MERGE \(:\w+:\w+ \{id:")).select(take("layer").alias("layer"), take("id").alias("id"), take("kind").alias("kind"))
    ends = r"^MATCH \(s:\w+ \{id:'([^']*)'\}\), \(t:\w+ \{id:'([^']*)'\}\)"
    edges = lines.where(F.col("value").rlike(ends)).select("layer", take("predicate").alias("predicate"), F.regexp_extract("value", ends, 1).alias("source"), F.regexp_extract("value", ends, 2).alias("target"), take("qualifier").alias("qualifier"))
    general = edges.where("predicate IS NULL OR predicate = 'elaborates'").select("layer", F.col("source").alias("id"), F.col("target").alias("elaborates")).distinct()
    return classes.join(general, ["layer", "id"], "left"), edges.where("predicate <> 'elaborates'")


# Table integrity. Each gives (rule_id, subject, message) and runs on tables of any size.


def fk_violations(child: DataFrame, parent: DataFrame, keys: dict[str, str], rule: str, message: str) -> DataFrame:
    """Rows of child whose key (child column: parent column) is in no row of parent; null keys refer to nothing."""
    ends = parent.select(*[F.col(p).alias(f"__{c}") for c, p in keys.items()]).distinct()
    given = child.where(" AND ".join(f"`{c}` IS NOT NULL" for c in keys)).select(*keys).distinct()
    lost = given.join(ends, [F.col(c) == F.col(f"__{c}") for c in keys], "left_anti")
    return lost.select(F.lit(rule).alias("rule_id"), F.concat_ws("|", *[F.col(c).cast("string") for c in keys]).alias("subject"), F.lit(message).alias("message"))


def duplicate_keys(table: DataFrame, keys: list[str], rule: str) -> DataFrame:
    twice = table.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return twice.select(F.lit(rule).alias("rule_id"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("subject"), F.concat(F.lit("declared "), F.col("n").cast("string"), F.lit(" times")).alias("message"))


def out_of_scope(child: DataFrame, parent: DataFrame, key: str, parent_key: str, scope: DataFrame, rule: str, message: str) -> DataFrame:
    """fk_violations of one key within layers: rows of child (with layer) whose key stands in parent, but in no layer that theirs is or imports."""
    ends = parent.select("layer", F.col(parent_key).alias(key)).distinct()
    seen = scope.join(ends.withColumnRenamed("layer", "in_scope"), "in_scope").select("layer", key).distinct()
    lost = child.select("layer", key).distinct().join(seen, ["layer", key], "left_anti").join(ends.select(key).distinct(), key, "left_semi")
    told = F.concat(F.lit(f"{message} in "), F.col("layer"), F.lit(" and its imports"))
    return lost.where("layer IS NOT NULL").select(F.lit(rule).alias("rule_id"), F.col(key).alias("subject"), told.alias("message"))


def value_set_findings(m: Model, scope: DataFrame) -> DataFrame:
    """M-03: value sets that are declared twice in scope, have no codes, or repeat a code."""
    own = ["layer", "value_set"] if "layer" in m.codes.columns else ["value_set"]
    count = m.value_sets.groupBy("layer", "value_set").agg(F.count("*").alias("n"))
    visible = scope.join(count.withColumnRenamed("layer", "in_scope"), "in_scope").groupBy("layer", "value_set").agg(F.sum("n").alias("n")).where("n > 1")
    twice = visible.join(count.select("layer", "value_set"), ["layer", "value_set"], "left_semi")
    empty = m.value_sets.distinct().join(m.codes.where("code IS NOT NULL").select(*own).distinct(), own, "left_anti")
    told = lambda t, text: t.select(F.lit("M-03").alias("rule_id"), F.concat_ws("|", "layer", "value_set").alias("subject"), F.lit(text).alias("message"))
    return duplicate_keys(m.codes, [*own, "code"], "M-03").unionByName(told(twice, "declared twice in scope")).unionByName(told(empty, "declares no codes"))


def check_model(m: Model) -> DataFrame:
    """M-01 to M-07; what a layer names must be in its scope if the model is layered, as those that read_model reads are."""
    every = m.scope()
    ends = m.licensed.select("layer", F.explode(F.array("source", "target")).alias("class"))
    loose = m.codes.select("value_set").distinct().join(m.value_sets.select("value_set"), "value_set", "left_anti")
    sets = m.value_sets.select("value_set").union(loose).distinct()
    bound = m.bindings if "layer" in m.bindings.columns else m.bindings.join(m.classes.select(F.col("id").alias("class"), "layer").distinct(), "class")
    bound = bound.select("layer", "value_set")
    links = m.imports.where("imported IS NOT NULL")
    loops = closure(links.select(F.col("layer").alias("source"), F.col("imported").alias("target"))).where("source = target")
    other = links.alias("a").join(m.imports.select("layer", "schema_version", "namespace").distinct().alias("b"), F.col("a.imported") == F.col("b.layer"))
    differs = other.where("a.schema_version <> b.schema_version OR a.namespace <> b.namespace")
    scope = every.where("layer <> in_scope")
    again = m.classes.select("layer", "id").join(scope, "layer").join(m.classes.select(F.col("layer").alias("in_scope"), "id"), ["in_scope", "id"])
    parts = [
        fk_violations(ends, m.classes, {"class": "id"}, "M-01", "edge names an undeclared class"),
        fk_violations(m.licensed, m.predicates, {"predicate": "predicate"}, "M-02", "edge uses an undeclared predicate"),
        value_set_findings(m, every),
        fk_violations(m.bindings, m.class_properties, {"class": "class", "property": "property"}, "M-04", "binding names an undeclared property"),
        fk_violations(m.bindings, sets, {"value_set": "value_set"}, "M-04", "binding names an undeclared value set"),
        again.select(F.lit("M-05").alias("rule_id"), F.concat_ws("|", "layer", "id").alias("subject"), F.lit("declared locally and imported").alias("message")).distinct(),
        loops.select(F.lit("M-06").alias("rule_id"), F.col("source").alias("subject"), F.lit("circular import").alias("message")),
        differs.select(F.lit("M-06").alias("rule_id"), F.concat_ws("|", "a.layer", "a.imported").alias("subject"), F.lit("version or namespace differs across an import").alias("message")),
        fk_violations(m.classes, m.kinds, {"kind": "kind"}, "M-07", "kind without a description"),
    ]
    if m.layered:
        parts += [
            out_of_scope(ends, m.classes, "class", "id", every, "M-01", "edge names a class that is not declared"),
            out_of_scope(m.licensed, m.predicates, "predicate", "predicate", every, "M-02", "edge uses a predicate that is not declared"),
            out_of_scope(bound, m.value_sets, "value_set", "value_set", every, "M-04", "binding names a value set that is not declared"),
        ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing_borrowed(referenced: DataFrame, loaded: DataFrame) -> DataFrame:
    """Classes that are referred to but not loaded: (id)."""
    return referenced.select("id").distinct().join(loaded.select("id"), "id", "left_anti")
