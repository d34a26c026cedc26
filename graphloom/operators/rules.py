"""Conformance rules: findings (doc_id, rule_id, severity, subject, message) of graph documents against the model of their layer.

Rules about one node are one pass over the nodes, rules about one edge one pass over the edges: each row gets an array of
what is wrong with it. An edge's ends are looked up in its own document first, then in all others. What a layer sees of
the model and where ids are defined (`Index`) are slim written tables; nodes and edges themselves are never copied.
Nulls in properties count as absent, but for a contentHash or review status that is there and null.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions import ids
from graphloom.model import Model, Seen
from graphloom.operators.frontier import MOST_LOCAL, WRITTEN, at_hand, kept, let_go, written

ERROR, WARNING = "error", "warning"
TOLD = "array<struct<rule_id:string,severity:string,message:string>>"
EVIDENCE = "struct<location:string,quote:string,artifact:string,by:string,at:string>"
MOST_LAYERS = 8
"""Layers for each of which a row of one of many documents is looked at, before its findings meet its document."""


def finding(df: DataFrame, rule: str, severity: str | Column, subject: Column | str, message: str | Column) -> DataFrame:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return df.select("doc_id", F.lit(rule).alias("rule_id"), lit(severity).alias("severity"), (F.col(subject) if isinstance(subject, str) else subject).alias("subject"), lit(message).alias("message"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _edge() -> Column:
    return F.concat_ws("|", "predicate", "source", "target")


def _prop(name: str) -> Column:
    return F.get_json_object("properties", f"$.{name}")


def _p(name: str) -> Column:
    return F.col("__p")[name]


def _bare(c: Column | str) -> Column:
    """Null or empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) == ""


def _with_properties(t: DataFrame) -> DataFrame:
    """t with __p: its properties, parsed once."""
    return t.withColumn("__p", F.when(F.col("properties") != "{}", F.from_json("properties", "map<string,string>")))


def _with_columns(t: DataFrame, **kinds: str) -> DataFrame:
    """t with nulls for columns that it lacks."""
    return t.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in t.columns})


def _struct(rule: str, severity: str | Column, message: str | Column) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(F.lit(rule).alias("rule_id"), lit(severity).alias("severity"), lit(message).alias("message"))


def _if(rule: str, condition: Column, message: str | Column, severity: str = ERROR) -> tuple[str, Column]:
    return rule, F.when(condition, F.array(_struct(rule, severity, message)))


def _each(rule: str, items: Column, message, severity=ERROR) -> tuple[str, Column]:
    """A finding for each item of an array; severity and message may be functions of the item."""
    told = F.transform(items, lambda x: _struct(rule, severity(x) if callable(severity) else severity, message(x)))
    return rule, told


def _long(t: DataFrame) -> DataFrame:
    """A table with a row a node or an edge, as the right side of a join: dealt and sorted, never sent to every task.

    Spark judges a table by its files, and files of repeated words are a hundredth of the rows that a broadcast would hold on the driver.
    """
    return t.hint("merge")


def _found(t: DataFrame, rules: list[tuple[str, Column]], only: set[str] | None, subject: Column, docs: DataFrame | None = None) -> DataFrame:
    """t's findings: the arrays of all rules (or some) put together and exploded. With docs t is `_of_layers`, and what was found for the layer of a document stands."""
    parts = [F.coalesce(c.cast(TOLD), F.array().cast(TOLD)) for rule, c in rules if only is None or rule in only]
    each = t.select("doc_id", *([] if docs is None else ["layer"]), subject.alias("subject"), F.explode(F.flatten(F.array(*parts))).alias("f"))
    each = each if docs is None else each.join(_long(docs), ["doc_id", "layer"])
    return each.select("doc_id", "f.rule_id", "f.severity", "subject", "f.message")


# Where ids are defined


@dataclass
class Index:
    """Where each id is defined. All tables hold ids and types only, and are worked out once."""

    best: DataFrame  # id, type, node_doc, status, many: the elaborating type's, then the first document's; many: the id is in own
    own: DataFrame  # doc_id, id, type, status: for ids that several documents define
    twice: DataFrame  # doc_id, id, last, copies: ids that one document defines more than once
    clashes: DataFrame  # id, types, doc_id: V-35
    long: bool = False  # own is too long to go to every task


def indexed(nodes: DataFrame, m: Model | None = None) -> Index:
    """The index of a set of documents: one shuffle of ids and types, whatever the nodes hold. Ids that are defined once, mostly nearly all, need no more."""
    t = _with_columns(nodes, ord="int").select("doc_id", "id", "type", "ord", _prop("resolutionStatus").alias("status"))
    each = t.groupBy("id").agg(F.min(F.struct("type", F.col("doc_id").alias("node_doc"), "status")).alias("f"), F.count("*").alias("n"))
    each = written(each.select("id", "f.type", "f.node_doc", "f.status", "n"))
    let_go(nodes.sparkSession)
    once, again = each.where("n = 1").drop("n").withColumn("many", F.lit(False)), kept(each.where("n > 1").select("id"))
    if again.isEmpty():
        none = t.limit(0)
        return Index(once, none.select("doc_id", "id", "type", "status"), none.select("doc_id", "id", F.col("ord").alias("last"), F.lit(0).cast("long").alias("copies")), none.select("id", F.array("type").alias("types"), "doc_id"))
    again = _long(again) if again.count() > MOST_LOCAL else again
    best, own, twice, bad = _defined_again(t.join(again, t["id"].eqNullSafe(again["id"]), "left_semi"), m)
    here = len(WRITTEN)
    own = kept(own)
    long = len(WRITTEN) > here
    let_go(nodes.sparkSession)
    return Index(once.unionByName(best.withColumn("many", F.lit(True))), own, kept(twice), bad, long)


def _defined_again(t: DataFrame, m: Model | None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What `Index` holds of ids that are defined twice or more."""
    each = written(t.groupBy("doc_id", "id", "type").agg(F.max(F.struct("ord", "status")).alias("last"), F.count("*").alias("copies")))
    let_go(t.sparkSession)
    above = None if m is None else m.classes.where("elaborates IS NOT NULL").select(F.col("id").alias("type"), F.col("elaborates").alias("general")).distinct()
    kinds = each.groupBy("id", "type").agg(F.min(F.struct("doc_id", "last")).alias("f"))
    kinds = kinds.withColumn("general", F.lit(None).cast("string")) if above is None else kinds.join(above, "type", "left")
    listed = kinds.groupBy("id").agg(F.collect_list(F.struct(F.col("f.doc_id").alias("d"), F.col("f.last.ord").alias("o"), "type", F.col("f.last.status").alias("status"), "general")).alias("l"))
    special = F.filter("l", lambda x: ~F.coalesce(F.exists("l", lambda y: y["general"] == x["type"]), F.lit(False)))
    listed = written(listed.withColumn("s", special).withColumn("b", F.array_min(F.when(F.size("s") > 0, F.col("s")).otherwise(F.col("l")))).select("id", "b.type", F.col("b.d").alias("node_doc"), "b.status", F.when(F.size("s") > 1, F.transform("s", lambda x: x["type"])).alias("types")))
    own = each.groupBy("doc_id", "id").agg(F.max_by(F.struct("type", F.col("last.status").alias("status")), "last.ord").alias("v")).select("doc_id", "id", "v.type", "v.status")
    twice = each.groupBy("doc_id", "id").agg(F.max("last.ord").alias("last"), F.sum("copies").alias("copies")).where("copies > 1")
    bad = listed.where("types IS NOT NULL").select("id", F.array_sort("types").alias("types")).join(each.groupBy("id").agg(F.min("doc_id").alias("doc_id")), "id")
    return listed.drop("types"), own, twice, bad


def with_endpoints(edges: DataFrame, nodes: DataFrame, m: Model | None = None, index: Index | None = None, told: bool = True) -> DataFrame:
    """JON-01: edges with type, document and status of both ends: the edge's own document first, then any other.

    Across documents the type that elaborates the other stands, then that of the first document. The index is
    joined by id; only edges at ids that several documents define are looked up by document too. Unless told, an end's
    document is not named: it is null where there is none.
    """
    index = index or indexed(nodes, m)
    out, ends = edges, ("source", "target")
    for end in ends:
        doc = F.col("node_doc") if told else F.lit("")
        best = index.best.select(F.col("id").alias(end), F.col("type").alias(f"{end}_type"), doc.alias(f"{end}_doc"), F.col("status").alias(f"{end}_status"), F.col("many").alias(f"__{end}"))
        out = out.join(_long(best), end, "left")
    many = F.greatest(*[F.coalesce(f"__{end}", F.lit(False)) for end in ends])  # not an OR, which Spark would put below a join, so that edges were dealt for each part
    met = out.where(many) if index.long else out  # else own goes to every task, and no edge is dealt for it
    for end in ends:
        own = index.own.select("doc_id", F.col("id").alias(end), F.col("type").alias("__t"), F.col("status").alias("__s"), F.lit(True).alias("__own"))
        met = met.join(own, ["doc_id", end], "left")
        pick = lambda mine, other: F.when(F.col("__own"), F.col(mine)).otherwise(F.col(other))
        met = met.withColumns({f"{end}_type": pick("__t", f"{end}_type"), f"{end}_doc": pick("doc_id", f"{end}_doc"), f"{end}_status": pick("__s", f"{end}_status")}).drop("__t", "__s", "__own")
    return (met.unionByName(out.where(~many)) if index.long else met).drop("__source", "__target")


# Documents


def v01_version(documents: DataFrame, seen: Seen, version: str | None = None) -> DataFrame:
    """V-01: documents made with another version than that of their layer (or than the one given), or of a layer that there is no model of."""
    d = documents.select("doc_id", "layer", "ontology_version").join(seen.layers.select("layer", "schema_version", F.lit(True).alias("known")), "layer", "left")
    wanted = F.col("schema_version") if version is None else F.lit(version)
    other = finding(d.where("known").where(~F.col("ontology_version").eqNullSafe(wanted)), "V-01", ERROR, "doc_id", "made with another version of the model")
    return other.unionByName(finding(d.where("known IS NULL"), "V-01", ERROR, "doc_id", F.concat(F.lit("no model of the layer "), F.coalesce("layer", F.lit("null")))))


def checked_documents(documents: DataFrame, seen: Seen, version: str | None = None) -> DataFrame:
    """(doc_id, layer) of the documents that the other rules look at."""
    d = documents.select("doc_id", "layer", "ontology_version").join(seen.layers, "layer")
    return at_hand(d.where(F.col("ontology_version") == (F.col("schema_version") if version is None else F.lit(version))).select("doc_id", "layer"))


def _of_checked(t: DataFrame, docs: DataFrame, seen: Seen) -> DataFrame:
    """Rows of checked documents with their layer and the codes that it sees."""
    return t.join(docs, "doc_id").join(seen.layers.select("layer", "identifier_codes", "status_codes"), "layer")


def _of_layers(t: DataFrame, seen: Seen) -> DataFrame:
    """A row for each layer that its document may be of: where documents are as many as files, rows are not dealt by them, only what is found."""
    return t.crossJoin(F.broadcast(seen.layers.select("layer", "identifier_codes", "status_codes")))


# Nodes


def _unexplained() -> Column:
    """Without a note or without evidence: one of the two is not enough."""
    return F.col("derivation").isin("inferred", "decided") & (_bare("note") | F.col("evidence").isNull())


def _lacks() -> Column:
    return F.concat("derivation", F.lit(" without "), F.when(_bare("note"), "note").otherwise("evidence"))


def _unsigned() -> Column:
    return (F.col("derivation") == "decided") & (_bare("evidence.by") | _bare("evidence.at"))


def node_rules() -> list[tuple[str, Column]]:
    """V-02 to V-04, V-12 to V-16 and V-19 to V-22, V-31 as arrays of findings on a row of `prepared_nodes`."""
    known, last = F.col("known"), F.col("__last")
    kind, is_rec = _p("kind"), F.col("type") == "recommendation"
    criteria = F.when(_p("successCriteria").startswith("["), F.size(F.from_json(_p("successCriteria"), "array<string>")))
    types = F.when(_p("identifiers").startswith("["), F.transform(F.from_json(_p("identifiers"), "array<struct<type:string>>"), lambda i: i["type"]))
    odd_types = F.filter(types, lambda t: t.isNull() | ~F.array_contains("identifier_codes", F.coalesce(t, F.lit(""))))
    coded = lambda b: F.array_contains("__texts", b["property"]) & F.array_contains(b["codes"], F.coalesce(F.element_at("__p", b["property"]), F.lit("")))
    odd_codes = F.filter("bindings", lambda b: F.element_at("__p", b["property"]).isNotNull() & ~coded(b))  # a number is no code, even one that reads alike
    graded = F.array_compact(F.array(*[F.when(_p(k).isNotNull(), F.lit(k)) for k in ("strength", "overallCertainty")], F.when((kind == "no-recommendation") & _p("direction").isNotNull(), F.lit("direction"))))
    least = F.concat(F.lit("must be at least "), F.col("min_derivation"))
    rules = [
        _each("V-12", F.when(F.size("allowed") > 0, F.array_except(F.map_keys("__p"), "allowed")), lambda k: F.concat(F.lit("undeclared property: "), k)),
        _if("V-02", F.col("__copies") > 1, F.concat(F.lit("defined "), F.col("__copies").cast("string"), F.lit(" times"))),
        _if("V-13", (F.col("type") == "requirement-statement") & (F.coalesce(criteria, F.lit(0)) <= 0), "no success criteria", WARNING),
        _each("V-14", odd_codes, lambda b: F.concat(b["property"], F.lit(" is not in "), b["value_set"], F.lit(": "), F.element_at("__p", b["property"])), lambda b: b["severity"]),
        _each("V-15", F.when(F.col("identifier_codes").isNotNull(), odd_types), lambda t: F.concat(F.lit("identifier type: "), F.coalesce(t, F.lit("none")))),
        _if("V-16", ~F.expr("id rlike iri_pattern"), "id has another shape than its class asks for"),
        _if("V-19", ids.rank(F.col("derivation")) < ids.rank(F.col("min_derivation")), least),
        _if("V-20", _unsigned(), "decided by nobody or never"),
        _if("V-21", is_rec & _p("strength").isNotNull() & _p("direction").isNull(), "strength without direction"),
        _if("V-22", is_rec & kind.isin("good-practice-statement", "no-recommendation") & (F.size(graded) > 0), F.concat(kind, F.lit(" carries no grade, but: "), F.array_join(graded, ", "))),
        _if("V-31", F.col("type").isin("citation", "reference-entry") & _bare(_p("text")), "no verbatim text"),
    ]
    rules = [(r, F.when(last, c)) for r, c in rules]
    return [
        _if("V-03", ~known, F.concat(F.lit("type not in scope: "), F.coalesce("type", F.lit("none")))),
        _if("V-04", _unexplained(), _lacks()), *rules,
    ]


def prepared_nodes(nodes: DataFrame, docs: DataFrame | None, seen: Seen, twice: DataFrame | None = None) -> DataFrame:
    """nodes of checked documents (without docs: of all, for each layer) with what their layer's model says of their type. __last: not defined again further down."""
    n = _with_columns(nodes, ord="int", note="string", evidence=EVIDENCE, derivation="string", properties="string")
    n = (_of_layers(_with_properties(n), seen) if docs is None else _of_checked(n, docs, seen)).join(seen.classes.withColumn("known", F.lit(True)), ["layer", "type"], "left").withColumn("known", F.coalesce("known", F.lit(False)))
    if twice is None:
        n = n.withColumns({"__last": F.lit(True), "__copies": F.lit(1)})
    else:
        n = n.join(twice.select("doc_id", "id", F.col("last").alias("__at"), F.col("copies").alias("__copies")), ["doc_id", "id"], "left").withColumn("__last", F.col("__at").isNull() | (F.col("ord") == F.col("__at")))
    n = n if docs is None else _with_properties(n)
    typed = F.from_json("properties", "map<string,variant>")
    texts = F.map_keys(F.map_filter(typed, lambda k, v: F.schema_of_variant(v) == "STRING"))
    return n.withColumn("__texts", F.when(F.col("bindings").isNotNull() & F.col("__p").isNotNull(), texts))


def node_findings(nodes: DataFrame, documents: DataFrame, m: Model, only: set[str] | None = None, version: str | None = None, twice: DataFrame | None = None, seen: Seen | None = None) -> DataFrame:
    """Findings of the rules that look at one node (or of some of them)."""
    seen = seen or m.seen()
    return _found(prepared_nodes(nodes, checked_documents(documents, seen, version), seen, twice), node_rules(), only, F.col("id"))


def unknown_types(nodes: DataFrame, docs: DataFrame, seen: Seen) -> DataFrame:
    """V-03 where documents are many: a document meets its types, each once, and only those that some layer does not see."""
    layers = seen.layers.select("layer").distinct()
    everywhere = seen.classes.select("layer", "type").distinct().groupBy("type").agg(F.count("*").alias("n")).join(layers.agg(F.count("*").alias("n")), "n").select("type")
    pairs = nodes.join(F.broadcast(kept(everywhere)), "type", "left_anti").select("doc_id", "type").distinct()
    odd = pairs.join(_long(docs), "doc_id").join(seen.classes.select("layer", "type"), ["layer", "type"], "left_anti").select(F.col("doc_id").alias("__doc"), F.col("type").alias("__type"))
    odd = at_hand(odd)
    met = nodes.join(odd, (nodes["doc_id"] == odd["__doc"]) & nodes["type"].eqNullSafe(odd["__type"]))
    return finding(met, "V-03", ERROR, "id", F.concat(F.lit("type not in scope: "), F.coalesce("type", F.lit("none"))))


def undeclared_shape(nodes: DataFrame, documents: DataFrame, m: Model, seen: Seen | None = None) -> DataFrame:
    """AGG-05: for each document, nodes with properties whose class declares none; unknown types are V-03's."""
    seen = seen or m.seen()
    n = prepared_nodes(nodes, checked_documents(documents, seen), seen)
    return n.where("known AND allowed IS NULL AND properties IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n_nodes"))


# Edges: each rule looks at edges that the ones before let through


def slim_edges(edges: DataFrame) -> DataFrame:
    """edges with what `edge_rules` look at: of a note and of evidence whether they say anything, of properties the status. Texts are not dealt by the ends."""
    if "__status" in edges.columns:
        return edges
    e = _with_columns(edges, qualifier="string", note="string", evidence=EVIDENCE, derivation="string", properties="string")
    marks = F.concat(*[F.when(_bare(f"evidence.{c}"), F.lit("")).otherwise(F.lit(c[0])) for c in ("location", "by", "at")])
    return e.select("doc_id", "predicate", "source", "target", "qualifier", "derivation", F.when(~_bare("note"), F.lit(".")).alias("note"), F.when(F.col("evidence").isNotNull(), marks).alias("__marks"), _prop("resolutionStatus").alias("__status"))


def _as_edges(slim: DataFrame) -> DataFrame:
    """`slim_edges` with columns as edges have them, a dot for each text."""
    mark = lambda c: F.when(F.col("__marks").contains(c[0]), F.lit(".")).alias(c)
    none = F.lit(None).cast("string")
    ground = F.when(F.col("__marks").isNotNull(), F.struct(mark("location"), none.alias("quote"), none.alias("artifact"), mark("by"), mark("at")))
    return slim.withColumns({"evidence": ground, "properties": none})


def prepared_edges(ends: DataFrame, docs: DataFrame | None, seen: Seen) -> DataFrame:
    """JON-02: edges of checked documents (without docs: of all, for each layer), with whether the layer knows the types at both ends and licenses the triple."""
    status = F.col("__status") if "__status" in ends.columns else _prop("resolutionStatus")
    e = _as_edges(ends) if "__status" in ends.columns else _with_columns(ends, qualifier="string", note="string", evidence=EVIDENCE, derivation="string", properties="string")
    e = _of_layers(e, seen) if docs is None else _of_checked(e, docs, seen)
    for end in ("source", "target"):
        e = e.join(seen.classes.select("layer", F.col("type").alias(f"{end}_type"), F.lit(True).alias(f"__{end}")), ["layer", f"{end}_type"], "left")
    e = e.join(seen.licences.withColumn("licensed", F.lit(True)), ["layer", "predicate", "source_type", "target_type"], "left").join(seen.between, ["layer", "source_type", "target_type"], "left")
    return e.withColumns({"known": F.coalesce(F.col("__source") & F.col("__target"), F.lit(False)), "status": status})


def edge_rules() -> list[tuple[str, Column]]:
    """V-05 to V-11 and V-32 to V-34 as arrays of findings on a row of `prepared_edges`."""
    source, target = F.col("source_doc").isNotNull(), F.col("target_doc").isNotNull()
    licensed, status = F.col("licensed"), F.col("status")
    resolved = (status == "resolved") & F.array_contains("status_codes", "resolved")
    return [
        _if("V-05", ~source, "source is defined nowhere"),
        _if("V-06", source & ~target, "target is defined nowhere"),
        _if("V-07", F.col("known") & licensed.isNull(), F.concat(F.lit("not licensed; licensed here: "), F.coalesce("permitted", F.lit("nothing")))),
        _if("V-08", licensed & F.col("qualifier").isNotNull() & ~F.coalesce("open", F.lit(False)) & ~F.expr("array_contains(qualifiers, qualifier)"), F.concat(F.lit("unknown qualifier: "), F.col("qualifier")), WARNING),
        _if("V-09", licensed & (ids.rank(F.col("derivation")) < ids.rank(F.col("least"))), F.concat(F.lit("must be at least "), F.col("least"))),
        _if("V-10", licensed & _unsigned(), "decided by nobody or never"),
        _if("V-11", licensed & _unexplained(), _lacks()),
        _if("V-32", status.isNotNull() & ~F.array_contains("status_codes", status), F.concat(F.lit("unknown status: "), status)),
        _if("V-33", resolved & ~F.coalesce("target_status", F.lit("")).isin("", "resolved"), "resolved onto a node that is not"),
        _if("V-34", resolved & F.col("derivation").isin("inferred", "decided") & _bare("evidence.location"), "resolved without saying where"),
    ]


def edge_findings(edges: DataFrame, nodes: DataFrame, documents: DataFrame, m: Model, only: set[str] | None = None, version: str | None = None, index: Index | None = None, seen: Seen | None = None) -> DataFrame:
    """Findings of the rules that look at one edge and its ends (or of some of them)."""
    seen = seen or m.seen()
    ends = with_endpoints(slim_edges(edges), nodes, m, index, told=False)
    return _found(prepared_edges(ends, checked_documents(documents, seen, version), seen), edge_rules(), only, _edge())


# Content


def content_findings(prepared: DataFrame) -> DataFrame:
    """V-17, V-18: content without a hash, or with another one. Only texts that are not ASCII go through Python."""
    parts = F.array_compact(F.transform("fields", lambda f: F.element_at("__p", f)))
    held = prepared.where("__last AND size(fields) > 0").withColumn("__parts", parts).where("size(__parts) > 0")
    held = held.select("doc_id", "id", F.array_join(F.transform("__parts", ids.squeezed), "\n").alias("text"), F.map_contains_key("__p", "contentHash").alias("has"), _p("contentHash").alias("stored"))
    ascii_ = held.where(ids.is_ascii(F.col("text"))).withColumn("actual", ids.content_hash(F.col("text")))
    other = held.where(~ids.is_ascii(F.col("text"))).withColumn("actual", ids.content_hash(ids.nfc(F.col("text"))))
    told = ascii_.unionByName(other)
    return finding(told.where("NOT has"), "V-17", WARNING, "id", "content without a hash").unionByName(finding(told.where("has AND NOT stored <=> actual"), "V-18", ERROR, "id", "hash is not that of the content"))


# Recommendations and what they rest on


SLOTS = ["intervention", "population", "setting", "provider", "timing"]
CERTAINTY = ["very-low", "low", "moderate", "high"]
LINKS = ["definedIn", "hasRemark", "presentedIn", "supportedBy", "forOutcome", "resolvesTo", "numberedAs"]


def near(edges: DataFrame, nodes: DataFrame, m: Model | None = None, index: Index | None = None) -> DataFrame:
    """The edges that rules about recommendations, rows and citations follow, with both ends' documents. Of `contains` only those into something that their document shows content in."""
    shown = edges.where("predicate = 'presentedIn'").select("doc_id", "target")
    used = edges.where(F.col("predicate").isin(LINKS))
    if not shown.isEmpty():  # else the edges of `contains`, mostly the most, need not be dealt
        used = used.unionByName(edges.where("predicate = 'contains'").join(_long(shown.distinct()), ["doc_id", "target"], "left_semi"))
    slim = _with_columns(used, ord="int").select("doc_id", "ord", "predicate", "source", "target")
    return with_endpoints(slim, nodes, m, index)


def _at(links: DataFrame, nodes: DataFrame, end: str, **columns: Column) -> DataFrame:
    """links with columns of the node at an end: that of the document which the end was found in.

    The rules below take typed nodes of the documents that are checked, and in `at` those of all documents, where edges lead.
    """
    held = nodes.select(F.col("doc_id").alias(f"{end}_doc"), F.col("id").alias(end), *[c.alias(n) for n, c in columns.items()])
    return links.join(_long(held), [f"{end}_doc", end])


def publication_findings(links: DataFrame, nodes: DataFrame, at: DataFrame | None = None) -> DataFrame:
    """V-23, V-24: recommendations of publications that were not reviewed, or whose review is not recorded."""
    recs = nodes.where("type = 'recommendation'").select("doc_id", F.col("id").alias("source"))
    own = links.where("predicate = 'definedIn'").join(_long(recs), ["doc_id", "source"], "left_semi")
    pubs = _at(own, nodes if at is None else at, "target", review=_prop("grcStatus"), recorded=F.array_contains(F.json_object_keys("properties"), "grcStatus"))
    bad = finding(pubs.where("review = 'not-reviewed'"), "V-23", ERROR, "source", "defined in a publication that was not reviewed")
    return bad.unionByName(finding(pubs.where("NOT coalesce(recorded, false)"), "V-24", WARNING, "source", "defined in a publication of unknown review"))


def slot_findings(links: DataFrame, nodes: DataFrame, at: DataFrame | None = None) -> DataFrame:
    """V-25: slots whose words stand neither in the statement, the text of its remarks, nor in the captions and headings of where it is printed and of what holds that."""
    recs = nodes.where("type = 'recommendation'")
    keys = recs.select("doc_id", F.col("id").alias("source"))
    first = lambda p: links.where(F.col("predicate") == p).join(_long(keys), ["doc_id", "source"], "left_semi")
    row = lambda t, turn, text: t.select("doc_id", F.col("source").alias("id"), F.struct(F.lit(turn).alias("turn"), F.col("ord").alias("a"), F.coalesce(F.col("up"), F.lit(-1)).cast("long").alias("b"), F.lit(text).alias("f"), F.coalesce(F.col(text), F.lit("")).alias("t")).alias("s"))
    flat = lambda t, turn, *texts: [row(t, turn, x) for x in texts]
    none = F.lit(None).cast("long").alias("up")
    own = recs.select("doc_id", F.col("id").alias("source"), F.lit(0).alias("ord"), none, _prop("statement").alias("statement"))
    remarks = _at(first("hasRemark"), nodes if at is None else at, "target", text=_prop("text")).withColumn("up", F.lit(None).cast("long"))
    shown = first("presentedIn")
    places = _at(shown, nodes if at is None else at, "target", caption=_prop("caption"), heading=_prop("heading")).withColumn("up", F.lit(None).cast("long"))
    around = links.where("predicate = 'contains'").select("doc_id", "target", F.col("ord").cast("long").alias("up"), F.col("source").alias("holder"), F.col("source_doc").alias("holder_doc"))
    holders = _at(shown.select("doc_id", "source", "ord", "target").join(_long(around), ["doc_id", "target"]), nodes if at is None else at, "holder", caption=_prop("caption"), heading=_prop("heading"))
    every = union(flat(own, 0, "statement") + flat(remarks, 1, "text") + flat(places, 2, "caption", "heading") + flat(holders, 2, "caption", "heading"))
    hay = every.groupBy("doc_id", "id").agg(F.array_sort(F.collect_list("s")).alias("l")).select("doc_id", "id", ids.norm(F.array_join(F.transform("l", lambda x: x["t"]), " \n ")).alias("hay"))
    slots = recs.select("doc_id", "id", F.explode(F.array(*[F.struct(F.lit(s).alias("slot"), _prop(s).alias("v")) for s in SLOTS])).alias("s")).select("doc_id", "id", "s.slot", "s.v").where("v IS NOT NULL")
    bad = slots.join(_long(hay), ["doc_id", "id"], "left").withColumn("needle", ids.norm(F.col("v"))).where("NOT contains(coalesce(hay, ''), needle)")
    return finding(bad, "V-25", WARNING, "id", F.concat("slot", F.lit(" is not quoted from the source")))


def certainty_findings(links: DataFrame, nodes: DataFrame, at: DataFrame | None = None) -> DataFrame:
    """V-26: overall certainty above the lowest over critical outcomes; a certainty that there is no such level of is the lowest."""
    level = lambda c: F.array_position(F.array(*[F.lit(x) for x in CERTAINTY]), c)
    recs = nodes.where("type = 'recommendation'").select("doc_id", F.col("id").alias("source"), level(_prop("overallCertainty")).alias("overall")).where("overall IS NOT NULL")
    on = links.where("predicate = 'supportedBy'").join(_long(recs), ["doc_id", "source"])
    ev = _at(on, nodes if at is None else at, "target", certainty=_prop("certainty")).where("certainty <> ''").select("doc_id", F.col("source").alias("id"), "overall", F.col("target").alias("source"), level(F.col("certainty")).alias("c"))
    of = _at(links.where("predicate = 'forOutcome'"), nodes if at is None else at, "target", importance=_prop("importance")).where("importance = 'critical'").select("doc_id", "source").distinct()
    low = ev.join(_long(of), ["doc_id", "source"]).groupBy("doc_id", "id", "overall").agg(F.min("c").alias("lowest"))
    return finding(low.where("overall > lowest"), "V-26", WARNING, "id", "more certain than its least certain critical outcome")


def copy_findings(links: DataFrame, nodes: DataFrame, at: DataFrame | None = None) -> DataFrame:
    """V-27: data rows of a table that store a cell which the table's column map fills from content shown there."""
    tables = nodes.where("type = 'publication-element'").where((_prop("elementType") == "table") & _prop("columnMap").isNotNull() & _prop("columns").startswith("["))
    tables = tables.select("doc_id", F.col("id").alias("source"), F.from_json(_prop("columns"), "array<string>").alias("columns"), F.from_json(_prop("columnMap"), "map<string,string>").alias("map"))
    named = F.transform("columns", lambda c, i: F.struct(i.alias("pos"), c.alias("column")))
    filled = F.filter(named, lambda x: F.coalesce(F.element_at("map", x["column"]), F.lit("")) != "")
    tables = tables.select("doc_id", "source", filled.alias("filled")).where("size(filled) > 0")  # a table's columns go to what it holds at once, not to its cells
    held = links.where("predicate = 'contains'").join(_long(tables), ["doc_id", "source"]).select("doc_id", "target", "target_doc", "filled")
    shown = links.where("predicate = 'presentedIn'").select("doc_id", "target").distinct()
    rows = _at(held.join(_long(shown), ["doc_id", "target"], "left_semi"), nodes if at is None else at, "target", kind=_prop("rowType"), cells=_prop("cells")).where("kind = 'data' AND startswith(cells, '[')")
    stored = F.filter("filled", lambda x: F.get(F.col("__cells"), x["pos"]).isNotNull())
    cells = rows.withColumn("__cells", F.from_json("cells", "array<string>")).select("doc_id", "target", F.explode(stored).alias("x")).select("doc_id", "target", "x.column")
    return finding(cells, "V-27", ERROR, "target", F.concat(F.lit("stores a second copy of "), F.col("column")))


# Citations


def citation_findings(links: DataFrame, nodes: DataFrame, kinds: tuple[str, ...] = ("citation", "reference-entry")) -> DataFrame:
    """V-28 to V-30. A citation is resolved by an edge of its own, or by numberedAs onto a node marked resolved (in any document) that the same document resolves."""
    cites = nodes.where(F.col("type").isin(*kinds)).select("doc_id", "id", "type", _prop("resolutionStatus").alias("status"), _prop("citationKind").alias("kind"))
    direct = links.where("predicate = 'resolvesTo'").select("doc_id", F.col("source").alias("id")).distinct()
    hops = written(links.where("predicate = 'numberedAs' AND target_status = 'resolved'").select("doc_id", F.col("source").alias("id"), F.col("target").alias("at")).distinct())
    front = reached = direct
    while not hops.isEmpty():  # back from what is resolved; each id is met once, so cycles end
        front = written(hops.join(_long(front.select("doc_id", F.col("id").alias("at"))), ["doc_id", "at"]).select("doc_id", "id").distinct().join(_long(reached), ["doc_id", "id"], "left_anti"))
        if front.isEmpty():
            break
        reached = reached.unionByName(front)
    cites = cites.join(_long(direct.withColumn("direct", F.lit(True))), ["doc_id", "id"], "left").join(_long(reached.withColumn("reached", F.lit(True))), ["doc_id", "id"], "left")
    mock = (F.col("type") == "citation") & F.coalesce(F.col("kind") == "placeholder", F.lit(False))
    resolved, has = F.coalesce(F.col("status") == "resolved", F.lit(False)), F.col("direct").isNotNull()
    told = [
        _if("V-28", mock & (has | resolved), "a placeholder cannot be resolved"), _if("V-29", ~mock & resolved & F.col("reached").isNull(), "claims to be resolved and leads nowhere"),
        _if("V-30", has & ~resolved, "leads to a source but is not marked resolved", WARNING),
    ]
    return _found(cites, told, None, F.col("id"))


def join_tally(edges: DataFrame) -> DataFrame:
    """AGG-03"""
    status = _prop("resolutionStatus")
    n = lambda s: F.count_if(status == s).alias(s)
    return edges.groupBy("doc_id", "predicate").agg(n("resolved"), n("unresolved"), n("ambiguous")).where("resolved + unresolved + ambiguous > 0")


def unify_nodes(nodes: DataFrame, m: Model) -> tuple[DataFrame, DataFrame]:
    """(id, type), and V-35: one id has one type, or two of which one elaborates the other, which then stands."""
    index = indexed(nodes, m)
    return index.best.select("id", "type").join(index.clashes.select("id"), "id", "left_anti"), clash_findings(index)


def clash_findings(index: Index) -> DataFrame:
    return finding(index.clashes, "V-35", ERROR, "id", F.concat(F.lit("types clash: "), F.array_join("types", ", ")))


#: Patterns and field sets of the schema of graph documents.
CLASS_ID, PREDICATE, SHA256 = "^[a-z0-9]+(-[a-z0-9]+)*$", "^[a-z][A-Za-z0-9]*$", "^[0-9a-f]{64}$"
PROPERTY_KEY = r"^[A-Za-z][A-Za-z0-9_]*(\[x\])?(\.[A-Za-z][A-Za-z0-9_]*(\[x\])?)*$"
DATE_TIME = r"^\d{4}-\d\d-\d\d[Tt]\d\d:\d\d:\d\d(\.\d+)?([Zz]|[+-]\d\d:\d\d)$"
FIELDS = {
    "document": (["@context", "id", "type", "ontologyVersion", "generatedAt", "nodes", "edges"], ["wasDerivedFrom", "dak"]),
    "source": (["path", "sha256"], ["repository", "commit", "note"]),
    "node": (["id", "type", "label", "derivation"], ["definedBy", "properties", "note", "evidence", "flagRef", "skill"]),
    "edge": (["type", "predicate", "source", "target", "derivation"], ["qualifier", "note", "evidence", "flagRef", "skill", "properties"]),
    "evidence": (["location"], ["quote", "artifact", "by", "at"]),
}


def _told(rules_: list[tuple[Column, str | Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(c, t if isinstance(t, Column) else F.lit(t)) for c, t in rules_]))


def _fields(keys: Column, kind: str) -> tuple[Column, Column]:
    """Fields that an object of the kind does not have."""
    extra = F.array_except(keys, F.array(*[F.lit(x) for part in FIELDS[kind] for x in part]))
    return F.size(extra) > 0, F.concat(F.lit(f"unknown field of a {kind}: "), F.array_join(F.array_sort(extra), ", "))


def _bad_key(properties: str) -> Column:
    return F.exists(F.json_object_keys(properties), lambda k: ~k.rlike(PROPERTY_KEY))


def shape_findings(nodes: DataFrame, edges: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """T1-01: form of nodes and edges, before any model; with raw (`read_raw`) that of documents too, by `document_findings`.

    A property key that begins with a capital is sound by the schema and gets a warning; keys outside its pattern are errors.
    """
    n, e = [], []
    for c in ("id", "type", "label", "derivation"):
        n.append((F.coalesce(F.col(c), F.lit("")) == "", f"{c} is missing"))
    for c in ("predicate", "source", "target", "derivation"):
        e.append((F.coalesce(F.col(c), F.lit("")) == "", f"{c} is missing"))
    n.append((~F.col("type").rlike(CLASS_ID), "type is not in kebab case"))
    e.append((~F.col("predicate").rlike(PREDICATE), "predicate is not in camel case"))
    for rules in (n, e):
        rules.append((~F.col("derivation").isin("derived", "inferred", "decided"), "unknown derivation"))
        rules.append((F.col("derivation").isin("inferred", "decided") & (F.col("note").isNull() | F.col("evidence").isNull()), "inferred or decided without note and evidence"))
        rules.append((F.col("evidence").isNotNull() & F.col("evidence.location").isNull(), "evidence without a location"))
    n.append((_bad_key("properties"), "property key has no sound form"))
    if "properties" in edges.columns:
        e.append((_bad_key("properties"), "property key has no sound form"))
    bad_n = nodes.select("doc_id", F.coalesce("id", F.lit("")).alias("subject"), F.explode(_told(n)).alias("message"))
    bad_e = edges.select("doc_id", _edge().alias("subject"), F.explode(_told(e)).alias("message"))
    odd = nodes.where(F.exists(F.json_object_keys("properties"), lambda k: k.rlike("^[A-Z]") & k.rlike(PROPERTY_KEY)))
    out = finding(bad_n.unionByName(bad_e), "T1-01", ERROR, "subject", F.col("message")).unionByName(finding(odd, "T1-01", WARNING, F.coalesce("id", F.lit("")), "property key is not in camel case"))
    return out if raw is None else out.unionByName(document_findings(raw))


def document_findings(raw: DataFrame) -> DataFrame:
    """T1-01 of documents as text (path, value): can be parsed, required fields, consts, closed field sets of every object, hashes of sources. doc_id is the path where a document has no id."""
    anything = "map<string,string>"
    d = raw.select("path", F.try_parse_json("value").isNotNull().alias("parsed"), F.from_json("value", anything).alias("d"), F.json_object_keys("value").alias("keys"))
    d = d.withColumns({"doc_id": F.coalesce(F.col("d")["id"], "path"), **{k: F.from_json(F.col("d")[k], f"array<{anything}>") for k in ("nodes", "edges", "wasDerivedFrom")}})
    sound = F.col("parsed") & F.col("keys").isNotNull()
    field = lambda k: F.col("d")[k]
    lost = lambda m, kind: [(m[k].isNull(), f"{kind}: {k} is missing") for k in FIELDS[kind][0]]
    lists = [(field(k).isNotNull() & (F.col(k).isNull() | ~F.ltrim(field(k)).startswith("[") | F.exists(k, lambda x: x.isNull())), f"{k} is no list of objects") for k in ("nodes", "edges", "wasDerivedFrom")]
    whole = [
        *[(sound & c, t) for c, t in lost(F.col("d"), "document")], (sound & _fields(F.col("keys"), "document")[0], _fields(F.col("keys"), "document")[1]),
        (~F.col("parsed"), "document cannot be parsed"), (F.col("parsed") & F.col("keys").isNull(), "document is no object"), (field("type") != "Entity", "document is not of type Entity"),
        (~field("generatedAt").rlike(DATE_TIME), "generatedAt is no date and time"), (F.exists(F.json_object_keys(field("dak")), lambda k: ~k.rlike(PROPERTY_KEY)), "property key has no sound form"), *lists,
    ]
    parts = [finding(d.select("doc_id", F.explode(_told(whole)).alias("message")), "T1-01", ERROR, "doc_id", F.col("message"))]
    m = F.col("x")
    for column, kind in (("nodes", "node"), ("edges", "edge"), ("wasDerivedFrom", "source")):
        rows = d.select("doc_id", F.explode(column).alias("x")).where("x IS NOT NULL")
        told = [_fields(F.map_keys(m), kind)]
        subject = m["id"] if kind == "node" else m["path"] if kind == "source" else F.concat_ws("|", m["predicate"], m["source"], m["target"])
        if kind == "source":
            told += [*lost(m, kind), (~m["sha256"].rlike(SHA256), "sha256 has no sound form")]
        else:
            told.append(_fields(F.json_object_keys(m["evidence"]), "evidence"))
        if kind == "edge":
            told.append((F.coalesce(m["type"], F.lit("")) != "Statement", "edge is not of type Statement"))
        parts.append(finding(rows.select("doc_id", F.coalesce(subject, F.lit("")).alias("subject"), F.explode(_told(told)).alias("message")), "T1-01", ERROR, "subject", F.col("message")))
    return union(parts)


def validate(documents: DataFrame, nodes: DataFrame, edges: DataFrame, m: Model, version: str | None = None, index: Index | None = None, ends: DataFrame | None = None) -> DataFrame:
    """Findings of all rules. version: that of the model, if it is one for all layers and not in the model's tables.

    Documents of another version get V-01 only, but their nodes are there for the edges of others. index and ends: those of `indexed` and
    `stored_ends`, where `report` takes them too.
    """
    seen, index = m.seen(), index or indexed(nodes, m)
    ends = with_endpoints(slim_edges(edges), nodes, m, index, told=False) if ends is None else ends
    here = len(WRITTEN)
    docs = checked_documents(documents, seen, version)
    let_go(docs.sparkSession)
    by_layer = len(WRITTEN) > here and seen.layers.count() <= MOST_LAYERS  # documents that go to every task meet rows there
    mine = edges.join(docs.select("doc_id"), "doc_id", "left_semi")
    links = written(near(mine, nodes, m, index))
    parts = [v01_version(documents, seen, version), clash_findings(index)]
    if by_layer:
        others = {r for r, _ in node_rules()} - {"V-03"}
        parts += [_found(prepared_nodes(nodes, None, seen, index.twice), node_rules(), others, F.col("id"), docs), unknown_types(nodes, docs, seen), _found(prepared_edges(ends, None, seen), edge_rules(), None, _edge(), docs)]
        held = kept(seen.classes.where("size(fields) > 0").select("type").distinct())
        parts += [] if held.isEmpty() else [content_findings(prepared_nodes(nodes.join(F.broadcast(held), "type", "left_semi"), docs, seen, index.twice))]
    else:
        prepared = prepared_nodes(nodes, docs, seen, index.twice)
        parts += [_found(prepared, node_rules(), None, F.col("id")), content_findings(prepared), _found(prepared_edges(ends, docs, seen), edge_rules(), None, _edge())]
    kinds = ["recommendation", "publication-element", "citation", "reference-entry"]
    bare = links.isEmpty()
    if not bare or not nodes.where(F.col("type").isin(kinds)).isEmpty():  # else none of these rules has anything to look at
        current = nodes.join(index.twice.select("doc_id", "id", F.col("last").alias("__at")), ["doc_id", "id"], "left").where("__at IS NULL OR ord = __at").drop("__at")
        slim = current.select("doc_id", "id", "type", "properties")
        met = union([links.select(F.col(f"{e}_doc").alias("doc_id"), F.col(e).alias("id")) for e in ("source", "target")]).distinct()
        own = written(slim.where(F.col("type").isin(kinds)).join(docs.select("doc_id"), "doc_id", "left_semi"))
        at = own.limit(0) if bare else written(slim.join(_long(met), ["doc_id", "id"], "left_semi"))
        parts += [f(links, own, at) for f in (publication_findings, slot_findings, certainty_findings, copy_findings)] + [citation_findings(links, own)]
    let_go(docs.sparkSession)
    return union(parts)


def stored_ends(edges: DataFrame, nodes: DataFrame, m: Model | None, index: Index) -> DataFrame:
    """`with_endpoints` in the shared folder, of the columns that rules look at, for `validate` and `report`."""
    held = _with_columns(edges, qualifier="string", note="string", evidence=EVIDENCE, derivation="string", properties="string")
    return written(with_endpoints(held.select("doc_id", "predicate", "source", "target", "qualifier", "note", "evidence", "derivation", "properties"), nodes, m, index))


def report(documents: DataFrame, findings: DataFrame, nodes: DataFrame, edges: DataFrame, m: Model | None = None, index: Index | None = None, ends: DataFrame | None = None) -> DataFrame:
    """V-36: a row for each document: nodes (distinct ids) and edges, in all, by class and by predicate; joins by status; errors,
    warnings and whether it conforms; with a model also edges that reach another document and nodes of classes that declare no properties.

    Maps have one entry a class or predicate. joins is null where no edge has a status. index and ends: as `validate` takes them.
    """
    names = lambda t, by, name: t.groupBy("doc_id", by).agg(F.count("*").alias("n")).groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(by), F.col("n"))))).alias(name), F.sum("n").alias(f"n_{name}"))
    last = lambda t: t.groupBy("doc_id", "id").agg(F.max_by(F.coalesce("type", F.lit("")), F.col("ord")).alias("type"))
    if m is None and index is None:
        last = last(nodes)
    else:  # only ids that a document defines more than once have a last definition to look for
        index = index or indexed(nodes, m)
        again, named = index.twice.select("doc_id", "id"), F.col("doc_id").isNotNull() & F.col("id").isNotNull()
        once = nodes.where(named).join(again, ["doc_id", "id"], "left_anti").select("doc_id", "id", F.coalesce("type", F.lit("")).alias("type"))
        last = once.unionByName(last(nodes.join(again, ["doc_id", "id"], "left_semi").unionByName(nodes.where(~named))))
    by_class = names(last, "type", "by_class").withColumnRenamed("n_by_class", "n_nodes")
    by_predicate = names(edges.withColumn("predicate", F.coalesce("predicate", F.lit(""))), "predicate", "by_predicate").withColumnRenamed("n_by_predicate", "n_edges")
    tally = edges.withColumn("s", _prop("resolutionStatus")).groupBy("doc_id").agg(*[F.count_if(F.col("s") == s).alias(s) for s in ("resolved", "unresolved", "ambiguous")]).where("resolved + unresolved + ambiguous > 0")
    f = findings.groupBy("doc_id").agg(F.count_if(F.col("severity") == ERROR).alias("errors"), F.count_if(F.col("severity") == WARNING).alias("warnings"))
    parts = [by_class, by_predicate, tally.select("doc_id", F.struct("resolved", "unresolved", "ambiguous").alias("joins")), f]
    if m is not None:
        ends = with_endpoints(edges.select("doc_id", "source", "target"), nodes, m, index) if ends is None else ends
        across = F.count_if((F.col("source_doc") != F.col("doc_id")) | (F.col("target_doc") != F.col("doc_id")))
        parts += [ends.where("source_doc IS NOT NULL AND target_doc IS NOT NULL").groupBy("doc_id").agg(across.alias("cross_document_edges")), undeclared_shape(nodes, documents, m).withColumnRenamed("n_nodes", "undeclared_shape")]
    out = documents.select("doc_id")
    for t in parts:
        out = out.join(t, "doc_id", "left")
    return out.na.fill(0).withColumn("conforms", F.col("errors") == 0)
