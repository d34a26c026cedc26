"""Queries over texts and pages: ids, citations, markup, coverage of normative text."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import ids
from graphloom.operators import coverage, markup
from graphloom.operators.frontier import closure
from graphloom.operators.graph import first_per_key, union_distinct, with_ordinal
from graphloom.plans.bench_graph import bench_graph, graph_sql, read

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


NS = "https://example.org/kit"


@query(f"""SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name || ' / ' || p_brand), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug, substr(sha256(p_name), 1, 12) AS short,
'{NS}/citation/' || substr(sha256(p_name), 1, 12) AS citation_id, '{NS}/publication/isbn-' || upper(regexp_replace(p_brand || '-' || p_partkey, '[^0-9Xx]', '', 'g')) AS publication_id,
'{NS}/artifact/' || p_brand || '#' || p_partkey AS element_id, CASE WHEN length(p_name) > 8 THEN substr(p_name, 1, 5) || '...' ELSE p_name END AS cut, replace(replace(p_name, chr(92), chr(92) || chr(92)), '''', chr(92) || '''') AS escaped,
CASE WHEN p_size % 2 = 0 THEN '{NS}/recommendation/' || p_size ELSE '{NS}/recommendation/h-' || substr(sha256(lower(p_name)), 1, 12) END AS recommendation_id FROM part""")
def ids_and_slugs(spark, d):
    p = read(spark, d, "part")
    ns, name = F.lit(NS), F.col("p_name")
    isbn = F.array(F.struct(F.lit("doi").alias("type"), F.lit("").alias("value")), F.struct(F.lit("isbn").alias("type"), F.concat_ws("-", "p_brand", F.col("p_partkey").cast("string")).alias("value")))
    number = F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string"))
    plain = lambda c: F.lower(ids.squeezed(c))
    out, findings = ids.mint_ids(p, "part", ["p_partkey"], ids.element_id(ns, F.col("p_brand"), F.col("p_partkey").cast("string")))
    return out.select("p_partkey", ids.ascii_slug(F.concat(name, F.lit(" / "), F.col("p_brand"))).alias("slug"), ids.short_hash(name).alias("short"), ids.citation_id(ns, name).alias("citation_id"), ids.publication_id(isbn, NS).alias("publication_id"), F.col("id").alias("element_id"), ids.cut_label(name, 8).alias("cut"), ids.cypher_escape(name).alias("escaped"), ids.recommendation_id(ns, number, name, plain).alias("recommendation_id"))


@query("""SELECT 'customer-collision' AS rule_id, id AS subject, n || ' keys mint this id' AS message FROM (SELECT c_mktsegment || '/' || c_nationkey AS id, count(DISTINCT c_custkey) AS n FROM customer GROUP BY 1) WHERE n > 1""")
def id_collisions(spark, d):
    c = read(spark, d, "customer")
    return ids.mint_ids(c, "customer", ["c_custkey"], F.concat_ws("/", "c_mktsegment", F.col("c_nationkey").cast("string")))[1]


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(nfc_normalize(text)), '[\x{0300}-\x{036F}]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug, strip_accents(lower(lang)) AS lang FROM documents""")
def text_slugs(spark, d):
    t = read(spark, d, "documents")
    return t.select("doc_id", ids.slug(F.col("text")).alias("slug"), ids.slug(F.col("lang")).alias("lang"))


@query("""WITH kin AS (SELECT page_id, url, CASE WHEN url LIKE 'http://%example.com%' THEN 'http://example.com/kit/bpmn/' ELSE url END AS raw FROM pages)
SELECT page_id, CASE WHEN raw = 'http://example.com/kit/bpmn/' THEN 'https://example.com/kit' ELSE regexp_replace(raw, '/$', '') END AS ns, raw LIKE 'http://example.com%' AS rewritten, regexp_replace(url, '^[^#]*/', '') AS bare FROM kin""")
def kit_namespaces(spark, d):
    p = read(spark, d, "pages")
    raw = F.when(F.col("url").rlike("^http://.*example\\.com.*"), F.lit("http://example.com/kit/bpmn/")).otherwise(F.col("url"))
    return p.select("page_id", ids.kit_namespace(raw, "example.com").alias("ns"), ids.scheme_normalised(raw, "example.com").alias("rewritten"), ids.strip_path(F.col("url")).alias("bare"))


_LINES = r"li AS (SELECT doc_id, trim(replace(unnest(string_split(text, chr(10))), chr(13), ''), ' ') AS c FROM documents), ci AS (SELECT * FROM li WHERE c NOT IN ('', '-', '–'))"


def _cited(spark, d):
    return markup.citations(read(spark, d, "documents"), ["doc_id"], "text")


@query(rf"""WITH {_LINES} SELECT DISTINCT '{NS}/citation/' || substr(sha256(c), 1, 12) AS id, CASE WHEN regexp_matches(c, '^\[.*\]$') THEN 'placeholder' ELSE 'reference' END AS kind,
nullif(regexp_extract(c, '\(([0-9]+)\)\s*$', 1), '') AS numbering, CASE WHEN length(c) > 80 THEN substr(c, 1, 77) || '...' ELSE c END AS label FROM ci""")
def citations(spark, d):
    return markup.citation_nodes(_cited(spark, d), F.lit(NS)).select("id", "kind", "numbering", "label")


@query(f"WITH {_LINES} SELECT doc_id, '{NS}/citation/' || substr(sha256(c), 1, 12) AS target, count(*)::BIGINT AS n FROM ci GROUP BY ALL")
def rule_citations(spark, d):
    return _cited(spark, d).groupBy("doc_id", ids.citation_id(F.lit(NS), F.col("citation")).alias("target")).agg(F.count("*").alias("n"))


@query("""SELECT source, count(*)::BIGINT AS rules, count(*) FILTER (r)::BIGINT AS cited, count(*) FILTER (m AND NOT r)::BIGINT AS placeholder_only, count(*) FILTER (a = 0)::BIGINT AS no_annotations, count(*) FILTER (a > 0 AND text IS NULL)::BIGINT AS short
FROM (SELECT source, doc_id % 3 AS a, t AS text, coalesce(len(list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x, ' ')), lambda x: x NOT IN ('', '-', '–') AND NOT regexp_matches(x, '^\\[.*\\]$'))) > 0, false) AS r,
coalesce(len(list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x, ' ')), lambda x: regexp_matches(x, '^\\[.*\\]$'))) > 0, false) AS m FROM (SELECT *, CASE WHEN doc_id % 4 > 0 THEN CASE WHEN doc_id % 5 = 0 THEN '[later]' ELSE text END END AS t FROM documents)) GROUP BY ALL""")
def citation_coverage(spark, d):
    cell = F.when(F.col("doc_id") % 4 > 0, F.when(F.col("doc_id") % 5 == 0, F.lit("[later]")).otherwise(F.col("text")))
    t = read(spark, d, "documents").select("source", "doc_id", cell.alias("reference"), (F.col("doc_id") % 3).alias("annotations"))
    return markup.citation_coverage(t, ["source"], "doc_id", "reference", "annotations")


def _pages(spark, d):
    return read(spark, d, "pages").select(F.col("page_id").cast("string").alias("path"), F.col("html").alias("text"))


_TAGS = {"nav": "frame", "ul": "list", "li": "item", "a": "link", "p": "text", "h1": "head"}


@query(r"""SELECT page_id::VARCHAR AS path, t AS element, count(*)::BIGINT AS n, count(CASE WHEN regexp_matches(m, '\bhref="') THEN 1 END)::BIGINT AS linked FROM (
SELECT page_id, unnest(regexp_extract_all(html, '<(nav|ul|li|a|p|h1)\b[^>]*>', 1)) AS t, unnest(regexp_extract_all(html, '<(?:nav|ul|li|a|p|h1)\b[^>]*>')) AS m FROM pages) GROUP BY ALL""")
def markup_elements(spark, d):
    t = markup.tags(_pages(spark, d), list(_TAGS)).where("NOT closing")
    return t.groupBy("path", F.col("name").alias("element")).agg(F.count("*").alias("n"), F.count_if(F.col("attributes").rlike(r'\bhref="')).alias("linked"))


@query(r"""SELECT page_id::VARCHAR AS path, replace(replace(replace(replace(replace(h, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS target, count(*)::BIGINT AS n
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\b[^>]*?\bhref="([^"]*)"[^>]*>', 1)) AS h FROM pages) GROUP BY ALL""")
def markup_links(spark, d):
    t = markup.tags(_pages(spark, d), ["a"]).where("NOT closing").withColumn("target", ids.attribute(F.col("attributes"), "href")).where("target IS NOT NULL")
    return t.groupBy("path", "target").agg(F.count("*").alias("n"))


@query(r"""WITH t AS (SELECT page_id, generate_subscripts(l, 1) AS i, unnest(l) AS m FROM (SELECT page_id, regexp_extract_all(html, '</?(?:body|nav|ul|li|p)\b[^>]*>') AS l FROM pages)),
x AS (SELECT *, regexp_extract(m, '(body|nav|ul|li|p)', 1) AS name, m[2] = '/' AS closing FROM t),
y AS (SELECT *, name IN ('body', 'nav', 'ul') AS box FROM x),
z AS (SELECT *, sum(CASE WHEN box AND closing THEN -1 WHEN box THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i) - CASE WHEN box AND NOT closing THEN 1 ELSE 0 END AS depth FROM y)
SELECT page_id::VARCHAR AS path, name AS element, depth::INT AS depth, count(*)::BIGINT AS n FROM z WHERE NOT closing GROUP BY ALL""")
def markup_nesting(spark, d):
    return markup.nesting(_pages(spark, d), ["body", "nav", "ul"], ["li", "p"]).groupBy("path", "element", "depth").agg(F.count("*").alias("n"))


@query(r"""SELECT page_id::VARCHAR AS path, (generate_subscripts(l, 1) - 1)::INT AS ordinal, unnest(l) AS item FROM (SELECT page_id, list_transform(regexp_extract_all(html, '<li\b[^>]*>(.*?)</li>', 1, 's'), lambda x: sha256(x)) AS l FROM pages)""")
def positional_cells(spark, d):
    items = F.transform(F.regexp_extract_all("text", F.lit(r"(?s)<li\b[^>]*>(.*?)</li>"), F.lit(1)), lambda x: F.sha2(x, 256))
    return with_ordinal(_pages(spark, d).select("path", items.alias("items")), "items")


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_type WHEN 4 THEN '-' ELSE k END AS element, CASE WHEN event_id % 5 IN (0, 4) THEN 'bare-expression' WHEN event_id % 5 = 1 THEN 'quoted-left-of-comparison' ELSE 'quoted-operand' END AS rule
FROM (SELECT event_id, event_type, coalesce(json_extract_string(props, '$.k'), '') AS k FROM events) WHERE event_id % 5 IN (0, 4) OR (event_id % 5 IN (1, 3) AND k <> '')""")
def expression_elements(spark, d):
    """Bare, left of a comparison, a value on the right of one, an operand beside a value, and a dash."""
    k = F.coalesce(F.get_json_object("props", "$.k"), F.lit(""))
    part = F.col("event_id") % 5
    e = F.when(part == 0, F.col("event_type")).when(part == 1, F.concat(F.lit('"'), k, F.lit('" ≥ 3 and "'), k, F.lit('"'))).when(part == 2, F.concat(F.lit('≠ "'), k, F.lit('"'))).when(part == 3, F.concat(F.lit('Today - "'), k, F.lit('" and x <= "no"'))).otherwise(F.lit(" - "))
    return markup.data_elements(read(spark, d, "events").select("event_id", e.alias("expression")), ["event_id"], "expression")


@query("SELECT doc_id, count(*)::BIGINT AS n FROM (SELECT doc_id, unnest(string_split_regex(text, '[.!?]+\\s+|\\n+')) AS s FROM documents) WHERE trim(s, chr(32) || chr(9) || chr(10) || chr(13)) NOT IN ('', '.', '!', '?') GROUP BY ALL")
def sentence_counts(spark, d):
    return coverage.sentences(read(spark, d, "documents"), "doc_id", "text", r"[.!?]+\s+|\n+").where("sentence NOT IN ('.', '!', '?')").groupBy("doc_id").agg(F.count("*").alias("n"))


MARKERS = ["with that", "with", "that"]
_SENT = r"s0 AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), s1 AS (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS s FROM s0), s2 AS (SELECT doc_id, i, trim(s, chr(32) || chr(9) || chr(13) || chr(10)) AS s FROM s1), se AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS ordinal, s FROM s2 WHERE s <> '')"
_NORM = rf"{_SENT}, no AS (SELECT * FROM se WHERE regexp_matches(s, '(?i)(^|[^\w])(with\s+that|with|that)([^\w]|$)'))"


def _normative(spark, d):
    return coverage.normative(coverage.sentences(read(spark, d, "documents"), "doc_id", "text", "\n"), MARKERS)


@query(rf"WITH {_NORM} SELECT doc_id, ordinal, s AS sentence FROM no")
def normative(spark, d):
    return _normative(spark, d).select("doc_id", "ordinal", "sentence")


_STATE = rf"""{_NORM}, cap AS (SELECT DISTINCT trim(regexp_replace(unnest(string_split(text, chr(10))), '\s+', ' ', 'g'), ' ') AS k FROM benchmark),
st AS (SELECT doc_id, ordinal, CASE WHEN trim(regexp_replace(s, '\s+', ' ', 'g'), ' ') IN (SELECT k FROM cap) THEN 'captured' WHEN ordinal = 0 AND doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0) THEN 'excluded' ELSE 'unaccounted' END AS state FROM no)"""


def _states(spark, d):
    held = read(spark, d, "benchmark").select(F.explode(F.split("text", "\n")).alias("sentence"))
    out = read(spark, d, "labels").where("toxic = 0").select("doc_id", F.lit(0).alias("ordinal"), F.lit("background-fact").alias("reason"), F.lit("reviewer").alias("signed_by"))
    return coverage.sentence_states(_normative(spark, d), "doc_id", held, out)


@query(f"WITH {_STATE} SELECT doc_id, ordinal, state FROM st")
def coverage_states(spark, d):
    return _states(spark, d).select("doc_id", "ordinal", "state")


_NUMBERS = "SELECT doc_id, count(*)::BIGINT AS normative, count(*) FILTER (state = 'captured')::BIGINT AS captured, count(*) FILTER (state = 'excluded')::BIGINT AS excluded, count(*) FILTER (state = 'unaccounted')::BIGINT AS unaccounted, 100.0::DOUBLE * count(*) FILTER (state = 'captured') / count(*) AS captured_pct, 100.0::DOUBLE * count(*) FILTER (state <> 'unaccounted') / count(*) AS accounted_pct FROM st GROUP BY ROLLUP (doc_id)"


@query(f"WITH {_STATE} {_NUMBERS}")
def coverage_numbers(spark, d):
    return coverage.coverage_numbers(_states(spark, d), "doc_id")


@query("""WITH e AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'background' WHEN 1 THEN 'duplicate-of:' || doc_id WHEN 2 THEN 'whim' END AS reason, CASE WHEN quality = 1 THEN 'r' END AS by_ FROM labels)
SELECT doc_id, 0 AS ordinal, 'unknown reason' AS message FROM e WHERE reason IS NULL OR reason = 'whim' UNION ALL SELECT doc_id, 0, 'duplicate of nothing' FROM e WHERE reason LIKE 'dup%' AND doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en') UNION ALL SELECT doc_id, 0, 'not signed off' FROM e WHERE by_ IS NULL""")
def exclusion_checks(spark, d):
    reason = F.when(F.col("doc_id") % 4 == 0, F.lit("background-fact")).when(F.col("doc_id") % 4 == 1, F.concat(F.lit("duplicate-of:"), "doc_id")).when(F.col("doc_id") % 4 == 2, F.lit("whim"))
    e = read(spark, d, "labels").select("doc_id", F.lit(0).alias("ordinal"), reason.alias("reason"), F.when(F.col("quality") == 1, F.lit("r")).alias("signed_by"))
    return coverage.check_exclusions(e, read(spark, d, "documents").where("lang = 'en'").select(F.col("doc_id").cast("string").alias("id")), "doc_id")


@query(f"""WITH RECURSIVE e AS (SELECT DISTINCT source, target FROM (WITH {graph_sql()} SELECT source, target FROM edges WHERE predicate IN ('partOf', 'locatedIn', 'placedBy'))), c(source, target) AS (SELECT source, target FROM e UNION SELECT c.source, e.target FROM c JOIN e ON e.source = c.target) SELECT source, target FROM c""")
def path_closure(spark, d):
    return closure(bench_graph(spark, d)[1].where("predicate IN ('partOf', 'locatedIn', 'placedBy')").select("source", "target"))


@query("SELECT p_name AS name, min(p_partkey) AS first_part FROM part GROUP BY 1")
def first_definitions(spark, d):
    return first_per_key(read(spark, d, "part"), ["p_name"], ["p_partkey"]).select(F.col("p_name").alias("name"), F.col("p_partkey").alias("first_part"))


@query("SELECT k, CASE WHEN k IN (SELECT c_nationkey FROM customer) THEN 'customer' ELSE 'nation' END AS origin FROM (SELECT c_nationkey AS k FROM customer UNION SELECT n_nationkey FROM nation)")
def distinct_imports(spark, d):
    c = read(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.lit("customer").alias("origin"))
    return union_distinct([c, read(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.lit("nation").alias("origin"))], ["k"])
