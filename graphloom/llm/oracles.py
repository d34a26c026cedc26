"""DuckDB SQL with the rows that the queries of this subpackage return."""

WORDS = r"coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), [])"

SQL = {
    "op2_line_dedup": r"""
WITH l AS (
  SELECT doc_id, i, ws FROM (
    SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i,
           array_to_string(regexp_extract_all(unnest(string_split(text, chr(10))), '[^\x20\x09-\x0D]+'), ' ') AS ws
    FROM documents)
  WHERE ws <> ''),
c AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM l),
win AS (
  SELECT a.doc_id, a.n, concat_ws(chr(10), a.ws, b.ws, c2.ws, d.ws) AS w
  FROM c a JOIN c b ON b.doc_id = a.doc_id AND b.n = a.n + 1
  JOIN c c2 ON c2.doc_id = a.doc_id AND c2.n = a.n + 2 JOIN c d ON d.doc_id = a.doc_id AND d.n = a.n + 3),
later AS (SELECT doc_id, n FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, n) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT c.doc_id, c.i FROM (SELECT doc_id, n + k AS n FROM later, range(4) t(k)) g JOIN c USING (doc_id, n)),
every AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i, unnest(string_split(text, chr(10))) AS line FROM documents),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS k FROM every ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, (SELECT count(*) FROM l WHERE l.doc_id = d.doc_id)::BIGINT AS n_lines,
       (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id)::BIGINT AS n_removed_lines,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept.k, '')) END AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)""",
    "op2_content_dedup": r"""
WITH l AS (
  SELECT doc_id, i, array_to_string(ws, ' ') AS ws, len(ws) AS size FROM (
    SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i,
           regexp_extract_all(unnest(string_split(text, chr(10))), '[^\x20\x09-\x0D]+') AS ws
    FROM documents)
  WHERE len(ws) > 0),
c AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM l),
a AS (SELECT doc_id, list(ws ORDER BY n) AS ls, list(size ORDER BY n) AS sizes, count(*) AS lines FROM c GROUP BY doc_id),
every_span AS (SELECT a.*, n, k FROM a, range(1, 5) t(k), unnest(range(1, lines - k + 2)) u(n)),
win AS (
  SELECT doc_id, n, k, false AS whole, array_to_string(ls[n:n + k - 1], chr(10)) AS w FROM every_span WHERE k = 4 OR list_sum(sizes[n:n + k - 1]) >= 50
  UNION ALL SELECT doc_id, 1, lines, true, array_to_string(ls, chr(10)) FROM a WHERE lines < 4 AND list_sum(sizes) < 50),
later AS (SELECT doc_id, n, k FROM (SELECT *, row_number() OVER (PARTITION BY whole, w ORDER BY doc_id, n) AS place FROM win) WHERE place > 1),
gone AS (SELECT DISTINCT c.doc_id, c.i FROM later JOIN c ON c.doc_id = later.doc_id AND c.n BETWEEN later.n AND later.n + later.k - 1),
every AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i, unnest(string_split(text, chr(10))) AS line FROM documents),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS k FROM every ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, (SELECT count(*) FROM l WHERE l.doc_id = d.doc_id)::BIGINT AS n_lines,
       (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id)::BIGINT AS n_removed_lines,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept.k, '')) END AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)""",
    "op3_substring_dedup": f"""
WITH d AS (SELECT doc_id, {WORDS} AS ws FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(ws[s:s + 34], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS s FROM d)),
hit AS (SELECT doc_id, s FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, s + k AS p FROM hit, range(35) t(k)),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS k FROM w ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op5_ngram_join": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {WORDS.replace("text", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                      WHEN len(ws) > 0 THEN ['<' || array_to_string(ws, ' ')] ELSE [] END) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT a AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(b) AS component_id FROM reach LEFT JOIN n ON n.doc_id = a GROUP BY a""",
    "op4_source_mix": f"""
WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT *, least(cap, w * max(level) OVER ()) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t)
SELECT doc_id, size, source_size, target,
       (floor(rate) + CASE WHEN CAST('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE
                                < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT * size AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source""",
    "op9_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha1(coalesce(html, '')) AS d FROM pages),
h AS (SELECT d, max(page_id) AS head FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN n >= 1000 AND head <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND head <> page_id THEN head END AS refers_to
FROM p LEFT JOIN h ON p.d = h.d""",
    "op13_ranked_search": r"""
WITH terms AS (
  SELECT doc_id, row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS row FROM documents)),
sizes AS (SELECT row, count(*) AS n FROM terms GROUP BY row),
all_of AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS l FROM sizes),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY item_id, term),
held AS (SELECT doc_id, row, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, row, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, all_of GROUP BY term),
scored AS (
  SELECT item_id, doc_id, row, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // l))))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (row), all_of GROUP BY item_id, doc_id, row),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20""",
}
