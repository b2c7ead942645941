"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from sluice.llm import site_lines

OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM (SELECT DISTINCT vec_id, embedding FROM embeddings)
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

OP3 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
), t AS (SELECT CAST(sum(source_size) AS DOUBLE) AS total FROM s),
-- with the k sources of least cap / weight at their caps, the rest share what is left by weight
k AS (
  SELECT *, 3.0 * source_size / weight AS ratio,
         coalesce(sum(3.0 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_from
  FROM s WINDOW o AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST)
), l AS (
  SELECT coalesce(min_by(level, ratio) FILTER (WHERE level < ratio), 0) AS level
  FROM (SELECT ratio, (total - full_before) / open_from AS level FROM k, t)
), g AS (
  SELECT source, source_size, least(3.0 * source_size, weight * level) AS target FROM s, l
), p AS (
  SELECT d.doc_id, d.size, g.source_size, CAST(g.target AS DOUBLE) AS target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(concat_ws(':', '17', coalesce(CAST(doc_id AS VARCHAR), ''), CAST(size AS VARCHAR))), doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + d.size / 2 AS mid
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0 ELSE size * ((mid < target)::INT + (mid + source_size < target)::INT
            + (mid + 2 * source_size < target)::INT + (mid + 3 * source_size < target)::INT) END AS BIGINT) AS taken
FROM p
"""

OP10 = rf"""
WITH p AS (
  SELECT page_id, nullif(regexp_extract(lower(url), '{site_lines.HOST}', 1), '') AS host,
    list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
      '{site_lines.HIDDEN}', ' ', 'gis'), '{site_lines.BREAKS}', chr(10), 'gi'), '<[^>]*>', '', 'g'), chr(10)),
      lambda x: trim(x)), lambda x: x <> '') AS lines
  FROM pages
), t AS (SELECT host, count(*) AS n FROM p WHERE host IS NOT NULL GROUP BY host HAVING count(*) >= 5),
c AS (
  SELECT host, line, count(*) AS c
  FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM p WHERE host IS NOT NULL) GROUP BY host, line
), b AS (
  SELECT c.host, list(line) AS common FROM c JOIN t USING (host) WHERE c.c > 0.2 * t.n GROUP BY c.host
), k AS (
  SELECT p.*, list_filter(lines, lambda x: NOT list_contains(coalesce(common, []), x)) AS kept FROM p LEFT JOIN b USING (host)
)
SELECT page_id, host, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(kept) AS BIGINT) AS n_dropped,
       array_to_string(kept, chr(10)) AS text
FROM k
"""


OP7 = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(ws[i:i + 2], ' ') AS g FROM d, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) t(i) WHERE len(ws) > 0
), n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
e AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.r <> y.r GROUP BY 1, 2) p
  JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * c >= 90 * (na.n + nb.n - c)
), reach AS (
  SELECT DISTINCT a AS r, a AS q FROM e UNION SELECT reach.r, e.b FROM reach JOIN e ON reach.q = e.a
), least AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON reach.q = d.r GROUP BY 1),
deg AS (SELECT a AS r, count(*) AS n_links FROM e GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least.component_id, d.doc_id) AS component_id, coalesce(deg.n_links, 0) AS n_links
FROM d LEFT JOIN n USING (r) LEFT JOIN least USING (r) LEFT JOIN deg USING (r)
"""

OP9 = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), w AS MATERIALIZED (
  SELECT r, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM d, unnest(range(1, len(ws) - 33)) t(i)
), twice AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, i + o AS j FROM w JOIN twice USING (h), range(35) x(o)),
kept AS (
  SELECT p.r, string_agg(word, ' ' ORDER BY p.j) AS text, count(*) AS n
  FROM (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM d) p LEFT JOIN gone ON gone.r = p.r AND gone.j = p.j
  WHERE gone.r IS NULL GROUP BY p.r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP11 = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL
), s AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS total FROM d WHERE len(ts) > 0),
q AS MATERIALIZED (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark WHERE text IS NOT NULL
), p AS MATERIALIZED (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t
), w AS (
  SELECT t, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY t
), i AS MATERIALIZED (
  SELECT p.r, p.t, w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(d.ts) * n_docs) // total))) AS impact
  FROM p JOIN w USING (t) JOIN d USING (r), s
), x AS (
  SELECT q.item_id, i.r, CAST(sum(impact) AS BIGINT) AS score FROM q JOIN i USING (t) GROUP BY 1, 2
)
SELECT x.item_id, CAST(row_number() OVER o AS INTEGER) AS rank, d.doc_id, x.score
FROM x JOIN d USING (r) WHERE score > 0 WINDOW o AS (PARTITION BY x.item_id ORDER BY score DESC, d.doc_id NULLS LAST)
QUALIFY row_number() OVER o <= 50
"""

OP12 = """
WITH t AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS no
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  -- CRC-32 of the decimal id, bit by bit: -1 stands for a shift, other values for a byte
  SELECT conv_id, conv_id - conv_id % 100 AS base, n, xor(4294967295, list_reduce(
           list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
             lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, v: CASE WHEN v >= 0 THEN xor(a, v) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)) % 6 AS h
  FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id)
), r AS (
  SELECT c.conv_id, t.no AS d, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.no <= c.h
  UNION ALL
  SELECT c.conv_id, t.no - c.h + least(c.h, coalesce(b.n, 0)), t.role, t.text
  FROM c JOIN t USING (conv_id) LEFT JOIN c b ON b.conv_id = c.base WHERE t.no > c.h
), s AS MATERIALIZED (
  SELECT c.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY d) FILTER (WHERE d IS NOT NULL), []) AS seq
  FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id
), p AS (
  SELECT conv_id, d AS depth, seq[1:d] AS node, len(seq) = d AS ends FROM s, unnest(range(0, len(seq) + 1)) x(d)
), g AS MATERIALIZED (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM p GROUP BY node, depth
), k AS (SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY 1, 2),
below AS (
  SELECT a.node, a.depth, sum(CASE WHEN b.depth > 0 THEN (b.n_convs - 1) * length(b.node[b.depth].text) ELSE 0 END) AS saved,
         count_if(k.node IS NULL) AS n_leaves
  FROM g b LEFT JOIN k ON k.node = b.node AND k.depth = b.depth, unnest(range(0, b.depth + 1)) x(d)
  JOIN g a ON a.depth = d AND a.node = b.node[1:d] GROUP BY 1, 2
)
SELECT g.conv_id, g.depth, up.conv_id AS parent_conv_id, g.n_convs, coalesce(k.n_children, 0) AS n_children,
       CAST(below.n_leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, g.ends_sha256
FROM g JOIN below USING (node, depth) LEFT JOIN k USING (node, depth)
LEFT JOIN g up ON g.depth > 0 AND up.depth = g.depth - 1 AND up.node = g.node[1:g.depth - 1]
"""

OP13 = """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND (page_id IS NULL OR page_id > first) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND (page_id IS NULL OR page_id > first) THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_nra_topk": OP2, "op3_curriculum": OP3, "op7_pigeonhole_join": OP7, "op9_automaton_dedup": OP9, "op10_site_lines": OP10,
            "op11_best_position": OP11, "op12_conversation_trie": OP12, "op13_warc": OP13}
