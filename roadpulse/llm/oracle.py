"""DuckDB SQL for the operators that SQL can express, over whole tables."""

from __future__ import annotations

_OP3 = r"""
WITH split AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
    FROM documents),
keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM split),
often AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
    SELECT k.*, o.key IS NOT NULL AND o.keeper <> k.doc_id AS gone FROM keyed k LEFT JOIN often o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_OP5 = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
phrases AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS phrase
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM phrases),
spots AS (
    SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS phrase
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc_words, sizes WHERE len(w) >= size)),
found AS (SELECT s.doc_id, s.i, s.size, p.item_id FROM spots s JOIN phrases p ON s.size = p.size AND s.phrase = p.phrase),
hit AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + size)) AS spot FROM (SELECT DISTINCT doc_id, i, size FROM found)) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.joined, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN items i ON i.doc_id = d.doc_id
"""

_OP6 = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 15) AS BIGINT) AS draw
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS weight
    FROM sized GROUP BY source),
-- Every set of full sources is tried by the rank of limit / weight.
ranked AS (
    SELECT *, 3 * source_size AS most, row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS n FROM sources),
remaining AS (
    SELECT *, sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS size_left,
           sum(weight) OVER (ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
    FROM ranked),
common AS (SELECT * FROM remaining WHERE most * weight_left > size_left * weight ORDER BY n LIMIT 1),
targets AS (
    SELECT r.source, r.source_size,
           CASE WHEN (SELECT count(*) FROM common) = 0 OR r.n < (SELECT n FROM common) THEN CAST(r.most AS DOUBLE)
                ELSE CAST(r.weight AS DOUBLE) * CAST((SELECT size_left FROM common) AS DOUBLE)
                     / CAST((SELECT weight_left FROM common) AS DOUBLE) END AS target
    FROM remaining r),
budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
draws AS (
    SELECT source, draw, sum(size) AS edge,
           sum(sum(size)) OVER (PARTITION BY source ORDER BY draw) AS upto
    FROM sized GROUP BY source, draw),
edges AS (
    SELECT d.source, arg_min(d.draw, d.draw) AS draw, arg_min(d.edge, d.draw) AS edge,
           arg_min(b.target - b.whole * b.source_size - (d.upto - d.edge), d.draw) AS budget
    FROM draws d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
    WHERE d.upto > b.target - b.whole * b.source_size GROUP BY d.source)
SELECT s.doc_id, s.size, b.source_size, b.target,
       CAST(s.size * least(3, b.whole + CASE
           WHEN e.draw IS NULL OR s.draw < e.draw OR s.draw = e.draw AND e.edge - e.budget < e.budget THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized s
JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
LEFT JOIN edges e ON s.source IS NOT DISTINCT FROM e.source
"""

_OP8 = """
WITH good AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM good q JOIN good c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


_OP12 = r"""
WITH RECURSIVE cut AS (
    SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (
    SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
    SELECT u.host AS uh, u.path AS up, arg_max(r.h || r.p, length(r.h || r.p)) AS rule, arg_max(r.v, length(r.h || r.p)) AS verdict
    FROM (SELECT DISTINCT host, path FROM named) u
    JOIN rules r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p)
    GROUP BY 1, 2),
judged AS (SELECT n.*, f.rule, f.verdict FROM named n LEFT JOIN fits f ON n.host = f.uh AND n.path = f.up),
links AS (
    SELECT host AS source, target, count(*) AS n FROM (
        SELECT DISTINCT page_id, host, translate(regexp_extract(u, '//([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target
        FROM (SELECT page_id, host, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?\bhref\s*=\s*["'']?\s*((?:[a-z][a-z0-9+.\-]*:)?//[^"''\s>]+)', 1)) AS u
              FROM judged WHERE host <> ''))
    WHERE target <> '' AND target <> host GROUP BY 1, 2),
steps AS (
    SELECT source AS a, target AS b, 'trust' AS kind, n / sum(n) OVER (PARTITION BY source) AS share FROM links
    UNION ALL SELECT target, source, 'distrust', n / sum(n) OVER (PARTITION BY target) FROM links),
walk AS (
    SELECT 0 AS n, host, kind, 0.15 * avg(CASE WHEN verdict = v THEN 1.0 ELSE 0.0 END) AS mass
    FROM judged, (VALUES ('trust', 'allow'), ('distrust', 'block')) k(kind, v) WHERE host <> '' GROUP BY host, kind
    UNION ALL
    SELECT w.n + 1, s.b, w.kind, sum(w.mass * s.share * 0.85) FROM walk w JOIN steps s ON w.host = s.a AND w.kind = s.kind
    WHERE w.n < 60 AND w.mass > 0 GROUP BY w.n, s.b, w.kind),
scores AS (
    SELECT host AS h, coalesce(sum(mass) FILTER (kind = 'distrust'), 0) - coalesce(sum(mass) FILTER (kind = 'trust'), 0) AS bad FROM walk GROUP BY host)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN bad >= 0.5 * 0.15 - 1e-9 THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN scores ON host = h
"""

# The digits of an id go through CRC-32 bit by bit.
_OP13 = r"""
WITH RECURSIVE turns AS (
    SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[:32]) AS n
    FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT conv_id, list(t ORDER BY n) AS turns FROM turns GROUP BY conv_id),
crc(conv_id, n, v) AS (
    SELECT conv_id, 0, CAST(4294967295 AS BIGINT) FROM lists
    UNION ALL
    SELECT conv_id, n + 1, xor(x >> 1, CASE WHEN x & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)
    FROM (SELECT *, CASE WHEN n % 8 = 0 THEN xor(v, ascii(substr(CAST(conv_id AS VARCHAR), n // 8 + 1, 1))) ELSE v END AS x FROM crc
          WHERE n < 8 * length(CAST(conv_id AS VARCHAR)))),
heads AS (SELECT conv_id, xor(arg_max(v, n), CAST(4294967295 AS BIGINT)) % 9 AS h FROM crc GROUP BY conv_id),
rebuilt AS (
    SELECT l.conv_id, list_concat(coalesce(g.turns, [])[:h.h], l.turns[h.h + 1:]) AS turns
    FROM lists l JOIN heads h USING (conv_id) LEFT JOIN lists g ON g.conv_id = l.conv_id - l.conv_id % 5),
-- A prefix is named by a digest of the digests of its turns.
marks AS (SELECT conv_id, len(turns) AS size, turns, list_transform(turns, lambda t: sha256(length(t.role) || ':' || t.role || t.text)) AS m FROM rebuilt),
visits AS (
    SELECT conv_id, size, d AS depth, sha256(array_to_string(m[:d], ',')) AS node,
           CASE WHEN d > 0 THEN sha256(array_to_string(m[:d - 1], ',')) END AS up,
           CASE WHEN d > 0 THEN strlen(turns[d].text) ELSE 0 END AS bytes
    FROM (SELECT *, unnest(range(0, size + 1)) AS d FROM marks)),
nodes AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(up) AS up, any_value(bytes) AS bytes,
           coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '') AS ends
    FROM visits GROUP BY node, depth),
children AS (SELECT up AS node, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
own AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.node = n.node AND c.depth = n.depth),
-- The prefixes of a node are those of its smallest member up to its depth.
sums AS (
    SELECT v.node, v.depth, sum((o.n_children = 0)::BIGINT) AS n_leaves, sum((o.n_convs - 1) * o.bytes) AS saved
    FROM own o JOIN visits v ON v.conv_id = o.conv_id AND v.depth <= o.depth GROUP BY 1, 2)
SELECT o.conv_id, CAST(o.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(o.ends) AS ends_sha256
FROM own o JOIN sums s ON s.node = o.node AND s.depth = o.depth LEFT JOIN own p ON p.node = o.up AND p.depth = o.depth - 1
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query name."""
    return {"op3_line_dedup": _OP3, "op5_fm_decontam": _OP5, "op6_hash_mix": _OP6, "op8_tput_search": _OP8,
            "op12_link_filter": _OP12, "op13_prefix_trie": _OP13}
