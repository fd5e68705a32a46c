"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

_WINDOWS = r"""
    words_of_items AS (
        SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, least(len(w), 13) AS n,
            array_to_string(w[s : s + least(len(w), 13) - 1], ' ') AS run
        FROM words_of_items, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS t(s)
        WHERE len(w) > 0)
"""

OP4 = """
WITH sized AS (
        SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS n FROM pages),
    firsts AS (SELECT payload, min(page_id) AS original FROM sized WHERE n >= 100 GROUP BY payload)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
    CASE WHEN original IS NULL OR original = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN original <> page_id THEN original END AS refers_to
FROM sized LEFT JOIN firsts USING (payload)
"""

OP5 = f"""
WITH {_WINDOWS},
    doc_words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
        FROM documents),
    runs AS (
        SELECT doc_id, l.n, s, array_to_string(w[s : s + l.n - 1], ' ') AS run
        FROM doc_words, (SELECT DISTINCT n FROM windows) l, unnest(range(1, len(w) - l.n + 2)) AS t(s)),
    found AS (SELECT doc_id, s, n, item_id FROM runs JOIN windows USING (n, run)),
    hit AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM found, unnest(range(s, s + n)) AS t(p) GROUP BY doc_id),
    named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP6 = r"""
WITH RECURSIVE
    rules(verdict, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
        ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
    tags AS (
        SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag
        FROM pages WHERE contains(url, '://')),
    targets AS (
        SELECT url, CASE
            WHEN regexp_matches(tag, '(?is)\brel\s*=\s*["'']?canonical\b')
                THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
            WHEN regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')
                THEN regexp_extract(tag, '(?is)\burl\s*=\s*["'']?([^"''>]+)', 1) END AS target
        FROM tags),
    links AS (
        SELECT DISTINCT regexp_replace(url, '(?s)#.*$', '') AS a, regexp_replace(target, '(?s)#.*$', '') AS b
        FROM targets WHERE contains(target, '://')),
    near AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (SELECT a, b FROM near UNION SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a),
    urls AS (SELECT url AS u FROM pages UNION SELECT a FROM near),
    parts AS (
        SELECT u,
            translate(regexp_extract(coalesce(u, ''), '(?s)^.*?://([^/?#]*)', 1),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(coalesce(u, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
        FROM urls),
    own AS (
        SELECT u, any_value(p.host) AS host, any_value(p.path) AS path,
            arg_max(r.host || r.path, len(r.host || r.path) * 1000 + len(r.host)) AS rule,
            arg_max(r.verdict, len(r.host || r.path) * 1000 + len(r.host)) AS verdict
        FROM parts p LEFT JOIN rules r
            ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
        GROUP BY u),
    passed AS (
        SELECT reach.a AS u, max(own.verdict = 'block') AND NOT max(coalesce(own.verdict, '') = 'allow') AS blocked
        FROM reach JOIN own ON reach.b = own.u GROUP BY reach.a)
SELECT page_id, host, path, rule,
    coalesce(verdict, CASE WHEN coalesce(blocked, false) THEN 'block' ELSE 'allow' END) AS verdict
FROM pages JOIN own ON pages.url IS NOT DISTINCT FROM own.u
LEFT JOIN passed ON passed.u = regexp_replace(pages.url, '(?s)#.*$', '')
"""

OP10 = r"""
WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
        FROM documents),
    totals AS (
        SELECT source, sum(size)::BIGINT AS source_size,
            ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
        FROM sized GROUP BY source),
    levels AS (
        SELECT *, 3.0::DOUBLE * source_size AS cap,
            (sum(source_size) OVER () - coalesce(sum(3.0::DOUBLE * source_size) OVER (
                ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM totals),
    targets AS (SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target FROM levels),
    ranked AS (
        SELECT s.doc_id, s.size, t.source_size, t.target,
            CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
            ('0x' || substr(md5('mix:' || coalesce(s.source, chr(0))), 1, 6))::BIGINT / 16777216.0::DOUBLE AS u,
            row_number() OVER (PARTITION BY s.source ORDER BY s.size, md5(s.doc_id::VARCHAR), s.doc_id) AS i
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
    (least(floor(u + i * rate) - floor(u + (i - 1) * rate), 3) * size)::BIGINT AS taken
FROM ranked
"""

OP13 = r"""
WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
    known AS (
        SELECT lang, w[s : s + m - 1] AS p, count(*) AS f
        FROM words, (VALUES (1), (2), (3), (4)) AS sizes(m), unnest(range(1, len(w) - m + 2)) AS t(s)
        GROUP BY lang, p HAVING count(*) >= 30),
    covered AS (
        SELECT lang, p[s : s + m - 1] AS p, max(f) AS longer
        FROM known, (VALUES (2), (3)) AS sizes(m), unnest(range(1, len(p) - m + 2)) AS t(s)
        WHERE len(p) > m GROUP BY ALL),
    kept AS (
        SELECT lang, p, f FROM known LEFT JOIN covered USING (lang, p)
        WHERE len(p) > 1 AND NOT coalesce(100::HUGEINT * longer >= 80::HUGEINT * f, false)),
    cuts AS (
        SELECT k.lang, k.p, k.f, c, a.f AS l, b.f AS r, (2000000::HUGEINT * k.f) // (a.f + b.f) AS score
        FROM kept k, unnest(range(1, len(k.p))) AS t(c), known a, known b
        WHERE a.lang = k.lang AND b.lang = k.lang AND a.p = k.p[1 : c] AND b.p = k.p[c + 1 :]),
    worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
    ranked AS (
        SELECT *, array_to_string(p, ' ') AS phrase,
            row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, array_to_string(p, ' ')) AS rank
        FROM worst)
SELECT lang, rank, phrase, f AS a, l, r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def all_checks() -> dict[str, str]:
    return {"op4_warc": OP4, "op5_decontaminate": OP5, "op6_url_filter": OP6, "op10_source_mix": OP10, "op13_collocations": OP13}
