"""DuckDB SQL of the registered queries that SQL can express."""

OP1 = r"""
WITH said AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL)
), asked AS (
  SELECT *, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY conv_id) AS n
  FROM said WHERE role = 'assistant' WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
), spot AS (
  SELECT conv_id, pos AS d FROM asked WHERE k = conv_id % n
), answers AS (
  SELECT xor(conv_id, 1::BIGINT) AS conv_id, role, text FROM asked WHERE k = n - 1
), chosen AS (
  SELECT conv_id, pos, role, text FROM said
), rejected AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY o) AS pos, role, text
  FROM (SELECT conv_id, pos AS o, role, text FROM said LEFT JOIN spot USING (conv_id) WHERE pos IS DISTINCT FROM d
        UNION ALL
        SELECT conv_id, d, role, text FROM spot JOIN answers USING (conv_id))
), differs AS (
  SELECT conv_id, min(pos) AS first FROM chosen c FULL JOIN rejected r USING (conv_id, pos)
  WHERE c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text GROUP BY conv_id
), common AS (
  SELECT conv_id, coalesce(first - 1, n)::INT AS n_common
  FROM (SELECT conv_id, max(pos) AS n FROM said GROUP BY conv_id) LEFT JOIN differs USING (conv_id)
), drawn AS (
  SELECT side, conv_id, pos, n_common, role,
         '<|' || replace(role, '<|', '< |') || '|>' || chr(10) AS head,
         replace(text, '<|', '< |') || '<|end|>' AS body
  FROM (SELECT 'c' AS side, * FROM chosen UNION ALL SELECT 'r', * FROM rejected) JOIN common USING (conv_id)
), placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
              PARTITION BY side, conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            + length(head) AS start
  FROM drawn WHERE pos > n_common
), tails AS (
  SELECT side, conv_id, string_agg(head || body || chr(10), '' ORDER BY pos) AS tail,
         string_agg(start::BIGINT || '-' || (start + length(body))::BIGINT, ',' ORDER BY pos)
           FILTER (role = 'assistant') AS spans
  FROM placed GROUP BY side, conv_id
), prompts AS (
  SELECT conv_id, string_agg(head || body || chr(10), '' ORDER BY pos) AS prompt
  FROM drawn WHERE side = 'c' AND pos <= n_common GROUP BY conv_id
)
SELECT conv_id, n_common, coalesce(prompt, '') AS prompt,
       coalesce(c.tail, '') AS chosen, coalesce(r.tail, '') AS rejected,
       coalesce(c.spans, '') AS chosen_spans, coalesce(r.spans, '') AS rejected_spans
FROM common LEFT JOIN prompts USING (conv_id)
LEFT JOIN (SELECT * FROM tails WHERE side = 'c') c USING (conv_id)
LEFT JOIN (SELECT * FROM tails WHERE side = 'r') r USING (conv_id)
"""

OP4 = """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

OP3 = r"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, unnest(list_distinct(CASE
           WHEN len(w) = 0 THEN []
           WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END)) AS s
  FROM lowered
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), sized AS (
  SELECT doc_id, s, n FROM sets JOIN sizes USING (doc_id)
), alike AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM sized x JOIN sized y
  ON x.s = y.s AND x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), links AS (
  SELECT a, b FROM alike UNION ALL SELECT b, a FROM alike
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

OP10 = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, 'null') || ':mix:' || coalesce(text, '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([3.0, 1.0, 2.0])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM sized GROUP BY source
), filled AS (
  SELECT source, source_size, w, source_size * 2.0::DOUBLE AS most, most / w AS level,
         row_number() OVER (ORDER BY source_size * 2.0::DOUBLE / w, source NULLS LAST) AS r
  FROM totals
), steps AS (
  SELECT *, sum(most) OVER (ORDER BY r) + level * (sum(w) OVER () - sum(w) OVER (ORDER BY r))
            <= sum(source_size) OVER () * 1.5::DOUBLE AS sated
  FROM filled
), targets AS (
  SELECT source, source_size,
         CASE WHEN sated THEN most ELSE w * ((sum(source_size) OVER () * 1.5::DOUBLE
           - coalesce(sum(most) FILTER (sated) OVER (), 0)) / sum(w) FILTER (NOT sated) OVER ()) END AS target
  FROM steps
), placed AS (
  SELECT doc_id, s.source, s.size, t.source_size::BIGINT AS source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY k, doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS passes FROM placed
)
SELECT doc_id, source, size, source_size, target,
       (passes * size + greatest(0, least(size, floor(target)::BIGINT - passes * source_size - before)))::BIGINT AS taken
FROM cut
"""

OP6 = """
WITH RECURSIVE sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, component_id,
       vec_id = component_id AS kept
FROM (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
"""

TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP12 = f"""
WITH d AS (
  SELECT doc_id, {TERMS} AS terms FROM documents
), len AS (
  SELECT doc_id, len(terms) AS n FROM d WHERE len(terms) > 0
), total AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM len
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d) GROUP BY ALL
), weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total
), wanted AS (
  SELECT DISTINCT item_id, unnest({TERMS}) AS term FROM benchmark
), scored AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT AS score
  FROM wanted JOIN weight USING (term) JOIN tf USING (term) JOIN len USING (doc_id), total GROUP BY ALL
)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank
      FROM scored WHERE score > 0)
WHERE rank <= 50
"""

OP11 = r"""
WITH RECURSIVE rules(domain, prefix, rule_verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), parted AS (
  SELECT page_id, html, row_number() OVER () AS id,
         CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), given AS (
  SELECT page_id, html, id,
         translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1), '') AS path
  FROM parted
), matched AS (
  SELECT id, domain || prefix AS rule, rule_verdict,
         row_number() OVER (PARTITION BY id ORDER BY length(domain || prefix) DESC, length(domain) DESC) AS n
  FROM given JOIN rules
    ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, prefix)
), ruled AS (
  SELECT g.*, rule, rule_verdict FROM given g LEFT JOIN (SELECT * FROM matched WHERE n = 1) m ON g.id = m.id
), hosts AS (
  SELECT host, count(*) FILTER (rule_verdict = 'allow') / count(*) AS trust,
         count(*) FILTER (rule_verdict = 'block') / count(*) AS distrust
  FROM ruled GROUP BY host
), found AS (
  SELECT DISTINCT id, host AS a, translate(unnest(regexp_extract_all(html,
    '(?i)<a\s[^<>]*?\bhref\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.-]{0,20}:)?//([^/?#"''<>\s]+)', 1)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS b
  FROM given WHERE host <> ''
), links AS (
  SELECT a, b, n / sum(n) OVER (PARTITION BY a) AS w
  FROM (SELECT a, b, count(*) AS n FROM found WHERE a <> b GROUP BY a, b)
), named AS (
  SELECT DISTINCT host FROM (SELECT host FROM hosts UNION ALL SELECT b FROM links)
  WHERE host <> '' AND length(host) <= 253 AND NOT regexp_matches(host, '(^|\.)[0-9]+(:[0-9]+)?$')
), above(a, b) AS (
  SELECT host, host FROM named
  UNION
  SELECT b, substr(b, strpos(b, '.') + 1) FROM above WHERE contains(substr(b, strpos(b, '.') + 1), '.')
), near AS (
  SELECT DISTINCT a, b FROM above WHERE a <> b AND contains(a, '.')
), ways AS (
  SELECT a, b FROM near UNION ALL SELECT b, a FROM near
), weighed AS (
  SELECT a, b, sum(w) AS w FROM (
    SELECT a, b, w FROM links UNION ALL SELECT a, b, 0.25::DOUBLE / count(*) OVER (PARTITION BY a) FROM ways)
  GROUP BY a, b
), edges AS (
  SELECT a, b, w / sum(w) OVER (PARTITION BY a) AS w FROM weighed
), flows AS (
  SELECT a AS src, b AS dst, 'trust' AS kind, w FROM edges
  UNION ALL
  SELECT b, a, 'distrust', w / sum(w) OVER (PARTITION BY b) FROM edges
), steps(n, host, kind, score) AS (
  SELECT 0, host, kind, seed * 0.15::DOUBLE
  FROM (SELECT host, 'trust' AS kind, trust AS seed FROM hosts UNION ALL SELECT host, 'distrust', distrust FROM hosts)
  WHERE seed > 0
  UNION ALL
  SELECT n + 1, dst, s.kind, sum(w * score * 0.85::DOUBLE)
  FROM steps s JOIN flows f ON s.host = f.src AND s.kind = f.kind WHERE n < 43 GROUP BY n, dst, s.kind
), sides AS (
  SELECT host, round(coalesce(sum(score) FILTER (kind = 'trust'), 0), 9) AS trust,
         round(coalesce(sum(score) FILTER (kind = 'distrust'), 0), 9) AS distrust
  FROM steps GROUP BY host
)
SELECT page_id, r.host, path, rule,
       coalesce(rule_verdict, CASE WHEN round(distrust - 0.5::DOUBLE * (trust + distrust), 9) > 0
                                   THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r LEFT JOIN sides s ON r.host = s.host
"""

ORACLES = {
    "op1_preference_chat": OP1,
    "op3_minhash_near_dedup": OP3,
    "op4_exact_dedup": OP4,
    "op6_embedding_near_dedup": OP6,
    "op10_mixing": OP10,
    "op11_url_filter": OP11,
    "op12_lexical_search": OP12,
}
