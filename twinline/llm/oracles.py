"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

REACHED = """
, reached AS (
  SELECT id, id AS root FROM nodes
  UNION
  SELECT l.a, r.root FROM reached r JOIN links l ON l.b = r.id
), component AS (SELECT id, min(root) AS component_id FROM reached GROUP BY id)
"""

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 64)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored
)
SELECT query_id, CAST(n AS INTEGER) AS "rank", vec_id, score FROM ranked WHERE n <= 20
"""

COSINE = (
    """
WITH RECURSIVE v AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), u AS (
  SELECT id, v, sqrt(list_inner_product(v, v)) AS n FROM v WHERE list_inner_product(v, v) > 0
), links AS (
  SELECT a.id AS a, b.id AS b FROM u a JOIN u b ON a.id <> b.id WHERE list_inner_product(a.v, b.v) / (a.n * b.n) >= 0.9
), nodes AS (SELECT DISTINCT vec_id AS id FROM embeddings), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
"""
    + REACHED
    + """
SELECT c.id AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, component_id = c.id AS kept
FROM component c LEFT JOIN counts ON a = c.id
"""
)

SHINGLES = (
    r"""
WITH RECURSIVE words AS (
  SELECT doc_id AS id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))) END AS s FROM words
), nodes AS (SELECT id FROM sets), shingles AS (SELECT id, len(s) AS n, unnest(s) AS s FROM sets),
common AS (
  SELECT a.id AS a, b.id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.id <> b.id
  GROUP BY ALL
), links AS (SELECT a, b FROM common WHERE 100 * c >= 85 * (na + nb - c))
"""
    + REACHED
    + """
SELECT c.id AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, component_id = c.id AS kept
FROM component c JOIN sets ON sets.id = c.id
"""
)

_PATTERNS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
    ("owned", "[A-Za-z0-9+/_=-]{20,}", 0, 20),
)


def _found(kind: int) -> str:
    name, pattern, group, least = _PATTERNS[kind]
    return f"""
  SELECT doc_id, owner, repo, {kind} AS kind, f['s'] AS s, f['s'] + f['n'] AS e, f['v'] AS v FROM (
    SELECT doc_id, owner, repo, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
      's': list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0),
      'n': length(m[i]), 'v': g[i]}})) AS f
    FROM (SELECT doc_id, owner, repo, regexp_split_to_array(t, '{pattern}') AS p,
      regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {group}) AS g FROM d)
  ) WHERE length(f['v']) >= {least}"""


SECRETS = (
    """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS owner, coalesce(source, '') || '/' || coalesce(lang, '') AS repo, coalesce(text, '') AS t
  FROM documents
), base AS ("""
    + "\n  UNION ALL".join(_found(k) for k in range(3))
    + """
), more AS (
  SELECT * FROM ("""
    + _found(3)
    + r"""
  ) c WHERE regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[0-9]')
    AND len(list_distinct(string_split(v, ''))) >= 8
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = c.doc_id AND b.s < c.e AND c.s < b.e)
), spans AS (SELECT * FROM base UNION ALL SELECT * FROM more),
verdicts AS (
  SELECT v, count(DISTINCT owner) < 3 AND count(DISTINCT (owner, repo)) < 4 AS live FROM spans GROUP BY v
), judged AS (
  SELECT doc_id, kind, s, e, live, ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || s || ':' || e AS span
  FROM spans JOIN verdicts USING (v) WHERE kind < 3 OR live
), per_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(span, ',' ORDER BY s, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY s, kind) AS spans,
    count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
  FROM judged GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN per_doc USING (doc_id)
"""
)

REPEATS = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), windows AS (
  SELECT r, i, sha256(array_to_string(w[i:i+34], ' ')) AS h FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)
), repeated AS (
  SELECT r, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)
), covered AS (
  SELECT DISTINCT r, i + k AS i FROM repeated, (SELECT unnest(range(35)) AS k)
), kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY i) AS text, count(*) AS n
  FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d) ANTI JOIN covered USING (r, i) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

INFILL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
    sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents
), drawn AS (
  SELECT *, CAST(len(w) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d
), ranks AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT *, array_to_string(w[1:a], '') AS p, array_to_string(w[a+1:b], '') AS m, array_to_string(w[b+1:n], '') AS s FROM ranks
), written AS (
  SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output FROM parts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars, sha256(output) AS output_sha256, sha256(t) AS restored_sha256
FROM written
"""

ORACLES = {
    "op3_norm_sorted_topk": TOPK,
    "op6_ownership_secrets": SECRETS,
    "op7_cover_tree": COSINE,
    "op8_odd_sketch": SHINGLES,
    "op11_superkmer_repeats": REPEATS,
    "op13_skip_list_infill": INFILL,
}
