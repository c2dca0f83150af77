"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

MIX = """
WITH RECURSIVE docs AS (
  SELECT doc_id, source, lang,
    CASE WHEN contains(t, 'license') OR contains(t, 'License') OR contains(t, 'LICENSE')
           OR contains(t, 'copyright') OR contains(t, 'Copyright') THEN 'legal'
         WHEN contains(t, '@') THEN 'contact'
         WHEN contains(t, ' | ') THEN 'table'
         WHEN contains(t, 'http://') OR contains(t, 'https://') OR contains(t, 'www.') THEN 'web'
         ELSE 'prose' END AS topic,
    CAST((strlen(t) + 3) // 4 AS BIGINT) AS tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)
),
sums AS (SELECT source, lang, topic, sum(tokens) AS n FROM docs GROUP BY ALL HAVING sum(tokens) > 0),
own AS (
  SELECT (SELECT sum(n) FROM sums) AS total
),
gs AS (
  SELECT source, least(total * power(n, 0.9) / sum(power(n, 0.9)) OVER (), n) AS g
  FROM (SELECT source, CAST(sum(n) AS DOUBLE) AS n FROM sums GROUP BY source) CROSS JOIN own
),
gl AS (
  SELECT lang, least(total * power(n, 0.9) / sum(power(n, 0.9)) OVER (), n) AS g
  FROM (SELECT lang, CAST(sum(n) AS DOUBLE) AS n FROM sums GROUP BY lang) CROSS JOIN own
),
gt AS (
  SELECT topic, least(total * power(n, 0.9) / sum(power(n, 0.9)) OVER (), n) AS g
  FROM (SELECT topic, CAST(sum(n) AS DOUBLE) AS n FROM sums GROUP BY topic) CROSS JOIN own
),
common AS (
  SELECT least((SELECT sum(g) FROM gs), (SELECT sum(g) FROM gl), (SELECT sum(g) FROM gt)) AS goal
),
fit AS (
  SELECT 0 AS r, sums.source, sums.lang, sums.topic, CAST(n AS DOUBLE) AS n,
    gs.g * goal / (SELECT sum(g) FROM gs) AS a, gl.g * goal / (SELECT sum(g) FROM gl) AS b,
    gt.g * goal / (SELECT sum(g) FROM gt) AS c, CAST(n AS DOUBLE) AS w
  FROM sums JOIN gs ON gs.source IS NOT DISTINCT FROM sums.source
    JOIN gl ON gl.lang IS NOT DISTINCT FROM sums.lang JOIN gt USING (topic) CROSS JOIN common
  UNION ALL
  SELECT r + 1, source, lang, topic, n, a, b, c, least(n, coalesce(w * c / nullif(sum(w) OVER (PARTITION BY topic), 0), 0))
  FROM (SELECT * REPLACE (least(n, coalesce(w * b / nullif(sum(w) OVER (PARTITION BY lang), 0), 0)) AS w)
        FROM (SELECT * REPLACE (least(n, coalesce(w * a / nullif(sum(w) OVER (PARTITION BY source), 0), 0)) AS w)
              FROM fit WHERE r < 200))
),
looks AS (SELECT * FROM fit WHERE r > 0 AND r % 10 = 0),
worst AS (
  SELECT r, max(miss) AS miss FROM (
    SELECT r, abs(sum(w) / nullif(any_value(a), 0) - 1) AS miss FROM looks GROUP BY r, source
    UNION ALL SELECT r, abs(sum(w) / nullif(any_value(b), 0) - 1) FROM looks GROUP BY r, lang
    UNION ALL SELECT r, abs(sum(w) / nullif(any_value(c), 0) - 1) FROM looks GROUP BY r, topic)
  GROUP BY r
),
ended AS (SELECT min(r) AS r FROM worst WHERE miss <= 1e-4 OR r = 200),
rated AS (
  SELECT doc_id, docs.source, docs.lang, docs.topic, tokens, coalesce(w / n, 1.0) AS p
  FROM docs LEFT JOIN fit ON r = (SELECT r FROM ended) AND docs.source IS NOT DISTINCT FROM fit.source
    AND docs.lang IS NOT DISTINCT FROM fit.lang AND docs.topic = fit.topic
)
SELECT doc_id, source, lang, topic, tokens, round(p, 6) AS probability,
  CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) / 4503599627370496.0 < p AS kept
FROM rated
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(
    list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM scored
QUALIFY rank <= 5
"""

MERKLE = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    -- crc32 of the decimal id: a step for each bit of each character
    xor(4294967295, list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])),
        lambda r, i: xor(r >> 1, 3988292384 * (r & 1))))) % 3 = 0 AS tampered
  FROM documents
),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN tampered THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) END AS changed
  FROM fields
),
langs AS (SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM leaves GROUP BY lang),
placed AS (
  SELECT doc_id, tree, n, leaf, coalesce(changed, leaf) AS replaced,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM leaves JOIN langs ON leaves.lang IS NOT DISTINCT FROM langs.lang
),
up AS (
  SELECT 0 AS level, tree, place, n, leaf AS digest FROM placed
  UNION ALL
  SELECT level + 1, tree, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM up WHERE n > 1 GROUP BY level, tree, place // 8, n
),
crown AS (
  SELECT 0 AS level, tree AS place, count(*) OVER () AS n, digest FROM up WHERE n = 1
  UNION ALL
  SELECT level + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM crown WHERE n > 1 GROUP BY level, place // 8, n
),
folded AS (
  SELECT 0 AS level, doc_id, leaf, tree, place AS own, place, n, replaced AS digest, '' AS proof FROM placed
  UNION ALL
  SELECT f.level + 1, f.doc_id, f.leaf, f.tree, f.own, f.place // 8, (f.n + 7) // 8,
    sha256(string_agg(CASE WHEN u.place = f.place THEN f.digest ELSE u.digest END, '' ORDER BY u.place)),
    f.proof || coalesce(string_agg(u.digest, '' ORDER BY u.place) FILTER (u.place <> f.place), '')
  FROM folded AS f JOIN up AS u ON u.level = f.level AND u.tree = f.tree AND u.place // 8 = f.place // 8
  WHERE f.n > 1
  GROUP BY f.level, f.doc_id, f.leaf, f.tree, f.own, f.place, f.n, f.digest, f.proof
),
crowned AS (
  SELECT 0 AS level, f.doc_id, f.leaf, f.tree, f.own, f.tree AS place, c.n, f.digest, f.proof
  FROM folded AS f JOIN crown AS c ON c.level = 0 AND c.place = f.tree WHERE f.n = 1
  UNION ALL
  SELECT f.level + 1, f.doc_id, f.leaf, f.tree, f.own, f.place // 8, (f.n + 7) // 8,
    sha256(string_agg(CASE WHEN u.place = f.place THEN f.digest ELSE u.digest END, '' ORDER BY u.place)),
    f.proof || coalesce(string_agg(u.digest, '' ORDER BY u.place) FILTER (u.place <> f.place), '')
  FROM crowned AS f JOIN crown AS u ON u.level = f.level AND u.place // 8 = f.place // 8
  WHERE f.n > 1
  GROUP BY f.level, f.doc_id, f.leaf, f.tree, f.own, f.place, f.n, f.digest, f.proof
)
SELECT f.doc_id, f.leaf, s.digest AS subroot, r.digest AS root, sha256(f.proof) AS proof_sha256,
  f.digest AS folded_root, f.digest = r.digest AS verified
FROM crowned AS f JOIN crown AS s ON s.level = 0 AND s.place = f.tree CROSS JOIN (SELECT digest FROM crown WHERE n = 1) AS r
WHERE f.n = 1
"""


def _codes(rounds: int = 6) -> str:
    """Each round is a pair of tables: the assigned parts and the codebooks that follow from them."""
    assigned = """
a{r} AS MATERIALIZED (
  SELECT vec_id, copy, p, part, arg_min(e, far * 16 + e) AS e, min(far) AS far
  FROM (SELECT parts.*, e, coalesce(CAST(list_sum(list_transform(list_zip(part, entry),
          lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), 0) AS far
        FROM parts JOIN c{r} USING (p))
  GROUP BY ALL
)"""
    better = """
c{next} AS MATERIALIZED (
  SELECT p, e, coalesce(mean, entry) AS entry
  FROM c{r} LEFT JOIN (
    SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS mean
    FROM (SELECT p, e, i, sum(part[i]) AS s, count(*) AS n
          FROM (SELECT p, e, part, unnest(range(1, len(part) + 1)) AS i FROM a{r}) GROUP BY p, e, i)
    GROUP BY p, e) USING (p, e)
)"""
    steps = [(assigned + "," + better).format(r=r, next=r + 1) for r in range(rounds)]
    return f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS copy, v
  FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
),
parts AS MATERIALIZED (
  SELECT vec_id, copy, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS part
  FROM (SELECT *, unnest(range(8)) AS p FROM kept)
),
c0 AS MATERIALIZED (SELECT p, copy - 1 AS e, part AS entry FROM parts WHERE copy <= 16),
{",".join(steps)},
{assigned.format(r=rounds)},
coded AS (
  SELECT copy, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error
  FROM a{rounds} GROUP BY copy
),
books AS (
  SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (copy) CROSS JOIN books
"""


NEAR = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 2 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s
  FROM worded
),
nodes AS MATERIALIZED (
  SELECT s, min(doc_id) AS node, len(s) AS n FROM sets WHERE len(s) > 0 AND doc_id IS NOT NULL GROUP BY s
),
shingles AS MATERIALIZED (SELECT node, n, unnest(s) AS shingle FROM nodes),
links AS MATERIALIZED (
  SELECT a.node AS a, b.node AS b
  FROM shingles AS a JOIN shingles AS b ON a.shingle = b.shingle AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT a AS node, b AS other FROM both_ways
  UNION
  SELECT r.node, l.b FROM reached AS r JOIN both_ways AS l ON r.other = l.a
),
smallest AS (SELECT node, min(other) AS other FROM reached GROUP BY node)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles,
  CASE WHEN sets.doc_id IS NOT NULL THEN least(coalesce(nodes.node, sets.doc_id), coalesce(smallest.other, sets.doc_id)) END
    AS component_id,
  sets.doc_id IS NOT DISTINCT FROM component_id AS kept
FROM sets LEFT JOIN nodes ON sets.s = nodes.s LEFT JOIN smallest ON smallest.node = nodes.node
"""

ORACLE = {
    "op1_mix_sources": MIX,
    "op7_exact_topk": TOP_K,
    "op11_manifest": MERKLE,
    "op12_codes": _codes(),
    "op13_minhash": NEAR,
}
