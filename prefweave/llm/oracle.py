"""DuckDB SQL of the queries that plain SQL can express.

Written apart from the operators: every part is compared with every entry, and
floors are written out on integers; shingles are strings, not hashes; places of
findings are sums of lengths of what stands between them.
"""

from __future__ import annotations


def _codes_sql(scale: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    def nearest(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (
  SELECT rid, p, CAST(min(d * {entries} + e) % {entries} AS BIGINT) AS e, CAST(min(d * {entries} + e) // {entries} AS BIGINT) AS d
  FROM (SELECT v.rid, v.p, b.e, sum((v.c - b.c) * (v.c - b.c)) AS d
        FROM v JOIN b{k} b ON v.p = b.p AND v.j = b.j GROUP BY v.rid, v.p, b.e) GROUP BY rid, p)"""

    def moved(k: int) -> str:
        return f"""s{k} AS (SELECT a.p, a.e, v.j, CAST(sum(v.c) AS BIGINT) AS s, count(*) AS n
  FROM a{k - 1} a JOIN v ON v.rid = a.rid AND v.p = a.p GROUP BY a.p, a.e, v.j),
b{k} AS MATERIALIZED (SELECT b.p, b.e, b.j, CASE WHEN s.n IS NULL THEN b.c ELSE (s.s - ((s.s % s.n) + s.n) % s.n) // s.n END AS c
  FROM b{k - 1} b LEFT JOIN s{k} s ON s.p = b.p AND s.e = b.e AND s.j = b.j)"""

    steps = ",\n".join(f"{nearest(k - 1)},\n{moved(k)}" for k in range(1, rounds + 1))
    return f"""WITH kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS rid,
         list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % {parts} = 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
v AS MATERIALIZED (SELECT rid, (i - 1) // (n // {parts}) AS p, (i - 1) % (n // {parts}) AS j, x[i] AS c
  FROM (SELECT rid, x, len(x) AS n, unnest(range(1, len(x) + 1)) AS i FROM kept)),
b0 AS MATERIALIZED (SELECT p, rid - 1 AS e, j, c FROM v WHERE rid <= {entries}),
{steps},
{nearest(rounds)},
sha AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM b{rounds}),
coded AS (SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY rid),
labelled AS (SELECT k.vec_id, k.label, c.code, c.error FROM kept k JOIN coded c ON c.rid = k.rid),
per_label AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM labelled GROUP BY label)
SELECT l.vec_id, l.code, l.error, t.label_error, sha.codebooks_sha256
FROM labelled l JOIN per_label t ON l.label IS NOT DISTINCT FROM t.label, sha"""



def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _secrets_sql() -> str:
    names = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
    # Kind, pattern, the group whose length counts, least length.
    rules = (("assign", f"""({names})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
             ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16))

    def spans(k: int, kind: str, pattern: str, group: int, least: int) -> str:
        return f"""SELECT rid, {k} AS k, '{kind}' AS kind, m[i] AS found,
         CAST(coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0)
              + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a
  FROM (SELECT rid, m, p, unnest(range(1, len(m) + 1)) AS i
        FROM (SELECT rid, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS p FROM texts))
  WHERE length(regexp_extract(m[i], '{pattern}', {group})) >= {least}"""

    kinds = "\n  UNION ALL ".join(spans(k, *rule) for k, rule in enumerate(rules))
    return f"""WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
spans AS MATERIALIZED (
  {kinds}),
listed AS (
  SELECT rid, sum(CAST(k = 0 AS BIGINT)) AS n0, sum(CAST(k = 1 AS BIGINT)) AS n1, sum(CAST(k = 2 AS BIGINT)) AS n2,
         string_agg(kind || ':' || a || ':' || (a + length(found)), ',' ORDER BY a, k) AS s
  FROM spans GROUP BY rid)
SELECT t.doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n2, 0) AS BIGINT) AS n_hex, sha256(coalesce(s, '')) AS base_sha256
FROM texts t LEFT JOIN listed l ON l.rid = t.rid"""


def _jaccard_sql(k: int = 4, percent: int = 85) -> str:
    """Rarest shingles first; sets that share none of their first ones can't link."""
    return rf"""WITH RECURSIVE folded AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k} - 1], ' '))) END AS s
  FROM folded),
distinct_sets AS MATERIALIZED (
  SELECT min(rid) AS c, len(s) AS n, s FROM (SELECT rid, list_sort(s) AS s FROM sets WHERE len(s) > 0) GROUP BY s),
members AS MATERIALIZED (
  SELECT t.rid, t.doc_id, len(t.s) AS n, d.c FROM sets t LEFT JOIN distinct_sets d ON d.s = list_sort(t.s)),
words AS MATERIALIZED (SELECT c, n, unnest(s) AS g FROM distinct_sets),
rare AS MATERIALIZED (
  SELECT c, n, g, row_number() OVER (PARTITION BY c ORDER BY f, g) AS p
  FROM (SELECT c, n, g, count(*) OVER (PARTITION BY g) AS f FROM words)),
firsts AS MATERIALIZED (SELECT c, n, g FROM rare WHERE p <= n - ({percent} * n + 99) // 100 + 1),
pairs AS MATERIALIZED (
  SELECT DISTINCT a.c AS a, b.c AS b, a.n AS na, b.n AS nb FROM firsts a JOIN firsts b ON a.g = b.g AND a.c < b.c
  WHERE 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)),
links AS MATERIALIZED (
  SELECT p.a, p.b FROM pairs p JOIN words x ON x.c = p.a JOIN words y ON y.c = p.b AND y.g = x.g
  GROUP BY p.a, p.b, p.na, p.nb HAVING 100 * count(*) >= {percent} * (p.na + p.nb - count(*))),
ends AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT c AS a, c AS b FROM distinct_sets UNION SELECT r.a, l.b FROM reach r JOIN ends l ON l.a = r.b),
least_id AS (
  SELECT r.a AS c, min(m.doc_id) AS component_id FROM reach r JOIN members m ON m.c = r.b GROUP BY r.a)
SELECT m.doc_id, CAST(m.n AS BIGINT) AS n_shingles, coalesce(l.component_id, m.doc_id) AS component_id
FROM members m LEFT JOIN least_id l ON l.c = m.c"""


ORACLE_SQL: dict[str, str] = {"secret_base_spans": _secrets_sql(), "op4_ngram_jaccard_join": _jaccard_sql(),
                             "op12_vector_codes": _codes_sql()}
