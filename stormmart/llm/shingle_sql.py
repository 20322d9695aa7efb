"""DuckDB SQL for components of texts that share word shingles."""

from __future__ import annotations


def components_sql(k: int, percent: int, more: str = "") -> str:
    """SQL for components of texts by k-word shingles, on small tables."""
    return rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))) END AS s
  FROM docs),
shingles AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS u, b.doc_id AS v FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM sets
  UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.v) AS component_id{more}
FROM sets s JOIN reach r ON s.doc_id = r.u GROUP BY s.doc_id, s.s
"""
