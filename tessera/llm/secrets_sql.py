"""Operator 2 in DuckDB's SQL. Positions are sums of the lengths of matches and of the gaps between them; case is spelled out, as its (?i) folds beyond ASCII."""

from __future__ import annotations

from tessera.llm.secrets import KINDS, OWNERS, SEARCHED


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEY = "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_PATTERNS = {"assign": f"({_KEY})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", **SEARCHED, "opaque": "[A-Za-z0-9_-]{32,}"}
_RULES = [(k, name, _PATTERNS[name], group, least) for k, (name, _, group, least) in enumerate([*KINDS, ("opaque", "", 0, 32)])]
_RAW = " UNION ALL ".join(f"SELECT doc_id, owner, {k} AS kind, '{name}' AS name, {least} AS least, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}', 0) AS hits, regexp_extract_all(t, '{p}', {g}) AS vals FROM d" for k, name, p, g, least in _RULES)

SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents),
raw AS ({_RAW}),
each_ AS (SELECT *, unnest(range(1, len(hits) + 1)) AS k FROM raw),
found AS (
  SELECT doc_id, owner, kind, name, vals[k] AS v,
         CAST(list_sum(list_transform(gaps[1:k], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:k - 1], lambda h: length(h))), 0) AS BIGINT) AS start, length(hits[k]) AS n
  FROM each_ WHERE length(vals[k]) >= least
    AND (kind < 3 OR (regexp_matches(vals[k], '[0-9]') AND regexp_matches(vals[k], '[a-z]') AND regexp_matches(vals[k], '[A-Z]')))),
held AS (SELECT sha256(v) AS hash, count(DISTINCT owner) AS owners FROM found GROUP BY 1),
judged AS (SELECT f.*, h.owners <= {OWNERS} AS live, name || ':' || start || ':' || (start + n) AS span FROM found f JOIN held h ON sha256(f.v) = h.hash),
sums AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
         string_agg(span, ',' ORDER BY start, kind) FILTER (WHERE kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind) FILTER (WHERE kind < 3 OR live) AS spans,
         count(*) FILTER (WHERE live) AS live, count(*) FILTER (WHERE NOT live) AS examples
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(live, 0) AS live, coalesce(examples, 0) AS examples
FROM d LEFT JOIN sums USING (doc_id)
"""
