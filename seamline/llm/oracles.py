"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# Fixed values: (kind, pattern, group of the value, least length)
_KINDS = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
    ("generic", r"[A-Za-z0-9+/_-]{20,}", 0, 20),
]


def _kind_sql(k: int) -> str:
    kind, pattern, group, least = _KINDS[k]
    rx = "'" + pattern.replace("'", "''") + "'"
    return (
        f"SELECT uid, doc_id, source, {k} AS kind, f.a AS a, f.b AS b, f.v AS v FROM ("
        f" SELECT uid, doc_id, source, unnest(list_transform(range(len(m)), lambda i: {{"
        f"'a': list_sum(list_transform(g[1:i + 1], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i], lambda x: length(x))), 0),"
        f"'b': list_sum(list_transform(g[1:i + 1], lambda x: length(x))) + list_sum(list_transform(m[1:i + 1], lambda x: length(x))),"
        f"'v': v[i + 1]}})) AS f FROM (SELECT uid, doc_id, source, regexp_extract_all(t, {rx}, 0) AS m,"
        f" regexp_extract_all(t, {rx}, {group}) AS v, string_split_regex(t, {rx}) AS g FROM d)) WHERE length(f.v) >= {least}")


def _joined(test: str) -> str:
    names = "list_value(" + ", ".join(f"'{k[0]}'" for k in _KINDS) + ")"
    return (f"coalesce(string_agg({names}[kind + 1] || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' "
            f"ORDER BY a, kind) FILTER (WHERE {test}), '')")


SECRET_SCAN = f"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS t, source FROM documents),
every_span AS ({' UNION ALL '.join(_kind_sql(k) for k in range(4))}),
placed AS (SELECT *, len(list_distinct(string_split(v, ''))) >= 8 AND regexp_matches(v, '[0-9]') AS random,
           coalesce(max(CASE WHEN kind < 3 THEN b END) OVER (PARTITION BY uid ORDER BY a, kind ROWS UNBOUNDED PRECEDING), 0) AS covered
           FROM every_span),
spans AS (SELECT * FROM placed WHERE kind < 3 OR (covered < b AND random)),
uses AS (SELECT v, count(DISTINCT source) + count(DISTINCT uid) FILTER (WHERE source IS NULL) AS owners,
         count(DISTINCT uid) AS repos FROM spans GROUP BY v),
shown AS (SELECT s.*, repos, CASE WHEN owners >= 3 OR repos >= 10 THEN 'example' WHEN owners = 1 AND random THEN 'live' ELSE 'unclear' END AS use
          FROM spans s JOIN uses u ON u.v = s.v),
per_doc AS (SELECT uid, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
            count(*) FILTER (WHERE kind = 2) AS n_hex, {_joined('kind < 3')} AS base, {_joined('TRUE')} AS spans,
            count(*) FILTER (WHERE use = 'live') AS n_live, count(*) FILTER (WHERE use = 'example') AS n_example,
            string_agg(CAST(repos AS VARCHAR), ',' ORDER BY a, kind) AS n_repos
            FROM shown WHERE kind < 3 OR use = 'live' GROUP BY uid)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(p.spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example, coalesce(n_repos, '') AS n_repos
FROM d LEFT JOIN per_doc p ON p.uid = d.uid
"""

PERSPECTIVES = """
WITH r AS (
  SELECT conv_id, turn, CASE WHEN trim(role) IS NULL OR trim(role) = '' THEN 'unknown' ELSE trim(role) END AS speaker,
         replace(coalesce(text, ''), '<|im_', '<| im_') AS content FROM conversations),
people AS (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM r WHERE speaker <> 'system'),
seen AS (
  SELECT conv_id, perspective, turn, speaker, content,
         CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role
  FROM r JOIN people ON r.conv_id IS NOT DISTINCT FROM people.c),
made AS (
  SELECT *, CASE WHEN role = 'user' THEN speaker END AS name,
         '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || speaker ELSE '' END || chr(10) || content || '<|im_end|>' || chr(10) AS segment
  FROM seen),
placed AS (
  SELECT *, row_number() OVER w AS position, CAST(coalesce(sum(length(segment)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM made WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, sha256(content)))
SELECT conv_id, perspective, position, turn, role, name, segment, start,
       CASE WHEN role = 'assistant' THEN start + length(segment) - 11 - length(content) END AS mask_start,
       CASE WHEN role = 'assistant' THEN start + length(segment) - 1 END AS mask_end
FROM placed
"""

SQL: dict[str, str] = {
    "op3_perspectives": PERSPECTIVES,
    "op1_secret_scan": SECRET_SCAN,
    "op10_exact_dedup": EXACT_DEDUP,
}
