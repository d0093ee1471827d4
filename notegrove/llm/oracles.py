"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

_KEY = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]"""
_PATTERNS = (
    ("assign", 0, "(" + _KEY + r"""\x20*["'']?([A-Za-z0-9+/_.=-]+))""", "length(value) >= 6"),
    ("access", 1, r"((AKIA[A-Z0-9]+))", "length(value) >= 20"),
    ("hex", 2, r"(([0-9a-f]+))", "length(value) >= 24"),
    ("token", 3, r"(([A-Za-z0-9_-]+))", "length(value) >= 24 AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9]')"),
)


def _found(kind: str, rank: int, pattern: str, keep: str) -> str:
    pairs = rf"'(?s)(.*?)(?:{pattern}|\z)'"
    return f"""
    SELECT rid, source, lang, '{kind}' AS kind, {rank} AS rank, stop - length(span) AS start, stop, value FROM (
      SELECT rid, source, lang, span, value, sum(length(gap) + length(span)) OVER (PARTITION BY rid ORDER BY i) AS stop FROM (
        SELECT rid, source, lang, unnest(gaps) AS gap, unnest(spans) AS span, unnest("values") AS value, unnest(range(len(gaps))) AS i FROM (
          SELECT rid, source, lang, regexp_extract_all(text, {pairs}, 1) AS gaps, regexp_extract_all(text, {pairs}, 2) AS spans,
            regexp_extract_all(text, {pairs}, 3) AS "values" FROM docs)))
    WHERE span <> '' AND {keep}"""


SECRETS = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, source, lang FROM documents),
found AS ({" UNION ALL ".join(_found(*p) for p in _PATTERNS)}),
clear AS (
  SELECT * FROM found f WHERE kind <> 'token' OR NOT EXISTS (
    SELECT 1 FROM found b WHERE b.rid = f.rid AND b.kind <> 'token' AND b.start < f.stop AND f.start < b.stop)),
owners AS (
  SELECT value, count(DISTINCT coalesce(source, '')) AS owners,
    len(list_distinct(string_split(value, ''))) >= 8 AND NOT regexp_matches(value, '(?i)example|sample|changeme|placeholder|dummy|xxxx|your[_-]?') AS random
  FROM clear GROUP BY value),
judged AS (SELECT c.*, CASE WHEN owners >= 3 THEN 'example' WHEN random THEN 'live' ELSE 'weak' END AS class FROM clear c JOIN owners USING (value)),
per_row AS (
  SELECT rid,
    count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (kind <> 'token') AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (kind <> 'token' OR class = 'live') AS spans,
    count(*) FILTER (class = 'live') AS n_live, count(*) FILTER (class = 'example') AS n_copied
  FROM judged GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM docs LEFT JOIN per_row USING (rid)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
last AS (SELECT html, max(page_id) AS last FROM p WHERE n >= 1000 GROUP BY html)
SELECT page_id, n AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN last IS NULL OR page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN last IS NULL OR page_id IS NOT DISTINCT FROM last THEN NULL ELSE last END AS refers_to
FROM p LEFT JOIN last USING (html)
"""

_RESTS = "|".join(
    r.replace("|", r"\|").replace("[", r"\[").replace("]", r"\]")
    for r in (
        "|start_header_id|>", "|end_header_id|>", "|begin_of_text|>", "|startoftext|>", "start_of_turn>", "|endoftext|>", "|assistant|>", "end_of_turn>",
        "|im_start|>", "|system|>", "|im_end|>", "|eot_id|>", "|user|>", "</SYS>>", "/INST]", "<SYS>>", "INST]", "/s>", "s>",
    )
)
CHAT = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (SELECT *, length(regexp_replace(text, '([<\[])(\\*)({_RESTS})', '\1\\\2\3', 'g')) + length(role) + 24 AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE role WHEN 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(n)::BIGINT AS formatted_chars
FROM g GROUP BY conv_id
"""
