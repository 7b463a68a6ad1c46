"""DuckDB SQL for the queries of this package that SQL can express."""
from __future__ import annotations

CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, regexp_replace(text, '([\[<])(\\*)(/?INST\]|NEXT\]|/s>)', '\1\\\2\3', 'g') AS safe,
    coalesce(lag(role) OVER w = role, false) AS goes_on, coalesce(lead(role) OVER w = role, false) AS stays
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(safe) + CASE WHEN goes_on THEN 6 ELSE 13 + length(role) END
      + CASE WHEN stays THEN 0 ELSE 4 END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

URLS = r"""
WITH rules(host, path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
SELECT page_id, p.host, p.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
  coalesce(arg_max(r.verdict, length(r.host || r.path)), 'allow') AS verdict
FROM parts p LEFT JOIN rules r
  ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
GROUP BY page_id, p.host, p.path
"""


def oracles() -> dict[str, str]:
    return {"op3_chat_formatting": CHAT, "op5_url_filters": URLS}
