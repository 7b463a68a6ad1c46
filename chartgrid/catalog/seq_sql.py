"""DuckDB oracle for the data-quality, sampling and sequence keys."""
from __future__ import annotations

from .sqlkit import rounded

F6 = ("avg_value", "min_value", "max_value", "sum_value", "n_events", "n_types")

SERIES = """
ev AS (SELECT user_id, event_type, value,
  date_diff('day', min(ts) OVER (PARTITION BY user_id), ts) AS day
  FROM events WHERE event_type IN ('click', 'purchase')),
users AS (SELECT user_id, max(day) AS last, max((day >= 25 AND event_type = 'purchase' AND value > 100)::INT) AS label
  FROM ev GROUP BY user_id),
grid AS (SELECT user_id, unnest(range(least(last, 24) + 1)) AS day, label FROM users),
daily AS (SELECT user_id, day, avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value,
  sum(value) AS sum_value, CAST(count(*) AS DOUBLE) AS n_events,
  CAST(count(DISTINCT event_type) AS DOUBLE) AS n_types FROM ev WHERE day < 25 GROUP BY user_id, day),
series AS (SELECT g.user_id, g.day, d.avg_value, d.min_value, d.max_value, d.sum_value, d.n_events,
  d.n_types, g.label FROM grid g LEFT JOIN daily d ON g.user_id = d.user_id AND g.day = d.day),
frac AS (SELECT user_id,
  avg(CASE WHEN avg_value IS NULL OR isnan(avg_value) THEN 1.0 ELSE 0.0 END) AS avg_value,
  avg(CASE WHEN min_value IS NULL OR isnan(min_value) THEN 1.0 ELSE 0.0 END) AS min_value,
  avg(CASE WHEN max_value IS NULL OR isnan(max_value) THEN 1.0 ELSE 0.0 END) AS max_value,
  avg(CASE WHEN sum_value IS NULL OR isnan(sum_value) THEN 1.0 ELSE 0.0 END) AS sum_value,
  avg(CASE WHEN n_events IS NULL OR isnan(n_events) THEN 1.0 ELSE 0.0 END) AS n_events,
  avg(CASE WHEN n_types IS NULL OR isnan(n_types) THEN 1.0 ELSE 0.0 END) AS n_types
  FROM series GROUP BY user_id),
complete AS (SELECT * FROM series WHERE user_id IN (SELECT user_id FROM frac WHERE avg_value < 0.3
  AND min_value < 0.3 AND max_value < 0.3 AND sum_value < 0.3 AND n_events < 0.3 AND n_types < 0.3)),
exact AS (SELECT * FROM complete WHERE user_id IN (
  SELECT user_id FROM complete GROUP BY user_id HAVING count(*) = 25)),
med AS (SELECT median(avg_value) AS m1, median(min_value) AS m2, median(max_value) AS m3,
  median(sum_value) AS m4, median(n_events) AS m5, median(n_types) AS m6 FROM exact),
imputed AS (SELECT e.user_id, e.day, coalesce(e.avg_value, m.m1) AS avg_value,
  coalesce(e.min_value, m.m2) AS min_value, coalesce(e.max_value, m.m3) AS max_value,
  coalesce(e.sum_value, m.m4) AS sum_value, coalesce(e.n_events, m.m5) AS n_events,
  coalesce(e.n_types, m.m6) AS n_types, e.label FROM exact e, med m),
split AS (SELECT *, CASE WHEN CAST('0x' || left(md5('0:' || user_id), 8) AS BIGINT) % 1000 < 800
  THEN 'train' ELSE 'test' END AS split FROM imputed),
over AS (
  SELECT user_id, day, avg_value, min_value, max_value, sum_value, n_events, n_types, label, 0 AS copy
  FROM split WHERE split = 'train'
  UNION ALL
  SELECT user_id, day, avg_value, min_value, max_value, sum_value, n_events, n_types, label, k
  FROM split, (SELECT unnest(generate_series(1, 6)) AS k) c WHERE split = 'train' AND label = 1),
allseq AS (
  SELECT *, 'train' AS split FROM over
  UNION ALL BY NAME SELECT *, 0 AS copy FROM split WHERE split = 'test'),
numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id, copy ORDER BY day) - 1 AS pos FROM allseq),
win AS (
  SELECT s.user_id, s.day AS start, CAST(k.step AS BIGINT) AS step, y.label AS label, r.avg_value, r.min_value,
    r.max_value, r.sum_value, r.n_events, r.n_types, s.split, s.copy
  FROM numbered s
  JOIN numbered y ON y.user_id = s.user_id AND y.copy = s.copy AND y.pos = s.pos + 24
  CROSS JOIN (SELECT unnest(generate_series(0, 23)) AS step) k
  JOIN numbered r ON r.user_id = s.user_id AND r.copy = s.copy AND r.pos = s.pos + k.step)"""


def _q(select: str, doubles=()) -> str:
    return rounded("WITH " + SERIES.strip() + "\n" + select, doubles)


def oracles() -> dict[str, str]:
    nulls = ", ".join(f"count(CASE WHEN {c} IS NULL OR isnan({c}) THEN 1 END) AS {c}" for c in F6)
    return {
        "null_profile": _q(f"""SELECT count(*) AS n_rows, count(CASE WHEN user_id IS NULL THEN 1 END) AS user_id,
  count(CASE WHEN day IS NULL THEN 1 END) AS day, {nulls},
  count(CASE WHEN label IS NULL THEN 1 END) AS label FROM series"""),
        "missing_fraction": _q("SELECT * FROM frac", F6),
        "complete_entities": _q("SELECT * FROM complete", F6),
        "exact_length_entities": _q("SELECT * FROM exact", F6),
        "median_impute": _q("SELECT * FROM imputed", F6),
        "entity_split": _q("SELECT DISTINCT user_id, split FROM split"),
        "hash_split": """SELECT doc_id, quality, toxic, CASE WHEN CAST('0x' || left(md5('1:' || doc_id), 8) AS BIGINT) % 1000 < 800
  THEN 'train' ELSE 'test' END AS split FROM labels""",
        "stratified_folds": """SELECT doc_id, toxic, CAST((row_number() OVER (ORDER BY toxic NULLS FIRST,
  CAST('0x' || left(md5('0:' || doc_id), 8) AS BIGINT), doc_id) - 1) % 5 AS INTEGER) AS fold FROM labels""",
        "oversample": _q("SELECT * FROM over", F6),
        "sequence_windows": _q("SELECT * FROM win", F6),
        # labels of blocks are doubles
        "window_blocks": _q("SELECT * REPLACE (CAST(label AS DOUBLE) AS label) FROM win", F6),
    }
