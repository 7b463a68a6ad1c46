"""DuckDB oracle for the metric and exploratory keys (AUC by the pairwise
rank-sum definition, ROC by cumulative window sums)."""
from __future__ import annotations

from ..sources.fixture_sql import with_views
from .sqlkit import rounded

SCORED = """scored AS (SELECT event_id, round(value) AS score,
  CAST(event_type = 'purchase' AS INTEGER) AS label,
  CASE WHEN value / CAST(400 AS DOUBLE) > 0.5 THEN 1 ELSE 0 END AS pred FROM events)"""

CELLS = """cells AS (SELECT
  sum(CASE WHEN label = 0 AND pred = 0 THEN 1 ELSE 0 END) AS tn,
  sum(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn,
  sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS tp FROM scored)"""


def oracles() -> dict[str, str]:
    def ratio(a, b):
        return f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0.0)"
    p1, r1 = ratio("tp", "tp + fp"), ratio("tp", "tp + fn")
    p0, r0 = ratio("tn", "tn + fn"), ratio("tn", "tn + fp")
    report = f"""WITH {SCORED}, {CELLS},
m AS (SELECT {p0} AS p0, {r0} AS r0, {p1} AS p1, {r1} AS r1, tn + fp AS s0, tp + fn AS s1,
  tn + fp + tp + fn AS tot, {ratio('tp + tn', 'tn + fp + tp + fn')} AS acc FROM cells),
f AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0.0) AS f0,
  coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0.0) AS f1,
  coalesce(CAST(s0 AS DOUBLE) / nullif(tot, 0), 0.0) AS w0,
  coalesce(CAST(s1 AS DOUBLE) / nullif(tot, 0), 0.0) AS w1 FROM m)
SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM f
UNION ALL SELECT '1', p1, r1, f1, s1 FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, acc, tot FROM f
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, tot FROM f
UNION ALL SELECT 'weighted avg', p0 * w0 + p1 * w1, r0 * w0 + r1 * w1, f0 * w0 + f1 * w1, tot FROM f"""
    los_order = ("0", "1", "2", "3", "4", "5", "6", "7", "8-14", ">14")
    order_vals = ", ".join(f"('{v}')" for v in los_order)
    return {
        "auc": rounded(f"""WITH {SCORED},
pos AS (SELECT score FROM scored WHERE label = 1), neg AS (SELECT score FROM scored WHERE label = 0),
g AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM scored GROUP BY score),
c AS (SELECT score, p, n, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT sum(p * (below + n / 2.0)) / nullif(sum(p) * sum(n), 0) AS auc FROM c""", ["auc"]),
        "roc_points": rounded(f"""WITH {SCORED},
g AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM scored GROUP BY score),
t AS (SELECT sum(p) AS pp, sum(n) AS nn FROM g)
SELECT score AS threshold,
  CAST(sum(n) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / t.nn AS fpr,
  CAST(sum(p) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / t.pp AS tpr
FROM g, t""", ["threshold", "fpr", "tpr"]),
        "confusion_matrix": f"""WITH {SCORED}, {CELLS}
SELECT 0 AS label, 0 AS pred, tn AS n FROM cells UNION ALL SELECT 0, 1, fp FROM cells
UNION ALL SELECT 1, 0, fn FROM cells UNION ALL SELECT 1, 1, tp FROM cells""",
        "classification_report": rounded(report, ["precision", "recall", "f1"]),
        "eda_value_share": rounded(with_views("""SELECT sex, status, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY sex) AS percentage FROM (
  SELECT CASE WHEN gender = 'F' THEN 'Female' WHEN gender = 'M' THEN 'Male' END AS sex,
    CASE WHEN expire_flag = 1 THEN 'Deceased' WHEN expire_flag = 0 THEN 'Alive' END AS status,
    count(*) AS n FROM patients GROUP BY 1, 2) x WHERE sex IS NOT NULL AND status IS NOT NULL""",
                                              ("patients",)), ["percentage"]),
        "eda_los_bins": f"""WITH los AS (
  SELECT date_diff('second', o.o_orderdate, l.l_shipdate) / CAST(86400 AS DOUBLE) AS los
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
d AS (SELECT CAST(round_even(los, 0) AS INTEGER) AS d FROM los WHERE los IS NOT NULL),
lab AS (SELECT CASE WHEN d < 14 AND d > 8 THEN '8-14' WHEN d >= 14 THEN '>14' ELSE CAST(d AS VARCHAR) END AS days FROM d),
ord(days) AS (VALUES {order_vals})
SELECT ord.days, count(lab.days) AS n FROM ord LEFT JOIN lab ON ord.days = lab.days GROUP BY ord.days""",
        "eda_distinct_subjects": """SELECT 'patients' AS source, count(DISTINCT c_custkey) AS n_subjects FROM customer
UNION ALL SELECT 'prescriptions', count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'diagnoses', count(DISTINCT user_id) FROM events""",
    }
