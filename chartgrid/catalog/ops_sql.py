"""DuckDB oracle for the single-operator keys: plain SQL, with joins to small rule
tables where the operator maps codes or checks limits."""
from __future__ import annotations

from ..sources.fixture_sql import with_views
from . import oracle_values as V
from .clinical_sql import FIO2, LABS, VITALS
from .sqlkit import in_list, rounded

#: The rule tables alone, without the steps of the clinical chain that use them.
LAB_LIMIT = LABS[:LABS.index(",\nlab AS")]
VITAL_RULE = VITALS[:VITALS.index(",\nvitals AS")]
COMA_RULE = """coma_rule(itemid, part, answer, stands_for) AS (VALUES
  (723, 723, '1.0 ET/Trach', 0), (223900, 723, 'No Response-ETT', 0), (454, 454, NULL, NULL),
  (223901, 454, NULL, NULL), (184, 184, NULL, NULL), (220739, 184, NULL, NULL))"""


SHIP = """FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

CARRY = """
SELECT event_id, user_id, ts, value, if(recent, before.value, NULL) AS prev_value,
  if(recent, before.event_type, NULL) AS prev_event_type
FROM (SELECT *, lag(events) OVER w AS before, ts - lag(ts) OVER w < INTERVAL 6 HOUR AS recent
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)) AS e"""


def _asof(hours: int, right_filter: str) -> str:
    return f"""
SELECT p.event_id, p.user_id, p.ts, if(near, c.value, NULL) AS click_value, if(near, c.ts, NULL) AS click_ts
FROM (FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT user_id, ts, value, true AS found FROM events WHERE event_type = 'click' {right_filter}) c
  ON p.user_id = c.user_id AND p.ts >= c.ts,
LATERAL (SELECT found AND p.ts - c.ts <= INTERVAL {hours} HOUR AS near)"""


def oracles() -> dict[str, str]:
    return {
        "scan_project": rounded("""SELECT l_orderkey AS order_id, l_linenumber AS line, l_quantity AS qty,
  l_extendedprice * (1 - l_discount) AS revenue, l_returnflag AS returnflag FROM lineitem""",
                                ["qty", "revenue"]),
        "io_roundtrip": rounded("SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders",
                                ["o_totalprice"]),
        "csv_roundtrip": with_views("SELECT hadm_id, ethnicity, admission_type, hospital_expire_flag FROM admissions",
                                    ("admissions",)),
        "csv_inferred": with_views("""SELECT hadm_id::INT AS hadm_id, admittime, admission_type,
  hospital_expire_flag::INT AS hospital_expire_flag, 'int' AS hadm_id_type, 'timestamp' AS admittime_type,
  'string' AS admission_type_type, 'int' AS hospital_expire_flag_type FROM admissions""", ("admissions",)),
        "filter_in_list": rounded(with_views(
            f"SELECT icustay_id, charttime, itemid, valuenum FROM chartevents WHERE itemid IN {in_list(sorted({c for r in V.VITAL_RULES for c in r[1]}))}",
            ("chartevents",)), ["valuenum"]),
        "filter_range": rounded("""SELECT l_orderkey, l_linenumber, l_discount, l_quantity FROM lineitem
WHERE l_discount > 0.02 AND l_discount <= 0.06 AND l_quantity BETWEEN 10 AND 20""",
                                ["l_discount", "l_quantity"]),
        "filter_three_valued": with_views(
            "SELECT icustay_id, charttime, itemid, error FROM chartevents WHERE error != 1", ("chartevents",)),
        "flag_columns": """SELECT o_orderkey,
  CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS high_value,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS urgent,
  CASE WHEN o_orderstatus = 'F' OR o_totalprice < 1000 THEN 1 ELSE 0 END AS closed_or_small
FROM orders""",
        "fio2_normalise": rounded(with_views(FIO2 + "\nSELECT * FROM fio2c", ("chartevents",)), ["fio2_chartevents"]),
        "like_filter": with_views("""SELECT hadm_id, diagnosis FROM admissions
WHERE lower(diagnosis) LIKE '%organ donor%' OR lower(diagnosis) LIKE '%donor account%'""", ("admissions",)),
        "code_to_concept": rounded(with_views(COMA_RULE + """
SELECT icustay_id, charttime, part AS itemid, if(value = answer, stands_for, valuenum) AS valuenum
FROM chartevents JOIN coma_rule USING (itemid) WHERE error <> 1""", ("chartevents",)), ["valuenum"]),
        "plausibility_clip": rounded(with_views(LAB_LIMIT + """
SELECT hadm_id, charttime, itemid, feature AS label,
  if(valuenum > most OR valuenum < least, NULL, valuenum) AS valuenum
FROM labevents JOIN lab_limit USING (itemid) WHERE valuenum > 0""", ("labevents",)), ["valuenum"]),
        "unit_convert": rounded(with_views(VITAL_RULE + """
SELECT icustay_id, charttime, itemid, if(valuenum > above AND valuenum < below, (valuenum - shift) / scale, NULL) AS tempc
FROM chartevents JOIN vital_rule USING (itemid) WHERE feature = 'tempc'""", ("chartevents",)), ["tempc"]),
        "interval_join": with_views("""SELECT c.icustay_id, c.charttime, c.itemid
FROM chartevents c JOIN icustays i ON c.icustay_id = i.icustay_id
 AND c.charttime > i.intime - INTERVAL 12 HOUR AND c.charttime < i.outtime - INTERVAL 12 HOUR
WHERE c.itemid IN (211, 220045)""", ("icustays", "chartevents")),
        "semi_join": "SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey IN (SELECT user_id FROM events)",
        "id_intersect": """SELECT c_custkey AS id FROM customer
INTERSECT SELECT o_custkey FROM orders INTERSECT SELECT user_id FROM events""",
        "stay_ordinal": """SELECT o_orderkey, o_custkey,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey) AS ordinal
FROM orders""",
        "hour_diff": f"SELECT l.l_orderkey, l.l_linenumber, date_diff('hour', o.o_orderdate, l.l_shipdate) AS hours {SHIP}",
        "time_scalars": f"""SELECT l.l_orderkey, l.l_linenumber,
  date_trunc('hour', l.l_shipdate) AS ship_hour,
  date_trunc('hour', l.l_shipdate + INTERVAL 59 MINUTE) AS ship_hour_up,
  o.o_orderdate + INTERVAL 2 HOUR AS order_plus_2h,
  o.o_orderdate - INTERVAL 12 HOUR AS order_minus_12h,
  date_diff('day', o.o_orderdate, l.l_shipdate) AS days,
  date_diff('second', o.o_orderdate, l.l_shipdate) AS seconds {SHIP}""",
        "math_scalars": rounded("""SELECT l_orderkey, l_linenumber,
  round(l_extendedprice / l_quantity, 4) AS unit_price,
  l_discount * CAST(100 AS DOUBLE) / CAST(60 AS DOUBLE) / CAST(24 AS DOUBLE) AS ratio,
  round(l_extendedprice / CAST(365.242 AS DOUBLE), 4) AS per_day,
  exp(-l_discount) AS decay FROM lineitem""", ["unit_price", "ratio", "per_day", "decay"]),
        "asof_lookback": rounded(_asof(24, ""), ["click_value"]),
        "asof_lookback_filtered": rounded(_asof(4, "AND value > 100"), ["click_value"]),
        "carry_previous": rounded(CARRY, ["value", "prev_value"]),
        "best_per_group": rounded("""SELECT user_id, day, event_id, event_type, value, ts FROM (
  SELECT *, CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
    ORDER BY value DESC NULLS LAST, event_type ASC NULLS FIRST, ts DESC NULLS LAST) AS r FROM events) x
WHERE r = 1""", ["value"]),
        "last_in_hour": rounded("""SELECT user_id, hour, event_id, value FROM (
  SELECT *, date_trunc('hour', ts) AS hour,
    row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC) AS r FROM events) x
WHERE r = 1""", ["value"]),
        "having_count": rounded("""SELECT user_id, CAST(ts AS DATE) AS day,
  avg(CASE WHEN event_type = 'click' THEN value END) AS click_value,
  avg(CASE WHEN event_type = 'view' THEN value END) AS view_value,
  avg(CASE WHEN event_type = 'purchase' THEN value END) AS purchase_value,
  avg(CASE WHEN event_type = 'signup' THEN value END) AS signup_value,
  avg(CASE WHEN event_type = 'error' THEN value END) AS error_value
FROM events GROUP BY user_id, CAST(ts AS DATE)
HAVING count(CASE WHEN event_type = 'purchase' THEN value END) < 2""",
                                ["click_value", "view_value", "purchase_value", "signup_value", "error_value"]),
        "order_proof": """SELECT 'order_output' AS result, count(*) AS n_rows, true AS in_order FROM orders
UNION ALL SELECT 'topk', least(count(*), 20), true FROM part""",
        "order_output": "SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey",
        "head_n": rounded("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10",
                          ["o_totalprice"]),
        "topk": rounded("""SELECT * FROM (SELECT p_partkey, p_retailprice FROM part
ORDER BY p_retailprice DESC, p_partkey ASC LIMIT 20) t ORDER BY p_retailprice, p_partkey DESC""",
                        ["p_retailprice"]),
    }
