"""Portable SQL of the six ICU-shaped views (same rows as sources.fixtures).

Used by the DuckDB oracle: ``with_views(sql)`` prepends the views a query needs
as CTEs.  The text also runs in Spark SQL, but the library uses the DataFrame
form in :mod:`chartgrid.sources.fixtures`.
"""

VIEWS = {}

VIEWS["icustays"] = """
SELECT DISTINCT user_id AS subject_id, user_id AS hadm_id,
  user_id*10 + CAST(floor((day(ts)-1)/10) AS BIGINT) AS icustay_id,
  CASE WHEN user_id%2=0 THEN 'carevue' ELSE 'metavision' END AS dbsource,
  TIMESTAMP '2024-01-01 00:20:00' + INTERVAL '1' DAY*(10*CAST(floor((day(ts)-1)/10) AS INT)) + INTERVAL '1' HOUR*CAST(user_id%6 AS INT) AS intime,
  TIMESTAMP '2024-01-11 00:20:00' + INTERVAL '1' DAY*(10*CAST(floor((day(ts)-1)/10) AS INT)) AS outtime,
  CAST(10 AS DOUBLE) - CAST(user_id%6 AS DOUBLE)/CAST(24 AS DOUBLE) AS los
FROM events
"""

VIEWS["admissions"] = """
SELECT c_custkey AS hadm_id,
  TIMESTAMP '2023-12-30 00:00:00' + INTERVAL '1' HOUR*CAST(c_custkey%48 AS INT) AS admittime,
  TIMESTAMP '2024-01-31 12:00:00' AS dischtime,
  CASE WHEN c_custkey%9=0 THEN TIMESTAMP '2024-01-25 06:30:00' END AS deathtime,
  CASE WHEN c_custkey%13=0 THEN NULL ELSE c_mktsegment END AS ethnicity,
  CASE c_custkey%3 WHEN 0 THEN 'EMERGENCY' WHEN 1 THEN 'ELECTIVE' ELSE 'URGENT' END AS admission_type,
  CASE WHEN c_custkey%9=0 THEN 1 ELSE 0 END AS hospital_expire_flag,
  CASE WHEN c_custkey%29=0 THEN 0 ELSE 1 END AS has_chartevents_data,
  CASE WHEN c_custkey%18=0 THEN 'Organ Donor' WHEN c_custkey%25=0 THEN 'DONOR ACCOUNT' ELSE 'SEPSIS' END AS diagnosis
FROM customer
"""

VIEWS["patients"] = """
SELECT c_custkey AS subject_id, CASE WHEN c_custkey%2=0 THEN 'F' ELSE 'M' END AS gender,
  TIMESTAMP '2023-12-31 00:00:00' - INTERVAL '1' DAY*CAST(365*(c_custkey%90) AS INT) AS dob,
  CASE WHEN c_custkey%9=0 THEN TIMESTAMP '2024-01-25 00:00:00' WHEN c_custkey%7=0 THEN TIMESTAMP '2024-06-01 00:00:00' END AS dod,
  CASE WHEN c_custkey%9=0 OR c_custkey%7=0 THEN 1 ELSE 0 END AS expire_flag
FROM customer
"""

VIEWS["chartevents"] = """
SELECT e.user_id*10 + CAST(floor((day(e.ts)-1)/10) AS BIGINT) AS icustay_id, e.user_id AS hadm_id, e.ts AS charttime, i.itemid,
  CASE WHEN i.itemid=723 AND e.event_id%4=0 THEN '1.0 ET/Trach' WHEN i.itemid=223900 AND e.event_id%4=1 THEN 'No Response-ETT' END AS value,
  CASE WHEN (e.event_id+i.itemid)%23=0 THEN NULL ELSE i.lo + (i.hi-i.lo)*CAST((e.event_id*7919+i.itemid*37)%1000 AS DOUBLE)/CAST(1000 AS DOUBLE) END AS valuenum,
  CASE WHEN e.event_id%10=0 THEN 1 WHEN e.event_id%7=0 THEN NULL ELSE 0 END AS error
FROM events e CROSS JOIN (SELECT CAST(a AS INT) AS itemid, CAST(b AS DOUBLE) AS lo, CAST(c AS DOUBLE) AS hi FROM (VALUES
  (211,-10,320),(220045,40,180),(51,-5,420),(220179,60,200),(8368,20,310),(220180,30,120),(456,10,320),(220052,40,130),
  (618,-2,80),(220210,5,40),(678,60,125),(223761,90,105),(676,5,55),(223762,33,41),(646,60,110),(220277,80,100),
  (807,-20,400),(220621,50,300),(223835,0,120),(190,0,2),(3420,20,100),(3422,20,100),
  (184,1,4),(220739,1,4),(454,1,6),(223901,1,6),(723,1,5),(223900,1,5),
  (442,-5,420),(455,-5,420),(6701,-5,420),(220050,60,200),(8440,20,310),(8441,20,310),(8555,20,310),(220051,30,120),(52,10,320),(6702,10,320),(443,10,320),
  (220181,40,130),(225312,40,130),(615,-2,80),(224690,5,40),(811,-20,400),(1529,-20,400),(3745,-20,400),(3744,-20,400),(225664,50,300),(226537,50,300)) AS t(a,b,c)) i
WHERE (e.event_id*31+i.itemid)%3=0
"""

VIEWS["labevents"] = """
SELECT e.user_id AS hadm_id, e.ts + INTERVAL '45' MINUTE AS charttime, i.itemid,
  CASE WHEN i.itemid=50800 AND e.event_id%6=0 THEN 'ART' WHEN i.itemid=50800 AND e.event_id%6=2 THEN 'VEN' WHEN i.itemid=50812 AND e.event_id%8=0 THEN 'INTUBATED' END AS value,
  CASE WHEN i.itemid IN (50800,50812) OR (e.event_id+i.itemid)%11=0 THEN NULL ELSE i.lo + (i.hi-i.lo)*CAST((e.event_id*7907+i.itemid*41)%1000 AS DOUBLE)/CAST(1000 AS DOUBLE) END AS valuenum
FROM events e CROSS JOIN (SELECT CAST(a AS INT) AS itemid, CAST(b AS DOUBLE) AS lo, CAST(c AS DOUBLE) AS hi, d AS variant FROM (VALUES
  (50800,0,0,0),(50800,0,0,1),(50801,100,600,0),(50802,-10,10,0),(50803,10,40,0),(50804,10,45,0),(50805,0,5,0),(50806,90,120,0),(50808,0,2,0),
  (50809,50,300,0),(50810,20,110,0),(50811,5,20,0),(50812,0,0,0),(50813,0,60,0),(50814,0,3,0),(50815,0,80,0),(50816,0,110,0),(50817,50,105,0),
  (50818,20,90,0),(50819,0,20,0),(50820,7,8,0),(50821,20,900,0),(50822,2,8,0),(50823,0,100,0),(50824,120,160,0),(50825,34,41,0),(50826,300,700,0),
  (50827,5,30,0),(50828,0,10,0),(50868,5,30,0),(50862,0,12,0),(51144,-5,110,0),(50882,10,40,0),(50885,0,160,0),(50912,0,160,0),(50902,90,120,0),
  (50931,50,400,0),(51221,20,110,0),(51222,5,55,0),(51265,10,900,0),(50971,2,35,0),(51275,20,160,0),(51237,0,55,0),(51274,10,160,0),(50983,120,210,0),
  (51006,5,320,0),(51300,1,1100,0),(51301,1,1100,0)) AS t(a,b,c,d)) i
WHERE e.event_id%2=0 AND (i.variant=0 OR e.event_id%20=0)
"""

VIEWS["outputevents"] = """
SELECT user_id*10 + CAST(floor((day(ts)-1)/10) AS BIGINT) AS icustay_id, ts AS charttime,
  ([227489,226559,40055,40069,43175,40094,40715,40473,40085,40057,40056,40405,40428,40086,40096,40651,226560,226561,226584,226563,226564,226565,226567,226557,226558,227488,99999])[event_id%27+1] AS itemid, value
FROM events
"""



ORDER = ("icustays", "admissions", "patients", "chartevents", "labevents", "outputevents")


def with_views(body: str, names=ORDER) -> str:
    """``WITH <views>, <body ctes>`` — ``body`` must start with ``name AS (`` or
    be a plain SELECT (then it is appended after the views)."""
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {ctes}\n{body}"
    return f"WITH {ctes},\n{body}"
