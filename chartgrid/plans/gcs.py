"""Glasgow coma score per (stay, hr) (K3)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import ne_3vl
from ..functions.time import hour_diff
from ..operators.carry import carry_previous
from ..operators.rank import best_per_group
from . import concepts as K


def canonicalise(chartevents: DataFrame, null_safe_error: bool = False) -> DataFrame:
    """Coma-score rows with item codes mapped to one code per component and
    intubation sentinels mapped to verbal 0 (P15, P19)."""
    code = None
    for canon, sources in K.GCS_CANONICAL:
        cond = F.col("itemid").isin(*sources)
        code = F.when(cond, canon) if code is None else code.when(cond, canon)
    code = code.otherwise(F.col("itemid"))
    sentinel = None
    for src_code, text in K.GCS_SENTINELS:
        cond = (F.col("itemid") == src_code) & (F.col("value") == text)
        sentinel = cond if sentinel is None else (sentinel | cond)
    return (chartevents.where(F.col("itemid").isin(*K.GCS_CODES) & ne_3vl("error", 1, null_safe_error))
            .select("icustay_id", "charttime", code.alias("itemid"),
                    F.when(sentinel, F.lit(0.0)).otherwise(F.col("valuenum")).alias("valuenum")))


def canonical_components(chartevents: DataFrame, kept: DataFrame,
                         null_safe_error: bool = False) -> DataFrame:
    """Canonical coma-score rows of kept stays, with the stay's start time."""
    return canonicalise(chartevents, null_safe_error).join(
        kept.select("icustay_id", "intime"), "icustay_id")


def gcs_by_time(rows: DataFrame) -> DataFrame:
    """One row per (stay, charttime) with the three components."""
    comp = lambda c: F.max(F.when(F.col("itemid") == c, F.col("valuenum")))
    g = rows.groupBy("icustay_id", "intime", "charttime").agg(
        comp(K.GCS_MOTOR).alias("gcsmotor"), comp(K.GCS_VERBAL).alias("gcsverbal"),
        comp(K.GCS_EYES).alias("gcseyes"))
    return g.withColumn("endotrachflag", F.when(F.col("gcsverbal") == 0, 1).otherwise(0))


def gcs_score(by_time: DataFrame) -> DataFrame:
    """Total score with the carry rules: a verbal 0 (now, or previously with
    nothing now) scores 15; after a previous verbal 0 the own components
    with defaults; otherwise own -> previous (< 6 h old) -> default."""
    c = carry_previous(by_time, ["icustay_id"], "charttime", ["gcsmotor", "gcsverbal", "gcseyes"],
                       K.GCS_CARRY_HOURS * 3600, strict=True, prefix="prev_")
    d = {k: F.lit(v) for k, v in K.GCS_DEFAULTS.items()}
    m, v, e = F.col("gcsmotor"), F.col("gcsverbal"), F.col("gcseyes")
    pm, pv, pe = F.col("prev_gcsmotor"), F.col("prev_gcsverbal"), F.col("prev_gcseyes")
    score = (F.when((v == 0) | (v.isNull() & (pv == 0)), F.lit(15.0))
             .when(pv == 0, F.coalesce(m, d["motor"]) + F.coalesce(v, d["verbal"])
                   + F.coalesce(e, d["eyes"]))
             .otherwise(F.coalesce(m, pm, d["motor"]) + F.coalesce(v, pv, d["verbal"])
                        + F.coalesce(e, pe, d["eyes"])))
    cm, cv, ce = F.coalesce(m, pm), F.coalesce(v, pv), F.coalesce(e, pe)
    return c.select(
        "icustay_id", "charttime", hour_diff("charttime", "intime").alias("hr"),
        score.alias("gcs"), cm.alias("gcsmotor"), cv.alias("gcsverbal"), ce.alias("gcseyes"),
        (cm.isNotNull().cast("int") + cv.isNotNull().cast("int") + ce.isNotNull().cast("int"))
        .alias("components_measured"),
        "endotrachflag")


def gcs_hourly(chartevents: DataFrame, kept: DataFrame, null_safe_error: bool = False) -> DataFrame:
    """(icustay_id, hr) -> gcs, gcsmotor, gcsverbal, gcseyes, endotrachflag:
    the row with most components, then not intubated, then lowest score,
    then latest."""
    s = gcs_score(gcs_by_time(canonical_components(chartevents, kept, null_safe_error)))
    return best_per_group(
        s, ["icustay_id", "hr"],
        [("components_measured", False), ("endotrachflag", True), ("gcs", True),
         ("charttime", False)],
        ["gcs", "gcsmotor", "gcsverbal", "gcseyes", "endotrachflag"])
