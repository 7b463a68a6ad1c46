"""Hourly vital signs (K9), urine output (K8) and laboratory results (K7)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import ne_3vl
from ..functions.time import hour_diff
from ..operators.intervals import assign_intervals
from ..operators.pivot import Concept, pivot_agg
from . import concepts as K


def _stay_time(kept: DataFrame, key: str) -> DataFrame:
    return kept.select(key, "intime") if key == "icustay_id" else \
        kept.select("hadm_id", "intime")


def vitals(chartevents: DataFrame, kept: DataFrame, null_safe_error: bool = False) -> DataFrame:
    """(icustay_id, hr) -> 8 vital-sign averages."""
    ce = (chartevents.where(ne_3vl("error", 1, null_safe_error)
                            & F.col("itemid").isin(*K.VITAL_CODES))
          .select("icustay_id", "charttime", "itemid", "valuenum")
          .join(_stay_time(kept, "icustay_id"), "icustay_id")
          .withColumn("hr", hour_diff("charttime", "intime")))
    return pivot_agg(ce, ["icustay_id", "hr"], K.VITALS)


def urine_output(outputevents: DataFrame, kept: DataFrame) -> DataFrame:
    """(icustay_id, hr) -> summed urine output (one code's sign corrected)."""
    uo = (outputevents.where(F.col("itemid").isin(*K.URINE_CODES))
          .join(_stay_time(kept, "icustay_id"), "icustay_id")
          .select("icustay_id", hour_diff("charttime", "intime").alias("hr"),
                  F.when(F.col("itemid") == K.URINE_NEGATED, -F.col("value"))
                   .otherwise(F.col("value")).alias("urineoutput")))
    return uo.groupBy("icustay_id", "hr").agg(F.sum("urineoutput").alias("urineoutput"))


def lab_concepts() -> list[Concept]:
    return [Concept.simple(name, codes, lo, hi, lo_inclusive=True, hi_inclusive=True)
            for name, codes, hi, lo in K.LABS]


def lab_codes() -> list[int]:
    out = []
    for _, codes, _, _ in K.LABS:
        out.extend(codes)
    return out


def labs_hourly(labevents: DataFrame, kept: DataFrame, per_stay: bool = False) -> DataFrame:
    """(hadm_id, hr) -> 19 lab averages.  Lab rows carry only the admission,
    so each row is placed on the hour grid of every kept stay of that
    admission and the groups mix those stays (as published).  With
    ``per_stay=True`` the groups are (icustay_id, hr) instead."""
    stays = kept.select("hadm_id", "icustay_id", "intime") if per_stay else _stay_time(kept, "hadm_id")
    le = (labevents.where(F.col("itemid").isin(*lab_codes()) & F.col("valuenum").isNotNull()
                          & (F.col("valuenum") > 0))
          .select("hadm_id", "charttime", "itemid", "valuenum")
          .join(stays, "hadm_id")
          .withColumn("hr", hour_diff("charttime", "intime")))
    return pivot_agg(le, ["icustay_id" if per_stay else "hadm_id", "hr"], lab_concepts())


def labs_in_stay(labevents: DataFrame, kept: DataFrame) -> DataFrame:
    """(icustay_id, hr) -> 19 lab averages of the rows inside the stay's own
    [intime, outtime): an admission's row goes to the stays that hold its time,
    without pairing every row of it with every stay of it."""
    rows = (labevents.where(F.col("itemid").isin(*lab_codes()) & (F.col("valuenum") > 0))
            .select("hadm_id", "charttime", "itemid", "valuenum"))
    held = assign_intervals(rows, kept.select("hadm_id", "icustay_id", "intime", "outtime"), ["hadm_id"],
                            "charttime", "intime", "outtime")
    return pivot_agg(held.withColumn("hr", hour_diff("charttime", "intime")), ["icustay_id", "hr"], lab_concepts())


def plausibility_clip(labevents: DataFrame) -> DataFrame:
    """Row-level view of the lab limits: concept label and clipped value."""
    le = labevents.where(F.col("itemid").isin(*lab_codes()) & F.col("valuenum").isNotNull()
                         & (F.col("valuenum") > 0))
    from ..operators.pivot import concept_value
    cs = lab_concepts()
    label = None
    value = None
    for c in cs:
        cond = F.col("itemid").isin(*c.codes)
        label = F.when(cond, F.lit(c.name)) if label is None else label.when(cond, F.lit(c.name))
        value = F.when(cond, concept_value(c)) if value is None else value.when(cond, concept_value(c))
    return le.select("hadm_id", "charttime", "itemid", label.alias("label"),
                     value.alias("valuenum"))
