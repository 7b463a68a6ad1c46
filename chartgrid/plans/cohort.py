"""Stay cohort (K1), stay bounds (A1/F2) and the hour grid (K2)."""
from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import round_half_away
from ..functions.time import add_hours, ceil_hour, day_diff, hour_diff, second_diff
from ..operators.grid import hour_grid
from ..operators.rank import ordinal
from ..sources.fixtures import IcuSources
from . import concepts as K


def rows_in_stay_window(src: IcuSources, codes=K.HEART_RATE_CODES) -> DataFrame:
    """Chart rows of ``codes`` inside (intime - 12h, outtime - 12h) of their
    stay: an equi-join on the stay with a time-range residual (J3).  Both sides
    grow with the data, so they meet by a merge and nothing goes through the
    driver; the stay bounds are grouped by the same key."""
    rows = src.chart(codes).select("icustay_id", "charttime", "itemid")
    stays = src.icustays.select("icustay_id", "intime", "outtime").hint("merge")
    return rows.join(stays, "icustay_id").where(
        (F.col("charttime") > add_hours("intime", -K.STAY_WINDOW_HOURS))
        & (F.col("charttime") < add_hours("outtime", -K.STAY_WINDOW_HOURS))
    ).select("icustay_id", "charttime", "itemid")


def stay_bounds(src: IcuSources) -> DataFrame:
    """First/last heart-rate time per stay, rounded up to the hour, using
    only rows in (intime - 12h, outtime - 12h) (both strict)."""
    j = rows_in_stay_window(src)
    return j.groupBy("icustay_id").agg(ceil_hour(F.min("charttime")).alias("intime_hr"),
                                       ceil_hour(F.max("charttime")).alias("outtime_hr"))


def stay_numbers(src: IcuSources, bounds: DataFrame) -> DataFrame:
    """Ordinal of each stay within its subject by rounded start (NULL start
    first; stays without heart-rate rows still take a number)."""
    icu = src.icustays.select("subject_id", "icustay_id").join(bounds.hint("merge"), "icustay_id", "left")
    icu = ordinal(icu, ["subject_id"],
                  [F.col("intime_hr").asc_nulls_first(), F.col("icustay_id")], "icustay_num")
    return icu.where(F.col("intime_hr").isNotNull())


def cohort(src: IcuSources, bounds: DataFrame | None = None) -> DataFrame:
    """One row per stay with heart-rate data: demographics, outcomes and the
    exclusion flags (``excluded`` = any rule fires).  Admissions, patients and
    stays grow with the data: they are merged, never broadcast by an estimate."""
    bounds = bounds if bounds is not None else stay_bounds(src)
    icu = stay_numbers(src, bounds)
    adm = src.admissions.select("hadm_id", "admittime", "dischtime", "deathtime", "ethnicity",
                                "admission_type", "hospital_expire_flag",
                                "has_chartevents_data", "diagnosis")
    pat = src.patients.select("subject_id", "gender", "dob", "dod", "expire_flag")
    stays = src.icustays.select("subject_id", "hadm_id", "icustay_id", "dbsource",
                                F.col("intime").alias("icu_intime"),
                                F.col("outtime").alias("icu_outtime"), "los")
    j = (stays.join(adm.hint("merge"), "hadm_id").join(pat.hint("merge"), "subject_id")
              .join(icu.drop("subject_id").hint("merge"), "icustay_id"))
    age = round_half_away(day_diff("admittime", "dob") / F.lit(K.DAYS_PER_YEAR), 4)
    r_adult = age <= F.lit(float(K.ADULT_AGE))
    r_valid = ((F.col("has_chartevents_data") == 0) | F.col("icu_intime").isNull()
               | F.col("icu_outtime").isNull() | F.col("intime_hr").isNull()
               | F.col("outtime_hr").isNull())
    r_short = hour_diff("outtime_hr", "intime_hr") <= F.lit(K.SHORT_STAY_HOURS)
    diag = F.lower(F.col("diagnosis"))
    r_donor = reduce(or_, [diag.like(p) & F.col("deathtime").isNotNull() for p in K.DONOR_PATTERNS])
    flag = lambda c: F.when(c, 1).otherwise(0)
    return j.select(
        "subject_id", "hadm_id", "icustay_id", "dbsource",
        F.col("intime_hr").alias("intime"), F.col("outtime_hr").alias("outtime"),
        age.alias("age"), "gender", "ethnicity", "admission_type", "icustay_num",
        "hospital_expire_flag", "expire_flag", F.col("los").alias("icu_los"),
        flag(F.col("dod") <= F.col("admittime") + F.make_dt_interval(F.lit(K.THIRTY_DAYS)))
        .alias("thirtyday_expire_flag"),
        (second_diff("dischtime", "admittime") / F.lit(60.0) / F.lit(60.0) / F.lit(24.0))
        .alias("hosp_los"),
        (hour_diff("deathtime", "intime_hr") / F.lit(60.0) / F.lit(60.0)).alias("hosp_deathtime_hours"),
        (hour_diff("dod", "intime_hr") / F.lit(60.0) / F.lit(60.0)).alias("deathtime_hours"),
        F.col("deathtime").alias("deadthtime_check"),
        flag(r_adult).alias("exclusion_adult"),
        flag(r_valid).alias("exclusion_valid_data"),
        flag(r_short).alias("exclusion_short_stay"),
        flag(r_donor).alias("exclusion_organ_donor"),
        flag(r_adult | r_valid | r_short | r_donor).alias("excluded"),
    )


def kept_stays(cohort_df: DataFrame) -> DataFrame:
    """Stays that pass every exclusion rule."""
    return cohort_df.where(F.col("excluded") == 0)


def cohort_hours(kept: DataFrame, start: int = K.GRID_START_HOUR) -> DataFrame:
    """(subject_id, hadm_id, icustay_id, hr) for hr in [start, hours of stay]."""
    base = kept.select("subject_id", "hadm_id", "icustay_id",
                       hour_diff("outtime", "intime").alias("__n"))
    return hour_grid(base, "__n", start, "hr").drop("__n")
