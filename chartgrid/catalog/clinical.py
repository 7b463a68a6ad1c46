"""Spark side of the clinical keys (K1-K12 and their parts)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import concepts as K
from ..plans.assemble import IcuPipeline
from ..plans.bloodgas import bg_panel
from ..plans.vitals import lab_codes, labs_in_stay
from ..sources.fixtures import icu_sources
from .common import rounded


def _pipe(spark: SparkSession, sf_dir: str) -> IcuPipeline:
    return IcuPipeline(icu_sources(spark, sf_dir))


def q_stay_bounds(spark, sf):
    return _pipe(spark, sf).bounds


def q_cohort(spark, sf):
    return rounded(_pipe(spark, sf).cohort)


def q_hour_grid(spark, sf):
    return _pipe(spark, sf).grid


def q_stay_ordinal_icu(spark, sf):
    from ..operators.rank import ordinal
    p = _pipe(spark, sf)
    # all stays, including those without heart-rate rows (NULL id), as in the source CTE
    icu = p.src.icustays.select("subject_id", "icustay_id").join(p.bounds, "icustay_id", "left")
    icu = ordinal(icu, ["subject_id"], [F.col("intime_hr").asc_nulls_first(), F.col("icustay_id")],
                  "icustay_num")
    return icu.select("subject_id",
                      F.when(F.col("intime_hr").isNotNull(), F.col("icustay_id")).alias("icustay_id"),
                      "icustay_num")


def q_vitals(spark, sf):
    return rounded(_pipe(spark, sf).vitals)


def q_gcs(spark, sf):
    return rounded(_pipe(spark, sf).gcs)


def q_urine_output(spark, sf):
    return rounded(_pipe(spark, sf).urine)


def q_labs_hourly(spark, sf):
    return rounded(_pipe(spark, sf).labs)


def q_labs_in_stay(spark, sf):
    p = _pipe(spark, sf)
    return rounded(labs_in_stay(p.src.labs(lab_codes()), p.kept))


def q_panel_pivot(spark, sf):
    return rounded(bg_panel(icu_sources(spark, sf).labevents))


def q_art_bg(spark, sf):
    return rounded(_pipe(spark, sf).art_bg)


def q_hourly_wide(spark, sf):
    return rounded(_pipe(spark, sf).hourly())


def q_stay_rollup(spark, sf):
    return rounded(_pipe(spark, sf).matrix(48))


def q_matrix_24h(spark, sf):
    return rounded(_pipe(spark, sf).matrix(24))


def q_matrix_12h(spark, sf):
    return rounded(_pipe(spark, sf).matrix(12))


def q_matrix_6h(spark, sf):
    return rounded(_pipe(spark, sf).matrix(6))


def q_matrix_spans(spark, sf):
    return rounded(_pipe(spark, sf).spans())


def q_sequence_extract(spark, sf):
    return rounded(_pipe(spark, sf).sequences(24))


def q_specimen_prob(spark, sf):
    from ..plans.bloodgas import gas_with_context, specimen_probability
    p = _pipe(spark, sf)
    g = gas_with_context(p.src.labs(K.BLOOD_GAS_CODES), p.src.chart(K.SPO2_CODES + K.FIO2_CODES), p.kept)
    return rounded(g.select("hadm_id", "charttime", "hr", "spo2", "fio2_chartevents",
                            specimen_probability().alias("specimen_prob")))


def q_gas_indices(spark, sf):
    return rounded(_pipe(spark, sf).art_bg.select("hadm_id", "hr", "po2", "pco2", "aado2_calc",
                                                  "pao2fio2ratio"))


def q_matrix_null_profile(spark, sf):
    from ..operators.quality import null_profile
    return null_profile(_pipe(spark, sf).matrix(48))


def q_schema_profile(spark, sf):
    from ..operators.quality import schema_profile
    return schema_profile(_pipe(spark, sf).matrix(24))


QUERIES = {
    "schema_profile": q_schema_profile,
    "matrix_null_profile": q_matrix_null_profile,
    "specimen_prob": q_specimen_prob,
    "gas_indices": q_gas_indices,
    "stay_bounds": q_stay_bounds,
    "cohort": q_cohort,
    "hour_grid": q_hour_grid,
    "stay_ordinal_icu": q_stay_ordinal_icu,
    "vitals": q_vitals,
    "gcs": q_gcs,
    "urine_output": q_urine_output,
    "labs_hourly": q_labs_hourly,
    "labs_in_stay": q_labs_in_stay,
    "panel_pivot": q_panel_pivot,
    "art_bg": q_art_bg,
    "hourly_wide": q_hourly_wide,
    "stay_rollup": q_stay_rollup,
    "matrix_24h": q_matrix_24h,
    "matrix_12h": q_matrix_12h,
    "matrix_6h": q_matrix_6h,
    "matrix_spans": q_matrix_spans,
    "sequence_extract": q_sequence_extract,
}
