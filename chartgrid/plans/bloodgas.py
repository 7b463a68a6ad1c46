"""Blood-gas panel (K4), charted SpO2/FiO2 (K5) and arterial gas per hour (K6)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import in_range, logistic, ne_3vl
from ..functions.time import hour_diff
from ..operators.asof import asof_lookback
from ..operators.pivot import Concept, count_code, pivot_agg
from ..operators.rank import best_per_group, last_per_group
from ..sources.io import materialise
from . import concepts as K


def panel_concepts() -> list[Concept]:
    out = [Concept.simple("specimen", (K.SPECIMEN_CODE,), agg="max", value_col="value")]
    for name, code, lo, hi in K.BLOOD_GAS:
        out.append(Concept.simple(name, (code,), lo, hi, hi_inclusive=True))
    out.append(Concept.simple("intubated", (K.INTUBATED_CODE,), agg="max", value_col="value"))
    return out


def bg_panel(labevents: DataFrame) -> DataFrame:
    """(hadm_id, charttime) -> specimen, intubated and 26 gas values; panels
    with two or more specimen entries are dropped (HAVING)."""
    le = labevents.where(F.col("itemid").isin(*K.BLOOD_GAS_CODES)).select(
        "hadm_id", "charttime", "itemid", "value", "valuenum")
    p = pivot_agg(le, ["hadm_id", "charttime"], panel_concepts(),
                  extra_aggs=[count_code(K.SPECIMEN_CODE).alias("__n_specimen")])
    return p.where(F.col("__n_specimen") < 2).drop("__n_specimen")


def spo2_charted(chartevents: DataFrame) -> DataFrame:
    """(hadm_id, charttime) -> avg charted SpO2 in (0, 100]."""
    return (chartevents.where(F.col("itemid").isin(*K.SPO2_CODES)
                              & in_range("valuenum", 0, 100, hi_inclusive=True))
            .groupBy("hadm_id", "charttime").agg(F.avg("valuenum").alias("spo2")))


def fio2_value() -> Column:
    """Charted FiO2 normalised to percent (fraction codes scaled by 100)."""
    v, i = F.col("valuenum"), F.col("itemid")
    return (F.when(i == 223835,
                   F.when((v > 0) & (v <= 1), v * F.lit(100.0))
                    .when((v > 1) & (v < 21), F.lit(None).cast("double"))
                    .when((v >= 21) & (v <= 100), v))
             .when(i.isin(3420, 3422), v)
             .when((i == 190) & (v > F.lit(0.20)) & (v < 1), v * F.lit(100.0)))


def fio2_charted(chartevents: DataFrame, null_safe_error: bool = False) -> DataFrame:
    """(hadm_id, charttime) -> max normalised charted FiO2."""
    return (chartevents.where(F.col("itemid").isin(*K.FIO2_CODES)
                              & in_range("valuenum", 0, 100) & ne_3vl("error", 1, null_safe_error))
            .groupBy("hadm_id", "charttime").agg(F.max(fio2_value()).alias("fio2_chartevents")))


def specimen_probability(intercept=K.SPECIMEN_INTERCEPT, po2_coef=K.SPECIMEN_PO2_COEF,
                         terms=K.SPECIMEN_TERMS) -> Column:
    """Logistic score; a missing input contributes coef*mean + offset, a
    missing po2 makes the score NULL."""
    z = F.lit(intercept) + F.lit(po2_coef) * F.col("po2")
    for name, coef, mean, offset in terms:
        z = z + F.coalesce(F.lit(coef) * F.col(name), F.lit(coef) * F.lit(mean) + F.lit(offset))
    return logistic(z)


def first_kept_stay(kept: DataFrame) -> DataFrame:
    """(hadm_id, icustay_id, intime) of the lowest kept stay id per admission."""
    return best_per_group(kept.select("hadm_id", "icustay_id", "intime"), ["hadm_id"],
                          [("icustay_id", True)], ["icustay_id", "intime"])


ART_COLUMNS = ("specimen", "specimen_pred", "specimen_prob", "so2", "spo2", "po2", "pco2",
               "fio2_chartevents", "fio2", "aado2", "aado2_calc", "pao2fio2ratio", "ph",
               "baseexcess", "bicarbonate", "totalco2", "hematocrit", "hemoglobin",
               "carboxyhemoglobin", "methemoglobin", "chloride", "calcium", "temperature",
               "potassium", "sodium", "lactate", "glucose", "intubated", "tidalvolume",
               "ventilationrate", "ventilator", "peep", "o2flow", "requiredo2")


def _of_kept(events: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of admissions with a kept stay (charted rows before they are aggregated, gases
    after: a panel's thirty rows are one row before anything is shuffled)."""
    return events.join(kept.select("hadm_id"), "hadm_id", "left_semi")


def gas_with_context(labevents: DataFrame, chartevents: DataFrame, kept: DataFrame) -> DataFrame:
    """Every gas with a PO2 of an admission with a kept stay, on the hour grid
    of the admission's lowest kept stay, with the latest charted SpO2 of the
    previous 2 h and the latest positive charted FiO2 of the previous 4 h."""
    chartevents = _of_kept(chartevents, kept)
    bg = _of_kept(bg_panel(labevents).where(F.col("po2").isNotNull()), kept)
    bg = (bg.join(first_kept_stay(kept), "hadm_id")
            .withColumn("hr", hour_diff("charttime", "intime")).drop("intime", "icustay_id"))
    return _attach_charted(bg, chartevents)


def _attach_charted(bg: DataFrame, chartevents: DataFrame) -> DataFrame:
    """Latest charted SpO2 (2 h) and latest positive charted FiO2 (4 h).  The gases are
    written first: cutting a look-back into ranges reads its input twice."""
    bg = materialise(bg, "gas")
    bg = asof_lookback(bg, spo2_charted(chartevents), ["hadm_id"], "charttime", "charttime",
                       ["spo2"], K.SPO2_LOOKBACK_HOURS * 3600)
    fio2 = fio2_charted(chartevents).where(F.col("fio2_chartevents") > 0)
    return asof_lookback(bg, fio2, ["hadm_id"], "charttime", "charttime",
                         ["fio2_chartevents"], K.FIO2_LOOKBACK_HOURS * 3600)


def art_bg(labevents: DataFrame, chartevents: DataFrame, kept: DataFrame) -> DataFrame:
    """(hadm_id, hr) -> the latest arterial (measured or predicted) gas.

    Deterministic form of the published steps: every gas with a PO2 of an
    admission with a kept stay is placed on the hour grid of the admission's
    lowest kept stay; the latest charted SpO2 of the previous 2 h and the
    latest positive charted FiO2 of the previous 4 h are attached; per hour
    the latest gas is kept, and it is kept only if its specimen is arterial
    or the predicted probability exceeds 0.75.
    """
    # The latest gas of each hour depends on charttime only, so it is chosen
    # before the look-backs: identical result, and the as-of joins only see
    # the gases that are kept.
    chartevents = _of_kept(chartevents, kept)
    bg = _of_kept(bg_panel(labevents).where(F.col("po2").isNotNull()), kept)
    bg = (bg.join(first_kept_stay(kept), "hadm_id")
            .withColumn("hr", hour_diff("charttime", "intime")).drop("intime", "icustay_id"))
    bg = _attach_charted(last_per_group(bg, ["hadm_id", "hr"], "charttime"), chartevents)
    bg = bg.withColumn("specimen_prob", specimen_probability())
    bg = bg.where((F.col("specimen") == "ART") | (F.col("specimen_prob") > K.SPECIMEN_THRESHOLD))
    fio2_any = F.coalesce(F.col("fio2"), F.col("fio2_chartevents"))
    po2, pco2 = F.col("po2"), F.col("pco2")
    return bg.select(
        "hadm_id", "charttime", "hr",
        F.when(F.col("specimen").isNotNull(), F.col("specimen"))
         .when(F.col("specimen_prob") > K.SPECIMEN_THRESHOLD, F.lit("ART")).alias("specimen_pred"),
        F.when(po2.isNotNull() & pco2.isNotNull() & fio2_any.isNotNull(),
               (fio2_any / F.lit(100.0)) * F.lit(760.0 - 47.0) - (pco2 / F.lit(0.8)) - po2)
         .alias("aado2_calc"),
        F.when(po2.isNotNull() & fio2_any.isNotNull(), F.lit(100.0) * po2 / fio2_any)
         .alias("pao2fio2ratio"),
        *[c for c in ART_COLUMNS if c not in ("specimen_pred", "aado2_calc", "pao2fio2ratio")])
