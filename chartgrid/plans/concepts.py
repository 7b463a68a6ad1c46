"""Clinical concept definitions: item codes, validity limits, unit rules.

Everything below the marker is fixed values that must equal the published
feature definitions for the results to match; the operators that use them
know nothing clinical.
"""
from __future__ import annotations

from ..operators.pivot import Concept, Rule

# ---------------------------------------------------------------------------
# FIXED VALUES (item codes, limits, coefficients of the published definitions)
# ---------------------------------------------------------------------------

HEART_RATE_CODES = (211, 220045)          # stay bounds use the heart-rate rows

# Vital signs: avg per (stay, hr) of rows with error != 1; open intervals
# unless stated.
VITALS = (
    Concept.simple("heartrate", (211, 220045), 0, 300),
    Concept.simple("sysbp", (51, 442, 455, 6701, 220179, 220050), 0, 400),
    Concept.simple("diasbp", (8368, 8440, 8441, 8555, 220180, 220051), 0, 300),
    Concept.simple("meanbp", (456, 52, 6702, 443, 220052, 220181, 225312), 0, 300),
    Concept.simple("resprate", (615, 618, 220210, 224690), 0, 70),
    Concept("tempc", (
        Rule((223761, 678), 70, 120, transform="({v} - 32.0D) / 1.8D"),
        Rule((223762, 676), 10, 50))),
    Concept.simple("spo2", (646, 220277), 0, 100, hi_inclusive=True),
    Concept.simple("glucose", (807, 811, 1529, 3745, 3744, 225664, 220621, 226537), 0, None),
)
# Item filter of the vitals scan (same codes, in the published order).
VITAL_CODES = (211, 220045, 51, 442, 455, 6701, 220179, 220050, 8368, 8440, 8441, 8555,
               220180, 220051, 456, 52, 6702, 443, 220052, 220181, 225312, 618, 615,
               220210, 224690, 646, 220277, 807, 811, 1529, 3745, 3744,
               225664, 220621, 226537, 223762, 676, 223761, 678)

# Laboratory results: rows with valuenum > 0; value > upper limit -> NULL.
# (feature, codes, inclusive upper limit, inclusive lower limit or None)
LABS = (
    ("aniongap", (50868,), 10000, None),
    ("albumin", (50862,), 10, None),
    ("bands", (51144,), 100, 0),
    ("bicarbonate", (50882,), 10000, None),
    ("bilirubin", (50885,), 150, None),
    ("creatinine", (50912,), 150, None),
    ("chloride", (50902,), 10000, None),
    ("glucose", (50931,), 10000, None),
    ("hematocrit", (51221,), 100, None),
    ("hemoglobin", (51222,), 50, None),
    ("lactate", (50813,), 50, None),
    ("platelet", (51265,), 10000, None),
    ("potassium", (50971,), 30, None),
    ("ptt", (51275,), 150, None),
    ("inr", (51237,), 50, None),
    ("pt", (51274,), 150, None),
    ("sodium", (50983,), 200, None),
    ("bun", (51006,), 300, None),
    ("wbc", (51300, 51301), 1000, None),
)

# Blood-gas panel per (hadm, charttime): string max for specimen/intubated,
# avg of valuenum otherwise; default validity (0, inf).
# (feature, code, lower exclusive or None, upper inclusive or None)
BLOOD_GAS = (
    ("aado2", 50801, 0, None), ("baseexcess", 50802, 0, None), ("bicarbonate", 50803, 0, None),
    ("totalco2", 50804, 0, None), ("carboxyhemoglobin", 50805, 0, None),
    ("chloride", 50806, 0, None), ("calcium", 50808, 0, None), ("glucose", 50809, 0, None),
    ("hematocrit", 50810, None, 100), ("hemoglobin", 50811, 0, None),
    ("lactate", 50813, 0, None), ("methemoglobin", 50814, 0, None),
    ("o2flow", 50815, 0, 70), ("fio2", 50816, 0, 100), ("so2", 50817, 0, 100),
    ("pco2", 50818, 0, None), ("peep", 50819, 0, None), ("ph", 50820, 0, None),
    ("po2", 50821, None, 800), ("potassium", 50822, 0, None), ("requiredo2", 50823, 0, None),
    ("sodium", 50824, 0, None), ("temperature", 50825, 0, None),
    ("tidalvolume", 50826, 0, None), ("ventilationrate", 50827, 0, None),
    ("ventilator", 50828, 0, None),
)
SPECIMEN_CODE = 50800
INTUBATED_CODE = 50812
BLOOD_GAS_CODES = (50800, 50801, 50802, 50803, 50804, 50805, 50806, 50807, 50808, 50809,
                   50810, 50811, 50812, 50813, 50814, 50815, 50816, 50817, 50818, 50819,
                   50820, 50821, 50822, 50823, 50824, 50825, 50826, 50827, 50828, 51545)

# Charted SpO2 (avg, (0, 100]) and FiO2 (max; row filter (0, 100), error != 1).
SPO2_CODES = (646, 220277)
FIO2_CODES = (3420, 190, 223835, 3422)

# Coma score: (canonical code, source codes); text sentinels meaning "verbal 0".
GCS_VERBAL, GCS_MOTOR, GCS_EYES = 723, 454, 184
GCS_CANONICAL = ((723, (723, 223900)), (454, (454, 223901)), (184, (184, 220739)))
GCS_CODES = (184, 454, 723, 223900, 223901, 220739)
GCS_SENTINELS = ((723, "1.0 ET/Trach"), (223900, "No Response-ETT"))
GCS_DEFAULTS = {"motor": 6.0, "verbal": 5.0, "eyes": 4.0}
GCS_CARRY_HOURS = 6

# Urine output: summed per (stay, hr); 227489 is recorded with the wrong sign.
URINE_CODES = (40055, 43175, 40069, 40094, 40715, 40473, 40085, 40057, 40056, 40405,
               40428, 40086, 40096, 40651, 226559, 226560, 226561, 226584, 226563,
               226564, 226565, 226567, 226557, 226558, 227488, 227489)
URINE_NEGATED = 227489

# Arterial-specimen logistic model: z = intercept + po2_coef * po2 + sum(term),
# term = coef * x, or coef * mean + offset when x is missing.
SPECIMEN_INTERCEPT = -0.02544
SPECIMEN_PO2_COEF = 0.04598
# (input, coef, mean, offset)
SPECIMEN_TERMS = (
    ("spo2", -0.15356, 97.49420, 0.13429),
    ("fio2_chartevents", 0.00621, 51.49550, -0.24958),
    ("hemoglobin", 0.10559, 10.32307, 0.05954),
    ("so2", 0.13251, 93.66539, -0.23172),
    ("pco2", -0.01511, 42.08866, -0.01630),
    ("fio2", 0.01480, 63.97836, -0.31142),
    ("aado2", -0.00200, 442.21186, -0.01328),
    ("bicarbonate", -0.03220, 22.96894, -0.06535),
    ("totalco2", 0.05384, 24.72632, -0.01405),
    ("lactate", 0.08202, 3.06436, 0.06038),
    ("ph", 0.10956, 7.36233, -0.00617),
    ("o2flow", 0.00848, 7.59362, -0.35803),
)
SPECIMEN_THRESHOLD = 0.75
SPO2_LOOKBACK_HOURS = 2
FIO2_LOOKBACK_HOURS = 4

# Cohort rules.
STAY_WINDOW_HOURS = 12          # heart-rate rows in (intime - 12h, outtime - 12h)
DAYS_PER_YEAR = 365.242
ADULT_AGE = 16                  # age <= 16 excluded
SHORT_STAY_HOURS = 4            # stays of <= 4 hours excluded
DONOR_PATTERNS = ("%organ donor%", "%donor account%")
THIRTY_DAYS = 30
GRID_START_HOUR = -24

# Source precedence in the hourly table: output <- first non-null of sources.
# (output, [(source frame, column), ...])
PRECEDENCE = (
    ("tempc", (("bg", "temperature"), ("vit", "tempc"))),
    ("spo2", (("bg", "so2"), ("vit", "spo2"))),
    ("glucose", (("lab", "glucose"), ("bg", "glucose"), ("vit", "glucose"))),
    ("bicarbonate", (("lab", "bicarbonate"), ("bg", "bicarbonate"))),
    ("chloride", (("lab", "chloride"), ("bg", "chloride"))),
    ("hematocrit", (("lab", "hematocrit"), ("bg", "hematocrit"))),
    ("hemoglobin", (("lab", "hemoglobin"), ("bg", "hemoglobin"))),
    ("lactate", (("lab", "lactate"), ("bg", "lactate"))),
    ("potassium", (("lab", "potassium"), ("bg", "potassium"))),
    ("sodium", (("lab", "sodium"), ("bg", "sodium"))),
)

# Hourly wide table: 4 keys + 40 features, in published order.
HOURLY_KEYS = ("subject_id", "hadm_id", "icustay_id", "hr")
HOURLY_FEATURES = (
    "heartrate", "sysbp", "diasbp", "meanbp", "resprate", "tempc", "spo2", "glucose",
    "gcs", "gcsmotor", "gcsverbal", "gcseyes", "endotrachflag",
    "bg_po2", "bg_pco2", "bg_pao2fio2ratio", "bg_ph", "bg_baseexcess", "bg_totalco2",
    "bg_carboxyhemoglobin", "bg_methemoglobin",
    "aniongap", "albumin", "bands", "bicarbonate", "bilirubin", "calcium", "creatinine",
    "chloride", "hematocrit", "hemoglobin", "lactate", "platelet", "potassium", "ptt",
    "inr", "bun", "wbc", "sodium", "urineoutput",
)
# Per-stay matrix: carried stay attributes, then mean/min/max groups and urine sum.
MATRIX_CARRIED = ("dbsource", "expire_flag", "hospital_expire_flag", "deathtime_hours",
                  "hosp_deathtime_hours", "age", "gender", "ethnicity", "admission_type",
                  "icustay_num")
MATRIX_VITALS = ("heartrate", "sysbp", "diasbp", "meanbp", "resprate", "tempc", "spo2",
                 "glucose")
MATRIX_GCS = ("gcs", "gcsmotor", "gcsverbal", "gcseyes", "endotrachflag")
MATRIX_LABS = ("bg_baseexcess", "bg_carboxyhemoglobin", "bg_methemoglobin", "bg_po2",
               "bg_pco2", "bg_ph", "bg_pao2fio2ratio", "bg_totalco2", "aniongap", "albumin",
               "bands", "bicarbonate", "bilirubin", "calcium", "creatinine", "chloride",
               "hematocrit", "hemoglobin", "lactate", "platelet", "potassium", "ptt", "inr",
               "sodium", "bun", "wbc")
SEQUENCE_FEATURES = ("heartrate", "sysbp", "diasbp", "meanbp", "resprate", "spo2")
