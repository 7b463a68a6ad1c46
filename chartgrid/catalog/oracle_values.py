"""Rule tables of the oracle, stated on their own (the engine has its own copy in
``plans/concepts.py``), so that a wrong value in either shows as a mismatch."""
from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (item codes, limits, coefficients of the published definitions)
# ---------------------------------------------------------------------------

# feature, codes, value above, value below, upper limit itself allowed, subtract, divide by
VITAL_RULES = (
    ("heartrate", (211, 220045), 0, 300, False, 0, 1),
    ("sysbp", (51, 442, 455, 6701, 220050, 220179), 0, 400, False, 0, 1),
    ("diasbp", (8368, 8440, 8441, 8555, 220051, 220180), 0, 300, False, 0, 1),
    ("meanbp", (52, 443, 456, 6702, 220052, 220181, 225312), 0, 300, False, 0, 1),
    ("resprate", (615, 618, 220210, 224690), 0, 70, False, 0, 1),
    ("tempc", (678, 223761), 70, 120, False, 32, 1.8),
    ("tempc", (676, 223762), 10, 50, False, 0, 1),
    ("spo2", (646, 220277), 0, 100, True, 0, 1),
    ("glucose", (807, 811, 1529, 3744, 3745, 220621, 225664, 226537), 0, None, False, 0, 1),
)

# feature, codes, greatest value, least value; rows need a value above 0
LAB_LIMITS = (
    ("aniongap", (50868,), 10000, None), ("albumin", (50862,), 10, None), ("bands", (51144,), 100, 0),
    ("bicarbonate", (50882,), 10000, None), ("bilirubin", (50885,), 150, None),
    ("creatinine", (50912,), 150, None), ("chloride", (50902,), 10000, None),
    ("glucose", (50931,), 10000, None), ("hematocrit", (51221,), 100, None),
    ("hemoglobin", (51222,), 50, None), ("lactate", (50813,), 50, None), ("platelet", (51265,), 10000, None),
    ("potassium", (50971,), 30, None), ("ptt", (51275,), 150, None), ("inr", (51237,), 50, None),
    ("pt", (51274,), 150, None), ("sodium", (50983,), 200, None), ("bun", (51006,), 300, None),
    ("wbc", (51300, 51301), 1000, None),
)

# feature, code, value above, greatest value
GAS_LIMITS = (
    ("aado2", 50801, 0, None), ("baseexcess", 50802, 0, None), ("bicarbonate", 50803, 0, None),
    ("totalco2", 50804, 0, None), ("carboxyhemoglobin", 50805, 0, None), ("chloride", 50806, 0, None),
    ("calcium", 50808, 0, None), ("glucose", 50809, 0, None), ("hematocrit", 50810, None, 100),
    ("hemoglobin", 50811, 0, None), ("lactate", 50813, 0, None), ("methemoglobin", 50814, 0, None),
    ("o2flow", 50815, 0, 70), ("fio2", 50816, 0, 100), ("so2", 50817, 0, 100), ("pco2", 50818, 0, None),
    ("peep", 50819, 0, None), ("ph", 50820, 0, None), ("po2", 50821, None, 800), ("potassium", 50822, 0, None),
    ("requiredo2", 50823, 0, None), ("sodium", 50824, 0, None), ("temperature", 50825, 0, None),
    ("tidalvolume", 50826, 0, None), ("ventilationrate", 50827, 0, None), ("ventilator", 50828, 0, None),
)
SPECIMEN, INTUBATED = 50800, 50812
GAS_ROWS = (*range(50800, 50829), 51545)

# inspired oxygen: code, least value, itself allowed, greatest value, itself allowed, factor
FIO2_RULES = (
    (190, 0.20, False, 1, False, 100), (3420, 0, False, 100, False, 1), (3422, 0, False, 100, False, 1),
    (223835, 0, False, 1, True, 100), (223835, 21, True, 100, True, 1),
)

# coma score: part, codes, default, text that stands for an intubated verbal answer (by code)
COMA_PARTS = (("motor", (454, 223901), 6), ("verbal", (723, 223900), 5), ("eyes", (184, 220739), 4))
COMA_TEXTS = ((723, "1.0 ET/Trach"), (223900, "No Response-ETT"))

URINE = (40055, 40056, 40057, 40069, 40085, 40086, 40094, 40096, 40405, 40428, 40473, 40651, 40715, 43175,
         226557, 226558, 226559, 226560, 226561, 226563, 226564, 226565, 226567, 226584, 227488, 227489)
URINE_NEGATIVE = 227489

# arterial specimen: input, coefficient, mean, added when the input is missing
SCORE_TERMS = (
    ("spo2", -0.15356, 97.49420, 0.13429), ("fio2_chartevents", 0.00621, 51.49550, -0.24958),
    ("hemoglobin", 0.10559, 10.32307, 0.05954), ("so2", 0.13251, 93.66539, -0.23172),
    ("pco2", -0.01511, 42.08866, -0.01630), ("fio2", 0.01480, 63.97836, -0.31142),
    ("aado2", -0.00200, 442.21186, -0.01328), ("bicarbonate", -0.03220, 22.96894, -0.06535),
    ("totalco2", 0.05384, 24.72632, -0.01405), ("lactate", 0.08202, 3.06436, 0.06038),
    ("ph", 0.10956, 7.36233, -0.00617), ("o2flow", 0.00848, 7.59362, -0.35803),
)
SCORE_START, SCORE_PO2 = -0.02544, 0.04598

# hourly table: feature and where it comes from, first known first (v vitals, c coma
# score, g arterial gas, l laboratory, u urine)
HOURLY = (
    ("heartrate", "v"), ("sysbp", "v"), ("diasbp", "v"), ("meanbp", "v"), ("resprate", "v"),
    ("tempc", "g.temperature v"), ("spo2", "g.so2 v"), ("glucose", "l g v"),
    ("gcs", "c"), ("gcsmotor", "c"), ("gcsverbal", "c"), ("gcseyes", "c"), ("endotrachflag", "c"),
    ("bg_po2", "g.po2"), ("bg_pco2", "g.pco2"), ("bg_pao2fio2ratio", "g.pao2fio2ratio"), ("bg_ph", "g.ph"),
    ("bg_baseexcess", "g.baseexcess"), ("bg_totalco2", "g.totalco2"),
    ("bg_carboxyhemoglobin", "g.carboxyhemoglobin"), ("bg_methemoglobin", "g.methemoglobin"),
    ("aniongap", "l"), ("albumin", "l"), ("bands", "l"), ("bicarbonate", "l g"), ("bilirubin", "l"),
    ("calcium", "g"), ("creatinine", "l"), ("chloride", "l g"), ("hematocrit", "l g"), ("hemoglobin", "l g"),
    ("lactate", "l g"), ("platelet", "l"), ("potassium", "l g"), ("ptt", "l"), ("inr", "l"), ("bun", "l"),
    ("wbc", "l"), ("sodium", "l g"), ("urineoutput", "u"),
)
# per-stay matrix: attributes of the stay, then mean, min and max of every hourly
# feature in this order, then the sum of the urine output
STAY_ATTRIBUTES = ("dbsource", "expire_flag", "hospital_expire_flag", "deathtime_hours", "hosp_deathtime_hours",
                   "age", "gender", "ethnicity", "admission_type", "icustay_num")
MATRIX = ("heartrate", "sysbp", "diasbp", "meanbp", "resprate", "tempc", "spo2", "glucose",
          "gcs", "gcsmotor", "gcsverbal", "gcseyes", "endotrachflag",
          "bg_baseexcess", "bg_carboxyhemoglobin", "bg_methemoglobin", "bg_po2", "bg_pco2", "bg_ph",
          "bg_pao2fio2ratio", "bg_totalco2", "aniongap", "albumin", "bands", "bicarbonate", "bilirubin",
          "calcium", "creatinine", "chloride", "hematocrit", "hemoglobin", "lactate", "platelet", "potassium",
          "ptt", "inr", "sodium", "bun", "wbc")
