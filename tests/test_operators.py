import random
from datetime import datetime as dt, timedelta as td

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from chartgrid.functions.scalar import ne_3vl, round_half_away
from chartgrid.operators.asof import asof_lookback
from chartgrid.operators.carry import carry_previous
from chartgrid.operators.cumulative import prefix_sums
from chartgrid.operators.grid import hour_grid
from chartgrid.operators.metrics import auc, confusion_matrix, roc_points
from chartgrid.operators.pivot import Concept, pivot_agg
from chartgrid.operators.quality import complete_entities, exact_length_entities, missing_fraction
from chartgrid.operators.quantile import exact_quantiles
from chartgrid.operators.rank import best_per_group, ordinal
from chartgrid.operators.sample import hash_split, oversample
from chartgrid.operators.sequence import sliding_windows
from chartgrid.plans.bloodgas import fio2_value, specimen_probability
from chartgrid.plans.explore import los_histogram, los_label


def ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def test_grid_edges(spark):
    df = spark.createDataFrame([(1, 5), (2, 0), (3, -24), (4, -25), (5, None)], "stay long, n int")
    got = dict((r[0], r[1]) for r in hour_grid(df, "n").groupBy("stay").count().collect())
    assert got == {1: 30, 2: 25, 3: 1}


def test_error_three_valued(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "error int")
    assert df.where(ne_3vl("error", 1)).count() == 1
    assert df.where(ne_3vl("error", 1, null_safe=True)).count() == 2


def test_limits_strict_and_inclusive(spark):
    from chartgrid.plans import concepts as K
    rows = [(211, 0.0), (211, 300.0), (211, 299.0), (646, 100.0), (678, 70.0), (678, 120.0),
            (678, 98.6)]
    df = spark.createDataFrame([(1, 0) + r for r in rows], "icustay_id long, hr long, itemid int, valuenum double")
    out = pivot_agg(df, ["icustay_id", "hr"], K.VITALS).first()
    assert out["heartrate"] == 299.0
    assert out["spo2"] == 100.0
    assert abs(out["tempc"] - (98.6 - 32) / 1.8) < 1e-12


def test_fio2_normalise(spark):
    rows = [(223835, 0.5, 50.0), (223835, 1.0, 100.0), (223835, 1.5, None), (223835, 21.0, 21.0),
            (190, 0.20, None), (190, 0.21, 21.0)]
    df = spark.createDataFrame([r[:2] for r in rows], "itemid int, valuenum double")
    got = [r[0] for r in df.select(fio2_value()).collect()]
    for g, (_, _, want) in zip(got, rows):
        assert (g is None and want is None) or abs(g - want) < 1e-9


def test_lookback_edges(spark):
    t0 = dt(2024, 1, 1, 12, 0, 0)
    left = ntz(spark.createDataFrame([(1, t0)], "k long, t timestamp"), "t")
    cases = {"exact_2h": (t0 - td(hours=2), True), "too_old": (t0 - td(hours=2, seconds=1), False),
             "same": (t0, True), "future": (t0 + td(seconds=1), False)}
    for name, (rt, hit) in cases.items():
        right = ntz(spark.createDataFrame([(1, rt, 7.0)], "k long, t timestamp, v double"), "t")
        r = asof_lookback(left, right, ["k"], "t", "t", ["v"], 7200).first()
        assert (r["v"] == 7.0) == hit, name


def test_asof_matches_brute_force(spark):
    rnd = random.Random(3)
    base = dt(2024, 1, 1)
    L = [(rnd.randint(1, 4), base + td(minutes=rnd.randint(0, 3000)), i) for i in range(400)]
    R = {}
    for _ in range(300):
        k, t = rnd.randint(1, 4), base + td(minutes=rnd.randint(0, 3000))
        R[(k, t)] = rnd.random()
    left = ntz(spark.createDataFrame(L, "k long, t timestamp, id long"), "t")
    right = ntz(spark.createDataFrame([(k, t, v) for (k, t), v in R.items()],
                                      "k long, t timestamp, v double"), "t")
    got = {r["id"]: r["v"] for r in asof_lookback(left, right, ["k"], "t", "t", ["v"], 3 * 3600).collect()}
    for k, t, i in L:
        cands = [(rt, v) for (rk, rt), v in R.items() if rk == k and t - td(hours=3) <= rt <= t]
        want = max(cands)[1] if cands else None
        assert got[i] == want


def test_carry_edges(spark):
    t0 = dt(2024, 1, 1, 12)
    rows = [(1, t0, 3.0), (1, t0 + td(hours=6), 4.0), (1, t0 + td(hours=11), None),
            (2, t0, 1.0), (2, t0 + td(hours=5, minutes=59), 2.0)]
    df = ntz(spark.createDataFrame(rows, "k long, t timestamp, v double"), "t")
    got = {(r["k"], r["t"]): r["prev_v"] for r in
           carry_previous(df, ["k"], "t", ["v"], 6 * 3600).collect()}
    assert got[(1, t0 + td(hours=6))] is None          # exactly 6 h old: not carried (strict)
    assert got[(1, t0 + td(hours=11))] == 4.0
    assert got[(2, t0 + td(hours=5, minutes=59))] == 1.0


def test_best_row_order_and_ties(spark):
    t0 = dt(2024, 1, 1)
    rows = [(1, 0, 3, 0, 15.0, t0), (1, 0, 3, 0, 14.0, t0 + td(minutes=1)),
            (1, 0, 2, 0, 3.0, t0 + td(minutes=2)), (1, 0, 3, 1, 3.0, t0),
            (2, 0, 3, 0, 9.0, t0), (2, 0, 3, 0, 9.0, t0 + td(minutes=5))]
    df = ntz(spark.createDataFrame(rows, "stay long, hr long, comp int, flag int, gcs double, t timestamp"), "t")
    b = best_per_group(df, ["stay", "hr"], [("comp", False), ("flag", True), ("gcs", True), ("t", False)])
    got = {r["stay"]: (r["gcs"], r["t"]) for r in b.collect()}
    assert got[1] == (14.0, t0 + td(minutes=1))
    assert got[2] == (9.0, t0 + td(minutes=5))


def test_ordinal_null_first(spark):
    rows = [(1, 10, None), (1, 11, dt(2024, 1, 2)), (1, 12, dt(2024, 1, 1))]
    df = ntz(spark.createDataFrame(rows, "subject long, stay long, start timestamp"), "start")
    got = {r["stay"]: r["n"] for r in
           ordinal(df, ["subject"], [F.col("start").asc_nulls_first()], "n").collect()}
    assert got == {10: 1, 12: 2, 11: 3}


def test_specimen_probability(spark):
    cols = ["po2", "spo2", "fio2_chartevents", "hemoglobin", "so2", "pco2", "fio2", "aado2",
            "bicarbonate", "totalco2", "lactate", "ph", "o2flow"]
    schema = ", ".join(f"{c} double" for c in cols)
    df = spark.createDataFrame([(100.0,) + (None,) * 12, (None,) * 13], schema)
    p = [r[0] for r in df.select(specimen_probability()).collect()]
    from chartgrid.plans import concepts as K
    z = K.SPECIMEN_INTERCEPT + K.SPECIMEN_PO2_COEF * 100 + sum(c * m + o for _, c, m, o in K.SPECIMEN_TERMS)
    assert abs(p[0] - 1 / (1 + np.exp(-z))) < 1e-12
    assert p[1] is None


def test_los_labels(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (8.0,), (9.0,), (14.0,)], "los double")
    got = [r[0] for r in df.select(los_label("los")).collect()]
    assert got == ["0", "2", "2", "8", "8-14", ">14"]
    hist = {r["days"]: r["n"] for r in los_histogram(df, "los").collect()}
    assert hist["2"] == 2 and hist["8-14"] == 1 and hist[">14"] == 1 and hist["5"] == 0 and "8" not in hist


def test_sequence_window_counts(spark):
    rows = [(e, h, float(h), 1) for e, n in ((1, 25), (2, 24), (3, 27)) for h in range(n)]
    df = spark.createDataFrame(rows, "e long, hr long, x double, y int")
    w = sliding_windows(df, "e", "hr", ["x"], "y", 24)
    assert dict(w.groupBy("e").count().collect()) == {1: 1, 3: 3}
    first = w.where("e = 1").first()
    assert [s[0] for s in first["seq"]] == [float(i) for i in range(24)]


def test_missing_fraction_strict(spark):
    rows = [(1, v) for v in [1.0, None, float("nan"), 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, None]] + \
           [(2, v) for v in [1.0, None, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0]]
    df = spark.createDataFrame(rows, "e long, x double")
    fr = dict(missing_fraction(df, "e", ["x"]).collect())
    assert abs(fr[1] - 0.3) < 1e-12 and abs(fr[2] - 0.1) < 1e-12
    kept = complete_entities(df, "e", ["x"], 0.3).select("e").distinct().collect()
    assert [r[0] for r in kept] == [2]
    assert exact_length_entities(df, "e", 10).count() == 20


def test_prefix_sums_vs_pandas(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"k": rng.permutation(500).astype(float), "x": rng.integers(0, 10, 500)})
    got = prefix_sums(spark.createDataFrame(pdf), "k", ["x"]).toPandas().sort_values("k")
    want = pdf.sort_values("k")["x"].cumsum().values
    assert (got["cum_x"].values == want).all()


def test_auc_roc_vs_pairwise(spark):
    rng = np.random.default_rng(1)
    s = rng.integers(0, 8, 300).astype(float)
    y = (rng.random(300) < 0.3 + s / 20).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"s": s, "y": y}))
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(auc(df, "s", "y").first()[0] - want) < 1e-12
    roc = roc_points(df, "s", "y").orderBy("threshold").toPandas()
    t = roc["threshold"].iloc[0]
    assert abs(roc["tpr"].iloc[0] - (pos >= t).mean()) < 1e-12
    one_class = spark.createDataFrame([(1.0, 1), (2.0, 1)], "s double, y int")
    assert auc(one_class, "s", "y").first()[0] is None


def test_confusion_zero_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "y int, p int")
    got = {(r[0], r[1]): r[2] for r in confusion_matrix(df, "y", "p").collect()}
    assert got == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 2}


def test_exact_quantiles_vs_pandas(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.normal(size=3001), "b": rng.integers(0, 4, 3001).astype(float)})
    pdf.loc[::7, "a"] = np.nan
    df = spark.createDataFrame(pdf)
    for q in (0.5, 0.25, 0.9):
        got = exact_quantiles(df, ["a", "b"], q)
        for c in "ab":
            assert abs(got[c] - pdf[c].quantile(q)) < 1e-12


def test_exact_quantiles_of_extreme_values(spark):
    rows = [(float("-inf"), -1.7e308, None), (1.0, 1.7e308, None), (2.0, 0.0, None), (4.0, -1.0, None),
            (5.0, 3.0, None), (6.0, 3.0, None), (float("inf"), 2.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    assert exact_quantiles(df, ["a", "b", "c"]) == {"a": 4.0, "b": 2.0, "c": None}
    many = df.crossJoin(spark.range(3000)).select("a", "b", "c")      # the row count changes nothing
    assert exact_quantiles(many, ["a", "b", "c"]) == {"a": 4.0, "b": 2.0, "c": None}
    wide = spark.createDataFrame([(-1.7e308,), (1.7e308,)], "a double")
    assert exact_quantiles(wide, ["a"]) == {"a": 0.0}


def test_asof_null_keys_and_ties(spark):
    from datetime import datetime as dt
    left = spark.createDataFrame([(None, dt(2024, 1, 1, 1)), (1, dt(2024, 1, 1, 1))], "k long, t timestamp_ntz")
    right = spark.createDataFrame([(None, dt(2024, 1, 1, 0, 30), 7.0), (1, dt(2024, 1, 1, 0, 30), 3.0),
                                   (1, dt(2024, 1, 1, 0, 30), 5.0)], "k long, t timestamp_ntz, v double")
    got = {r["k"]: r["v"] for r in asof_lookback(left, right, ["k"], "t", "t", ["v"], 3600).collect()}
    assert got == {None: None, 1: 5.0}


def test_auc_of_very_many_rows(spark, monkeypatch):
    from chartgrid.operators import metrics
    counts = spark.createDataFrame([(0.1, 0, 4 * 10**9), (0.9, 4 * 10**9, 0)], "score double, p long, n long")
    monkeypatch.setattr(metrics, "score_counts", lambda *a: counts)
    assert metrics.auc(counts, "score", "p").first()[0] == 1.0


def test_split_and_oversample(spark):
    df = spark.createDataFrame([(i, h, int(i % 4 == 0)) for i in range(1, 101) for h in range(3)],
                               "id long, h int, y int")
    s = hash_split(df, "id", 0.8, 0)
    per_id = s.groupBy("id").agg(F.countDistinct("split").alias("n")).where("n > 1").count()
    assert per_id == 0
    o = oversample(df, "y", 6)
    assert o.count() == 300 + 6 * 25 * 3
    assert o.where("copy = 3").agg(F.min("id")).first()[0] == 4


def test_windows_of_copies_stay_apart(spark):
    from chartgrid.plans.sequences import SequencePrep
    rows = [(e, d, float(e * 10 + d), y) for e, y in ((1, 1), (100001, 0)) for d in range(5)]
    df = spark.createDataFrame(rows, "e long, d long, x double, y int").withColumn("split", F.lit("train"))
    w = SequencePrep("e", "d", ["x"], "y", length=3).split_windows(df)
    got = [(r["e"], r["copy"], r["start"], [s[0] for s in r["seq"]]) for r in w.collect()]
    assert len(got) == 7 * 2 + 2
    assert all(seq == [e * 10.0 + start + i for i in range(3)] for e, _, start, seq in got)


def test_round_half_away(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.12345,)], "x double")
    got = [r[0] for r in df.select(round_half_away("x", 0)).collect()]
    assert got == [3.0, -3.0, 0.0]


def test_median_fit_on_train_differs_only_in_fill(spark):
    from chartgrid.plans.sequences import SequencePrep
    rows = [(e, d, (None if (e + d) % 5 == 0 else float(e * 10 + d)), e % 2)
            for e in range(1, 41) for d in range(25)]
    df = spark.createDataFrame(rows, "e long, d long, x double, y int")
    a = SequencePrep("e", "d", ["x"], "y").imputed(df)
    b = SequencePrep("e", "d", ["x"], "y", median_fit_on="train").imputed(df)
    assert a.count() == b.count() == 1000
    assert a.where("x IS NULL").count() == 0 and b.where("x IS NULL").count() == 0


def test_labs_per_stay_option(spark):
    from datetime import datetime as dt
    from chartgrid.plans.vitals import labs_hourly
    kept = spark.createDataFrame([(1, 10, dt(2024, 1, 1, 0)), (1, 11, dt(2024, 1, 1, 1))],
                                 "hadm_id long, icustay_id long, intime timestamp_ntz")
    le = spark.createDataFrame([(1, dt(2024, 1, 1, 2, 30), 50983, 140.0)],
                               "hadm_id long, charttime timestamp_ntz, itemid int, valuenum double")
    by_adm = {(r["hadm_id"], r["hr"]): r["sodium"] for r in labs_hourly(le, kept).collect()}
    by_stay = {(r["icustay_id"], r["hr"]): r["sodium"] for r in labs_hourly(le, kept, per_stay=True).collect()}
    assert by_adm == {(1, 2): 140.0, (1, 1): 140.0}
    assert by_stay == {(10, 2): 140.0, (11, 1): 140.0}


def test_fused_complete_exact_equals_chain(spark):
    from chartgrid.operators.quality import complete_exact_entities
    rows = [(e, h, None if (e * 7 + h) % (e + 2) == 0 else float(h)) for e in range(1, 15)
            for h in range(20 + e % 3)]
    df = spark.createDataFrame(rows, "e long, h long, x double")
    a = exact_length_entities(complete_entities(df, "e", ["x"], 0.3), "e", 21)
    b = complete_exact_entities(df, "e", ["x"], 0.3, 21)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert b.count() > 0
