"""Edge rules of the clinical operators (FIXTURES.md §3)."""
from datetime import datetime as dt, timedelta as td

from pyspark.sql import functions as F

from chartgrid.plans.gcs import gcs_score

T0 = dt(2024, 1, 1, 0, 0)


def _by_time(spark, rows):
    schema = ("icustay_id long, intime timestamp_ntz, charttime timestamp_ntz, gcsmotor double, "
              "gcsverbal double, gcseyes double, endotrachflag int")
    full = [(s, T0, T0 + td(hours=h), m, v, e, 1 if v == 0 else 0) for s, h, m, v, e in rows]
    return spark.createDataFrame(full, schema)


def test_gcs_total_rules(spark):
    rows = [
        (1, 1, 6.0, 0.0, 4.0),       # verbal 0 now -> 15
        (2, 1, 5.0, 0.0, 3.0),       # previous verbal 0 ...
        (2, 2, None, None, 2.0),     # ... and verbal NULL now -> 15
        (3, 1, 5.0, 0.0, 3.0),       # previous verbal 0 ...
        (3, 2, None, 3.0, 2.0),      # ... verbal 3 now -> own + defaults: 6 + 3 + 2
        (4, 1, 4.0, 3.0, 2.0),       # previous within 6 h ...
        (4, 5, None, None, 1.0),     # ... carried: 4 + 3 + 1
        (5, 1, 4.0, 3.0, 2.0),       # previous exactly 6 h old ...
        (5, 7, 5.0, None, None),     # ... not carried: 5 + 5 + 4
        (6, 1, None, None, None),    # nothing at all -> 6 + 5 + 4
    ]
    out = {(r["icustay_id"], r["hr"]): (r["gcs"], r["components_measured"])
           for r in gcs_score(_by_time(spark, rows)).collect()}
    assert out[(1, 1)][0] == 15
    assert out[(2, 2)][0] == 15
    assert out[(3, 2)][0] == 11
    assert out[(4, 5)] == (8, 3)            # components counted after the carry
    assert out[(5, 7)] == (14, 1)
    assert out[(6, 1)] == (15, 0)


def test_fio2_row_filter_drops_100(spark):
    from chartgrid.plans.bloodgas import fio2_charted
    rows = [(1, T0, 3420, 100.0, 0), (1, T0 + td(hours=1), 3420, 99.0, 0),
            (1, T0 + td(hours=2), 3420, 50.0, None)]
    ce = spark.createDataFrame(rows, "hadm_id long, charttime timestamp_ntz, itemid int, valuenum double, error int")
    got = [r["fio2_chartevents"] for r in fio2_charted(ce).collect()]
    assert got == [99.0]          # 100 fails the (0, 100) row filter, NULL error is dropped


def test_specimen_threshold_is_strict(spark):
    from chartgrid.plans import concepts as K
    assert K.SPECIMEN_THRESHOLD == 0.75
    df = spark.createDataFrame([(0.75,), (0.7500001,)], "p double")
    kept = df.where(F.col("p") > K.SPECIMEN_THRESHOLD).count()
    assert kept == 1


def test_csv_nan_and_empty_are_missing(spark, tmp_path):
    from pyspark.sql import types as T
    from chartgrid.sources.io import read_csv
    p = tmp_path / "m.csv"
    p.write_text("id,x\n1,NaN\n2,\n3,2.5\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType())])
    got = {r["id"]: r["x"] for r in read_csv(spark, str(p), schema=schema).collect()}
    assert got == {1: None, 2: None, 3: 2.5}
