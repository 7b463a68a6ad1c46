"""Hourly vitals fed in several micro-batches equal one batch over all rows."""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chartgrid.plans import concepts as K
from chartgrid.plans.vitals import vitals
from chartgrid.streaming.hourly import HourlyPartials, stream_hourly_vitals

T0 = datetime(2020, 1, 1)
CHART = "icustay_id long, charttime timestamp, itemid int, valuenum double, error int"


@pytest.fixture(scope="module")
def rows(spark):
    codes = [c.codes[0] for c in K.VITALS]
    out = [(s, T0 + timedelta(minutes=17 * i), codes[(s + i) % len(codes)], 40.0 + (i * 13 + s) % 60, i % 11 == 5)
           for s in range(1, 6) for i in range(90)]
    out += [(1, T0, codes[0], None, 0), (None, T0, codes[0], 80.0, 0), (2, T0, codes[0], 80.0, None)]
    return [(s, t, c, v, None if e is None else int(e)) for s, t, c, v, e in out]


def by_hour(df):
    names = [c.name for c in K.VITALS]
    return {(r.icustay_id, r.hr): [None if r[n] is None else round(r[n], 9) for n in names] for r in df.collect()}


def test_several_files_and_a_replayed_batch(spark, rows, tmp_path):
    kept = spark.createDataFrame([(s, T0 - timedelta(hours=s)) for s in range(1, 5)], "icustay_id long, intime timestamp")
    inbox, out, marks = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    frame = spark.createDataFrame(rows, CHART)

    def feed(part):         # every hour's rows lie in all files, later ones are late
        picked = [r for i, r in enumerate(rows) if i % 4 == part]
        spark.createDataFrame(picked, CHART).coalesce(1).write.mode("append").parquet(inbox)

    def drain():
        stream = spark.readStream.schema(CHART).option("maxFilesPerTrigger", 1).parquet(inbox)
        stream_hourly_vitals(spark, stream, kept, out, marks).awaitTermination()

    for part in range(3):
        feed(part)
    drain()
    assert spark.read.parquet(out).select("batch").distinct().count() == 3
    feed(3)
    drain()                 # goes on from the checkpoint
    sink = HourlyPartials(out)
    assert spark.read.parquet(out).select("batch").distinct().count() == 4
    want = by_hour(vitals(frame, kept))
    assert by_hour(sink.merged(spark)) == want and len(want) > 90
    # a replayed batch replaces its own partials
    again = spark.createDataFrame([r for i, r in enumerate(rows) if i % 4 == 3], CHART)
    sink.write_batch(again, 3, kept)
    assert by_hour(sink.merged(spark)) == want


def test_partials_of_an_hour_are_spread_over_batches(spark, rows):
    hours = spark.createDataFrame(rows, CHART).where("icustay_id = 1").select(F.date_trunc("hour", "charttime").alias("h"))
    assert hours.groupBy("h").count().agg(F.max("count")).first()[0] >= 3
