"""Rows that a reader or an operator multiplies count in Spark's size estimates, so
the multiplied side is not broadcast through the driver."""
import datetime as dt

from pyspark.sql import functions as F

from chartgrid.operators.fanout import fan_out
from chartgrid.operators.intervals import assign_intervals
from chartgrid.plans import concepts as K
from chartgrid.plans.cohort import cohort
from chartgrid.plans.vitals import lab_codes
from chartgrid.sources.fixtures import (DerivedSources, admissions, chartevents, icustays, labevents, outputevents,
                                        patients)
from chartgrid.sources.tables import read_table


def _estimate(df) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _events(spark, n=2000):
    return spark.range(n).select(
        F.col("id").alias("event_id"), (F.col("id") % 50).alias("user_id"),
        (F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), (F.col("id") % 700).cast("int"))).alias("ts"),
        (F.col("id") % 90).cast("double").alias("value"))


def test_estimates_of_the_event_views_hold_their_rows(spark):
    ev = _events(spark)
    cu = spark.range(50).select(F.col("id").alias("c_custkey"), F.lit("x").alias("c_mktsegment"))
    src = DerivedSources(chartevents(ev), labevents(ev), outputevents(ev), icustays(ev), admissions(cu), patients(cu), ev)
    for df in (src.chart(K.VITAL_CODES), src.labs(lab_codes()), src.chartevents, src.labevents):
        assert _estimate(df) >= df.count() * 8 * len(df.columns)


def test_events_of_many_levels_are_estimated_with_their_copies(spark):
    t0 = dt.datetime(2024, 1, 1)
    hour = dt.timedelta(hours=1)
    events = spark.range(1000).select((F.col("id") % 5).alias("k"), F.lit(t0).cast("timestamp_ntz").alias("at"))
    spans = [(k, t0, t0 + (4 ** k) * hour) for k in range(5)]
    intervals = spark.createDataFrame(spans, "k long, start timestamp_ntz, end timestamp_ntz")
    out = assign_intervals(events, intervals, ["k"], "at", "start", "end")
    assert out.count() == 1000
    join = out._jdf.queryExecution().optimizedPlan()
    while join.children().size() == 1:
        join = join.children().head()
    copies = 5 * 1000 * 8 * 3                # 5 levels in use, a row of three columns at least
    assert int(str(join.left().stats().sizeInBytes())) >= copies


def test_fan_out_keeps_repeats_and_nulls_and_takes_an_empty_list(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "a int")
    got = fan_out(df, ["b"], [["7"], ["8"]]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, 7), (1, 8)] * 2 + [(None, 7), (None, 8)]))
    assert fan_out(df, ["b"], []).count() == 0


def test_scans_are_estimated_by_rows_not_by_compressed_files(spark, tmp_path):
    rows = 50_000
    (spark.range(rows).select(F.col("id").alias("c_custkey"), F.lit("BUILDING").alias("c_mktsegment"))
     .coalesce(1).write.parquet(str(tmp_path / "customer.parquet")))
    cu = read_table(spark, str(tmp_path), "customer", ["c_custkey", "c_mktsegment"])
    assert _estimate(cu.select("c_custkey")) >= rows * 8
    limit, name = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), "spark.sql.autoBroadcastJoinThreshold"
    try:
        spark.conf.set(name, rows * 8)
        joined = admissions(cu).select("hadm_id").join(patients(cu).select(F.col("subject_id").alias("hadm_id")), "hadm_id")
        assert "Broadcast" not in joined._jdf.queryExecution().sparkPlan().toString()
        assert joined.count() == rows
    finally:
        spark.conf.set(name, limit)


def test_the_cohort_broadcasts_no_side_that_grows_with_the_data(spark):
    ev = _events(spark)
    cu = spark.range(50).select(F.col("id").alias("c_custkey"), F.lit("x").alias("c_mktsegment"))
    src = DerivedSources(chartevents(ev), labevents(ev), outputevents(ev), icustays(ev), admissions(cu), patients(cu), ev)
    df = cohort(src)
    stays = df.count()
    assert stays > 0
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()        # as it ran, sizes measured
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
