"""The hourly table is planned over stored sides, so its plan does not hold the plans
of the cohort and of every side."""
from pyspark.sql import functions as F

from chartgrid.catalog.common import rounded
from chartgrid.plans.assemble import IcuPipeline
from chartgrid.sources.fixtures import (DerivedSources, admissions, chartevents, icustays, labevents, outputevents,
                                        patients)


def _sources(spark, n=2000):
    ev = spark.range(n).select(
        F.col("id").alias("event_id"), (F.col("id") % 50).alias("user_id"),
        (F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), (F.col("id") % 700).cast("int"))).alias("ts"),
        (F.col("id") % 90).cast("double").alias("value"))
    cu = spark.range(50).select(F.col("id").alias("c_custkey"), F.lit("x").alias("c_mktsegment"))
    return DerivedSources(chartevents(ev), labevents(ev), outputevents(ev), icustays(ev), admissions(cu), patients(cu), ev)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_wide_table_is_planned_over_stored_sides(spark):
    p = IcuPipeline(_sources(spark))
    hourly, matrix = p.hourly(), p.matrix(24)
    for df in (p.cohort, hourly, matrix, p.sequences(24)):
        assert "InMemoryTableScan" not in _plan(df) and "Range (" not in _plan(df)
    assert _plan(hourly).count("Exchange") <= 2         # the grid's cohort is read from its files
    assert _plan(matrix).count("Exchange") <= 4
    assert matrix.count() > 0


def test_stored_sides_give_the_rows_of_one_plan(spark):
    src = _sources(spark, 1200)
    stored = rounded(IcuPipeline(src).hourly())
    whole = rounded(IcuPipeline(src, persist=False).hourly())
    assert stored.schema.names == whole.schema.names
    assert [f.dataType for f in stored.schema] == [f.dataType for f in whole.schema]
    got, want = (sorted(map(repr, df.collect())) for df in (stored, whole))
    assert got == want and len(got) > 0


def test_a_side_is_stored_once(spark):
    p = IcuPipeline(_sources(spark, 500))
    assert p._side("uo") is p._side("uo")
