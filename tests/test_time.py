from datetime import datetime as dt

from pyspark.sql import functions as F

from chartgrid.functions.time import ceil_hour, day_diff, hour_diff, second_diff


def _ntz(spark, rows, cols):
    df = spark.createDataFrame(rows, cols)
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in cols])


def test_hour_diff_counts_boundaries(spark):
    rows = [(dt(2024, 1, 1, 9, 30), dt(2024, 1, 1, 10, 0)),
            (dt(2024, 1, 1, 11, 10), dt(2024, 1, 1, 10, 50)),
            (dt(2024, 1, 1, 10, 0), dt(2024, 1, 1, 10, 0)),
            (None, dt(2024, 1, 1, 10, 0))]
    df = _ntz(spark, rows, ["a", "b"])
    got = [r[0] for r in df.select(hour_diff("a", "b")).collect()]
    assert got == [-1, 1, 0, None]


def test_ceil_hour(spark):
    rows = [(dt(2024, 1, 1, 10, 0, 0),), (dt(2024, 1, 1, 10, 0, 30),), (dt(2024, 1, 1, 10, 1, 0),)]
    df = _ntz(spark, rows, ["t"])
    got = [r[0].hour for r in df.select(ceil_hour("t")).collect()]
    assert got == [10, 10, 11]


def test_day_and_second_diff(spark):
    df = _ntz(spark, [(dt(2024, 1, 2, 0, 0, 1), dt(2024, 1, 1, 23, 59, 59))], ["a", "b"])
    r = df.select(day_diff("a", "b"), second_diff("a", "b")).first()
    assert (r[0], r[1]) == (1, 2)
