"""Assignment of events to intervals against brute force."""
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chartgrid.operators.intervals import assign_intervals

T0 = datetime(2020, 1, 1)
EVENTS, STAYS = "k int, at timestamp, e int", "k int, s timestamp, t timestamp, i int"


def run(spark, events, stays, **more):
    out = assign_intervals(spark.createDataFrame(events, EVENTS), spark.createDataFrame(stays, STAYS), ["k"], "at", "s", "t", **more)
    assert out.columns == ["k", "at", "e", "s", "t", "i"]
    return sorted((r.e, r.i) for r in out.collect())


def brute(events, stays):
    return sorted((e, i) for k, at, e in events for q, s, t, i in stays
                  if k is not None and k == q and None not in (at, s, t) and s <= at < t)


@pytest.mark.parametrize("base", [1, 60, 3600])
def test_equal_to_brute_force(spark, base):
    rnd = random.Random(base)
    moment = lambda: T0 + timedelta(seconds=rnd.choice([0, 3600, 7200, rnd.randrange(90_000)]), microseconds=rnd.choice([0, 1]))
    long = lambda: timedelta(seconds=rnd.choice([0, 0, 1, 3600, 40_000, -5, 10**8 // 50]))
    stays = []
    for i in range(60):
        s = moment()
        stays.append((rnd.choice([None, 1, 2, 3]), s, s + long(), i))
    stays += [(1, None, T0, 100), (1, T0, None, 101), stays[5], (1, datetime(1950, 1, 1), datetime(2100, 1, 1), 102)]
    events = [(rnd.choice([None, 1, 2, 4]), rnd.choice([None, moment(), moment(), stays[3][1], stays[4][2]]), e) for e in range(150)]
    events += [events[7], (1, datetime(1960, 5, 5, 0, 0, 1), 900)]
    want = brute(events, stays)
    assert run(spark, events, stays, base=base) == want and len(want) > 100


def test_touching_and_empty_tables(spark):
    h = lambda n: T0 + timedelta(hours=n)
    stays = [(1, h(0), h(1), 0), (1, h(1), h(2), 1), (1, h(1), h(1), 2)]
    assert run(spark, [(1, h(1), 7), (1, h(2), 8)], stays) == [(7, 1)]
    assert run(spark, [], stays) == [] and run(spark, [(1, h(1), 7)], []) == []
    with pytest.raises(ValueError):
        run(spark, [(1, h(1), 7)], stays, base=1) and assign_intervals(
            spark.createDataFrame([], EVENTS), spark.createDataFrame([], "k int, s timestamp, t timestamp, e int"), ["k"], "at", "s", "t")


def test_a_key_with_many_intervals_does_not_pair_everything(spark):
    """2,000 intervals and 50,000 events of one key: 10^8 pairs by key, here those of equal buckets."""
    stays = spark.range(2000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 3600).alias("s"),
                                     F.timestamp_seconds(F.col("id") * 3600 + 1800).alias("t"), F.col("id").alias("i"))
    events = spark.range(50_000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 144).alias("at"), F.col("id").alias("e"))
    out = assign_intervals(events, stays, ["k"], "at", "s", "t")
    assert out.count() == sum(1 for e in range(50_000) if e * 144 % 3600 < 1800)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__bucket" in plan.split("Join Inner")[1].split("\n")[0]
