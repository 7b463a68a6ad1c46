"""Plan-shape and skew checks: pushdown/pruning reach the scan, the look-back
spreads a burst, a hot key gives exact results, lineage cuts use the
shared checkpoint folder."""
import random
from datetime import datetime as dt, timedelta as td

import pytest
from pyspark.sql import functions as F

from chartgrid.operators import scan
from chartgrid.operators.asof import asof_lookback, asof_self
from chartgrid.operators.rank import best_per_group
from chartgrid.sources.io import materialise
from chartgrid.sources.tables import read_table
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_filter_and_columns_reach_the_scan(spark):
    li = read_table(spark, SF_SMALL, "lineitem", ["l_orderkey", "l_discount", "l_quantity"])
    q = li.where((F.col("l_discount") > 0.02) & F.col("l_quantity").between(10, 20))
    plan = _plan(q)
    assert "GreaterThan(l_discount,0.02)" in plan and "GreaterThanOrEqual(l_quantity,10.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_discount:double>" in plan


@pytest.fixture
def many_ranges(spark):
    """Ranges are not joined up again, as on tables above the advisory size."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_burst_of_one_key_is_spread(spark, many_ranges):
    # one key, one second: 10^6 rows inside any tolerance
    burst = spark.range(1_000_000).select(F.lit(1).alias("k"), F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, (id % 1000000) / 1000000)").alias("t"), "id")
    sizes = [r["count"] for r in scan.ranged(burst, ["k", "t"]).groupBy("__range").count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 2 * 1_000_000 / len(sizes)
    plan = _plan(asof_self(burst.limit(1000), ["k"], "t", ["id"], 3600, include_current=False))
    # one window over (key, range), one over a row per range; only that row is broadcast
    assert plan.count("BroadcastHashJoin LeftOuter") >= 1 and "[k#" in plan and "__range#" in plan
    got = asof_self(burst, ["k"], "t", ["id"], 3600, include_current=False)
    wrong = got.where(~F.col("prev_id").eqNullSafe(F.when(F.col("id") > 0, F.col("id") - 1)))
    assert got.count() == 1_000_000 and wrong.count() == 0


@pytest.mark.parametrize("current", [True, False])
def test_scan_over_borders_equals_brute_force(spark, many_ranges, current):
    rnd = random.Random(11)
    base = dt(2024, 1, 1)
    rows = [(rnd.choice([None, 1, 1, 1, 1, 2, 3]), None if rnd.random() < 0.05 else base + td(seconds=rnd.randint(0, 60)),
             rnd.choice([None, 1.0, 2.0, 3.0]), i) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, v double, id long")
    got = {r["id"]: (r["prev_v"], r["at"]) for r in asof_self(
        df, ["k"], "t", ["v"], 20, include_lower=False, include_current=current, match_time_col="at").collect()}
    assert len(got) == len(rows)
    for k, t, _, i in rows:
        near = [(rt, rv is not None, rv) for rk, rt, rv, _ in rows if k is not None and rk == k and None not in (t, rt)
                and t - td(seconds=20) < rt and (rt <= t if current else rt < t)]
        want = max(near, key=lambda n: (n[0], n[1], n[2] or 0)) if near else (None, None, None)
        assert got[i] == (want[2], want[0]), (k, t, i)
    other = asof_lookback(df, df.select("k", "t", "v"), ["k"], "t", "t", ["v"], 20, include_lower=False,
                          include_current=current, prefix="prev_", match_time_col="at")
    assert {r["id"]: (r["prev_v"], r["at"]) for r in other.collect()} == got
    assert asof_self(df.limit(0), ["k"], "t", ["v"], 20).count() == 0


def test_hot_key_asof_is_exact(spark):
    rnd = random.Random(7)
    base = dt(2024, 1, 1)
    # key 1 holds most rows, spread over many tolerance buckets
    L = [(1 if rnd.random() < 0.8 else rnd.randint(2, 5), base + td(seconds=rnd.randint(0, 200000)), i)
         for i in range(1500)]
    R = {}
    for _ in range(1500):
        k = 1 if rnd.random() < 0.8 else rnd.randint(2, 5)
        R[(k, base + td(seconds=rnd.randint(0, 200000)))] = rnd.random()
    left = spark.createDataFrame(L, "k long, t timestamp_ntz, id long")
    right = spark.createDataFrame([(k, t, v) for (k, t), v in R.items()], "k long, t timestamp_ntz, v double")
    got = {r["id"]: r["v"] for r in asof_lookback(left, right, ["k"], "t", "t", ["v"], 900).collect()}
    by_key = {}
    for (k, t), v in R.items():
        by_key.setdefault(k, []).append((t, v))
    for k, t, i in L:
        c = [(rt, v) for rt, v in by_key.get(k, []) if t - td(seconds=900) <= rt <= t]
        assert got[i] == (max(c)[1] if c else None)


def test_hot_group_best_row_uses_partial_aggregate(spark):
    df = spark.range(20000).select((F.col("id") % 3 == 0).cast("int").alias("g"),
                                   F.col("id").alias("v"))
    b = best_per_group(df, ["g"], [("v", False)])
    plan = _plan(b)
    assert "partial_min_by" in plan
    assert {r["g"]: r["v"] for r in b.collect()} == {0: 19999, 1: 19998}


def test_materialise_uses_checkpoint_dir(spark):
    d = spark.conf.get("spark.checkpoint.dir")
    out = materialise(spark.range(10).withColumn("x", F.col("id") * 2), "t")
    files = out.inputFiles()
    assert files and all(d.rstrip("/") in f for f in files)
    assert out.count() == 10


def test_positions_split_hot_groups_exactly(spark):
    import pandas as pd
    from chartgrid.operators.rank import ordinal_skew_safe
    rnd = random.Random(5)
    rows = [(1 if rnd.random() < 0.7 else rnd.randint(2, 6), float(rnd.randint(0, 400)), i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "g long, t double, id long")
    got = {r["id"]: r["ordinal"] for r in
           ordinal_skew_safe(df, ["g"], "t", ["id"]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "t", "id"]).sort_values(["g", "t", "id"])
    pdf["want"] = pdf.groupby("g").cumcount() + 1
    assert all(got[i] == w for i, w in zip(pdf["id"], pdf["want"]))


def test_skew_safe_windows_match_plain(spark):
    from chartgrid.operators.sequence import sliding_windows, sliding_windows_skew_safe
    rows = [(e, h, float(h * 10 + e), h % 2) for e, n in ((1, 700), (2, 30), (3, 24)) for h in range(n)]
    df = spark.createDataFrame(rows, "e long, hr long, x double, y int")
    a = sliding_windows(df, "e", "hr", ["x"], "y", 24)
    b = sliding_windows_skew_safe(df, "e", "hr", ["x"], "y", 24, block=50)
    key = lambda r: (r["e"], r["start"])
    ra = sorted(((r["e"], r["start"], tuple(map(tuple, r["seq"])), r["label"]) for r in a.collect()))
    rb = sorted(((r["e"], r["start"], tuple(map(tuple, r["seq"])), r["label"]) for r in b.collect()))
    assert ra == rb and len(ra) == 676 + 6
