"""Order proofs and roll-ups over several spans."""
import random

import pytest
from pyspark.sql import functions as F

from chartgrid.operators.ordering import ordering, rolling_hash
from chartgrid.operators.rollup import banded_rollup, stats_rollup


def in_parts(spark, rows, schema, parts):
    """The rows in this sequence over so many partitions."""
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), schema)


def proof(df, order=(("a", True), ("b", False))):
    (r,) = ordering(df, list(order)).collect()
    return r.n_rows, r.in_order, r.sequence_hash


def test_swapped_rows_are_seen_in_any_partitioning(spark):
    rnd = random.Random(2)
    rows = sorted(((rnd.choice([None, 1, 2, 3]), rnd.choice([None, 5, 6, 7]), i) for i in range(60)),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is None, -(r[1] or 0), r[2]))
    schema = "a int, b int, id int"
    seen = {proof(in_parts(spark, rows, schema, parts)) for parts in (1, 3, 7, 60)}
    assert len(seen) == 1 and next(iter(seen))[:2] == (60, True)
    for at in (0, 19, 20, 29, 58):
        other = rows.copy()
        other[at], other[at + 1] = other[at + 1], other[at]
        for parts in (1, 3):
            n, good, h = proof(in_parts(spark, other, schema, parts))
            assert h != next(iter(seen))[2]
            if rows[at][:2] != rows[at + 1][:2]:
                assert not good


def test_order_of_an_empty_result(spark):
    assert proof(spark.createDataFrame([], "a int, b int")) == (0, True, 0)
    assert rolling_hash([1, 2]) != rolling_hash([2, 1])


def test_sorted_table_is_in_order_over_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 1000).alias("a"), F.col("id").alias("b")).repartition(6)
    done = df.orderBy("a", F.desc("b"))
    assert proof(done)[:2] == (5000, True) and done.rdd.getNumPartitions() >= 1
    assert not proof(df)[1]


@pytest.mark.parametrize("spans", [(6, 12, 24, 48), (3,), (0, 100)])
def test_spans_equal_one_rollup_each(spark, spans):
    rnd = random.Random(4)
    rows = [(e, rnd.choice([None, *range(-3, 60)]), rnd.choice([None, rnd.random()]), rnd.choice([None, rnd.randint(0, 9)]))
            for e in range(12) for _ in range(rnd.choice([1, 5, 40]))]
    df = spark.createDataFrame(rows, "e long, hr int, bg_x double, y int")
    stats = {"mean": ["bg_x", "y"], "min": ["bg_x"], "max": ["y", "bg_x"]}
    got = banded_rollup(df, ["e"], "hr", spans, stats, sums=["y"], rename={"bg_x": "x"})
    for s in spans:
        own = stats_rollup(df.where(F.col("hr").between(0, s)), ["e"], stats, sums=["y"], rename={"bg_x": "x"})
        cols = sorted(own.columns)
        near = lambda r: tuple(None if v is None else round(v, 9) for v in r)
        assert sorted(map(near, got.where(F.col("hours") == s).select(cols).collect()), key=str) == \
            sorted(map(near, own.select(cols).collect()), key=str)
