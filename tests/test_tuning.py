"""Stratified folds, forest search and staged boosting."""
from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from chartgrid.ml import trees
from chartgrid.operators.sample import hash_split, mixed_hash, stratified_folds


@pytest.mark.parametrize("stride", [1, 2, 5, 10, 1000])
def test_folds_are_exact_for_ids_in_any_stride(spark, stride):
    df = spark.range(203).select((F.col("id") * stride).alias("id"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    rows = stratified_folds(df.repartition(5), "id", "y", 5).collect()
    for part in (rows, [r for r in rows if r.y == 1], [r for r in rows if r.y == 0]):
        sizes = Counter(r.fold for r in part)
        assert set(sizes) == set(range(5)) and max(sizes.values()) - min(sizes.values()) <= 1
    again = {r.id: r.fold for r in stratified_folds(df.coalesce(1), "id", "y", 5).collect()}
    assert again == {r.id: r.fold for r in rows}


def test_folds_of_repeated_and_null_rows(spark):
    df = spark.createDataFrame([(1, 0)] * 6 + [(None, 1), (None, None), (2, 1)], "id long, y int")
    rows = stratified_folds(df, "id", "y", 3).collect()
    assert sorted(Counter(r.fold for r in rows).values()) == [3, 3, 3]
    assert stratified_folds(df.limit(0), "id", "y", 3).count() == 0


@pytest.mark.parametrize("stride", [1, 10, 1000, 1 << 33])
def test_split_is_even_for_ids_in_any_stride(spark, stride):
    df = spark.range(4000).select((F.col("id") * stride).alias("id"))
    share = hash_split(df, "id", 0.8).filter("split = 'train'").count() / 4000
    assert 0.77 < share < 0.83
    assert df.select(mixed_hash("id").alias("h")).distinct().count() > 3990


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i * 10, float(i % 3 == 0), Vectors.dense([(i * 37 % 101) / 101 + (i % 3 == 0) * 0.4, i % 5, (i * 13 % 7) / 7]))
            for i in range(120)]
    return spark.createDataFrame(rows, ["icustay_id", "label", "features"]).repartition(3).cache()


def test_forest_search_runs_on_strided_ids(labelled):
    est = trees.random_forest(3)
    found = trees.cross_validate(est, trees.rf_grid(est, trees=(2, 4), depth=(2,), bins=(10,)), labelled, folds=5)
    assert len(found.avgMetrics) == 2 and all(m > 0.6 for m in found.avgMetrics)
    assert trees.best_params(found)["numTrees"] in (2, 4)


@pytest.mark.parametrize("subsample", [1.0, 0.8])
def test_a_prefix_of_the_boosting_equals_a_shorter_fit(labelled, subsample):
    options = dict(maxDepth=2, stepSize=0.1, subsamplingRate=subsample)
    staged = trees.staged_models(trees.gbt(5, **options).fit(labelled), (2, 5, 9))
    assert sorted(staged) == [2, 5]
    for rounds, model in staged.items():
        own = trees.scored(trees.gbt(rounds, **options).fit(labelled), labelled)
        assert sorted(map(tuple, trees.scored(model, labelled).collect())) == sorted(map(tuple, own.collect()))


def test_boosted_grid_by_prefixes(labelled):
    points = trees.tune_boosted(labelled, rounds=(1, 3), step=(0.1, 0.3), depth=(2,), min_inst=(1,), subsample=(1.0,), folds=2)
    assert len(points) == 4 and points == sorted(points, key=lambda p: -p["auc"])
    est = trees.gbt(3, stepSize=0.3, maxDepth=2)
    one = trees.cross_validate(est, [{}], labelled, folds=2)
    (same,) = [p["auc"] for p in points if p["maxIter"] == 3 and p["stepSize"] == 0.3]
    assert abs(one.avgMetrics[0] - same) < 1e-9
