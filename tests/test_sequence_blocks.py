"""Stored blocks of windows and the recurrent model on them."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from chartgrid.ml import recurrent as R
from chartgrid.ml.sequence_model import fit_sequence_classifier, score_windows
from chartgrid.operators.sequence import sliding_windows, window_blocks, windows_of_blocks

STEPS = 12


def marked_series(spark, n, seed):
    """Entities of STEPS + 1 rows: the label is the sign of the value at the one marked step."""
    rng = np.random.default_rng(seed)
    rows = []
    for e in range(n):
        v, at = rng.normal(size=STEPS + 1), int(rng.integers(0, STEPS))
        rows += [(e, t, float(v[t]), float(t == at), int(v[at] > 0)) for t in range(STEPS + 1)]
    return spark.createDataFrame(rows, "id long, t int, v double, mark double, label int")


def as_set(windows):
    return {(r.id, r.start, tuple(map(tuple, r.seq)), float(r.label)) for r in windows.collect()}


@pytest.mark.parametrize("block", [3, 4, 10, 480])
def test_blocks_hold_the_same_windows(spark, block):
    rng = np.random.default_rng(block)
    sizes = {None: 6, 1: 1, 2: 3, 3: 4, 4: 5, 5: 41}
    rows = [(e, t, float(rng.integers(9)), None if t % 5 == 1 else float(t), None if (t + n) % 7 == 6 else t % 2)
            for e, n in sizes.items() for t in range(n)]
    df = spark.createDataFrame(rows, "id long, t int, a double, b double, label int")
    blocks = window_blocks(df, "id", "t", ["a", "b"], "label", 3, block)
    assert as_set(windows_of_blocks(blocks, "id", 3, block)) == as_set(sliding_windows(df, "id", "t", ["a", "b"], "label", 3))
    assert len(as_set(windows_of_blocks(blocks, "id", 3, block))) > 30


def test_blocks_store_little_more_than_the_rows(spark):
    df = spark.range(20_000).select(F.lit(7).alias("id"), F.col("id").alias("t"), F.rand(1).alias("a"), F.lit(0).alias("label"))
    stored = window_blocks(df, "id", "t", ["a"], "label", 24)
    assert stored.agg(F.sum(F.size("rows"))).first()[0] <= 1.1 * 20_000
    assert stored.agg(F.max(F.size("rows"))).first()[0] <= 480 + 24


@pytest.mark.parametrize("dropout", [False, True])
def test_gradient_is_the_derivative(dropout):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(7, 5, 3)), rng.integers(0, 2, 7).astype(float)
    mask = rng.integers(0, 2, (7, 4)) * 2.0 if dropout else None
    w = R.start_weights(3, 4, 0) + 0.1
    numeric = [(R.gradient(x, y, w + e, 4, mask)[0] - R.gradient(x, y, w - e, 4, mask)[0]) / 2e-6
               for e in 1e-6 * np.eye(len(w))]
    assert np.allclose(R.gradient(x, y, w, 4, mask)[1], numeric, atol=1e-7)


def test_same_model_for_any_partitions(spark):
    blocks = window_blocks(marked_series(spark, 60, 3), "id", "t", ["v", "mark"], "label", STEPS)
    fits = [R.fit_recurrent(blocks.repartition(n), 2, STEPS, 480, hidden=4, steps=3) for n in (1, 8)]
    assert np.allclose(fits[0].weights, fits[1].weights, atol=1e-6)
    assert np.allclose(fits[0].losses, fits[1].losses, atol=1e-9)


def test_order_is_learned_better_than_by_the_flattened_perceptron(spark):
    features = ["v", "mark"]
    train, test = marked_series(spark, 500, 0), marked_series(spark, 400, 9)
    b_train, b_test = (window_blocks(d, "id", "t", features, "label", STEPS).coalesce(2) for d in (train, test))
    model = R.fit_recurrent(b_train, 2, STEPS, 480, hidden=8, steps=70, rate=0.1, dropout=0.0)
    right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    recurrent = R.score_recurrent(model, b_test, "id").agg(right).first()[0]
    w_train, w_test = (sliding_windows(d, "id", "t", features, "label", STEPS) for d in (train, test))
    flat = score_windows(fit_sequence_classifier(w_train, "id", STEPS, 2), w_test, "id").agg(right).first()[0]
    assert model.losses[-1] < 0.5 * model.losses[0]
    assert recurrent > 0.9 and recurrent > flat + 0.05, (recurrent, flat)


def test_missing_features_constant_features_and_no_windows(spark):
    rows = [(e, t, None if t == 2 else float("nan") if t == 3 else float(t), 5.0, e % 2) for e in range(8) for t in range(6)]
    df = spark.createDataFrame(rows, "id long, t int, a double, b double, label int")
    model = R.fit_recurrent(window_blocks(df, "id", "t", ["a", "b"], "label", 5), 2, 5, 480, hidden=2, steps=2)
    assert np.isfinite(model.weights).all() and model.scale[1] == 1.0
    scored = R.score_recurrent(model, window_blocks(df, "id", "t", ["a", "b"], "label", 5), "id").collect()
    assert {(r.id, r.start) for r in scored} == {(e, 0) for e in range(8)}
    short = window_blocks(df.where("t < 5"), "id", "t", ["a", "b"], "label", 5)
    none = R.fit_recurrent(short, 2, 5, 480, hidden=2, steps=2)
    assert none.losses == () and R.score_recurrent(none, short, "id").count() == 0
    empty = window_blocks(df.limit(0), "id", "t", ["a", "b"], "label", 5)
    assert R.fit_recurrent(empty, 2, 5, 480, hidden=2, steps=2).losses == ()
