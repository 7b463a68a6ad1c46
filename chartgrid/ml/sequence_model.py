"""Sequence classifier on fixed-length windows (M22, M23).

The windows (entity, start, seq[L][F], label) are flattened to one vector,
standardised and fed to a multilayer perceptron trained by Spark ML, so the
training data stays partitioned across executors (no driver-side arrays).
Windows are written to the shared checkpoint folder first: on a lazy plan
Catalyst may push later predicates below the window filter.
"""
from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.io import materialise


def _keys(entity) -> list[str]:
    return [entity] if isinstance(entity, str) else list(entity)


def to_vectors(windows: DataFrame, entity) -> DataFrame:
    return windows.select(*_keys(entity), "start", F.col("label").cast("double").alias("label"),
                          array_to_vector(F.flatten("seq")).alias("raw"))


def fit_sequence_classifier(train_windows: DataFrame, entity, n_steps: int, n_features: int,
                            hidden: int = 32, max_iter: int = 50, seed: int = 0):
    tr = materialise(to_vectors(train_windows, entity), "seq_train")
    mlp = MultilayerPerceptronClassifier(featuresCol="features", labelCol="label",
                                         layers=[n_steps * n_features, hidden, 2],
                                         maxIter=max_iter, seed=seed, blockSize=128)
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    return Pipeline(stages=[scaler, mlp]).fit(tr)


def score_windows(model, windows: DataFrame, entity) -> DataFrame:
    te = materialise(to_vectors(windows, entity), "seq_test")
    return model.transform(te).select(*_keys(entity), "start", "label", "prediction",
                                      vector_to_array("probability")[1].alias("p1"))
