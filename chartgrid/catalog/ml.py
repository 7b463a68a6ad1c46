"""Rows-only keys for the model layer (training is not SQL-expressible), at the
published sizes: the 24-hour matrix, the 18-point forest grid over 5 folds, 250
boosting rounds.  (The 108-point boosted grid is ``trees.gbt_grid``; no key runs
it.)"""
from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..ml import trees
from ..ml.recurrent import fit_recurrent, score_recurrent
from ..ml.sequence_model import fit_sequence_classifier, score_windows
from ..plans.assemble import IcuPipeline
from ..sources.fixtures import icu_sources
from .seq import PREP, series


def _matrix(spark, sf, hours: int = 24):
    return IcuPipeline(icu_sources(spark, sf)).matrix(hours)


def q_ml_features(spark, sf):
    p = trees.prepare(_matrix(spark, sf))
    sides = p.train.withColumn("split", F.lit("train")).unionByName(p.test.withColumn("split", F.lit("test")))
    return sides.select("icustay_id", "label", "split", vector_to_array("features").alias("features"))


def q_rf_fit(spark, sf):
    p = trees.prepare(_matrix(spark, sf))
    return trees.scored(trees.random_forest(10).fit(p.train), p.test)


def q_gbt_fit(spark, sf):
    p = trees.prepare(_matrix(spark, sf))
    return trees.scored(trees.gbt().fit(p.train), p.test)


def q_cv_tune(spark, sf):
    p = trees.prepare(_matrix(spark, sf))
    est = trees.random_forest()
    cv = trees.cross_validate(est, trees.rf_grid(est), p.train)
    best = trees.best_params(cv)
    test_auc = trees.evaluator().evaluate(cv.bestModel.transform(p.test))
    rows = [(k, float(v)) for k, v in sorted(best.items())] + [("test_auc", float(test_auc))]
    return spark.createDataFrame(rows, "name string, value double")


def q_feature_importance(spark, sf):
    p = trees.prepare(_matrix(spark, sf))
    rows = trees.feature_importance(trees.gbt().fit(p.train), p.train)
    return spark.createDataFrame(rows, "feature string, importance double")


def q_sequence_classifier(spark, sf):
    keys = ["user_id", "copy"]
    w = PREP.split_windows(PREP.split(PREP.imputed(series(spark, sf))))
    model = fit_sequence_classifier(w.where("split = 'train'"), keys, PREP.length, len(PREP.features), max_iter=30)
    return score_windows(model, w.where("split = 'test'"), keys)


def q_sequence_recurrent(spark, sf):
    b = PREP.split_blocks(PREP.split(PREP.imputed(series(spark, sf))))
    model = fit_recurrent(b.where("split = 'train'"), len(PREP.features), PREP.length, PREP.block)
    return score_recurrent(model, b.where("split = 'test'"), ["user_id", "copy"])


QUERIES = {
    "ml_features": q_ml_features,
    "rf_fit": q_rf_fit,
    "gbt_fit": q_gbt_fit,
    "cv_tune": q_cv_tune,
    "feature_importance": q_feature_importance,
    "sequence_classifier": q_sequence_classifier,
    "sequence_recurrent": q_sequence_recurrent,
}
