"""Tree models, tuning and importances on the per-stay matrix (M6-M15)."""
from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark import SparkContext, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sample import split_sides, stratified_folds
from ..sources.io import materialise
from .features import CATEGORICAL, feature_pipeline, numeric_columns, prepare_matrix, without_values


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    model: object          # fitted feature PipelineModel
    numeric: list


def prepare(matrix: DataFrame, train_fraction: float = 0.8, seed: int = 0) -> Prepared:
    """Split by a portable hash of the stay id (partition-independent, unlike
    ``randomSplit``), fit the feature pipeline on the training side only and
    transform both sides.  Transformed training rows are persisted because
    every fit of a tuning grid re-reads them."""
    # the feature fit, the imputer and every model fit re-read the matrix:
    # write it once to the shared checkpoint folder (lineage cut, survives
    # executor loss) instead of recomputing the whole feature chain
    df = materialise(prepare_matrix(matrix), "matrix")
    tr, te = split_sides(df, "icustay_id", train_fraction, seed)
    num = numeric_columns(df)
    # a column that the training side knows nothing about is 0 throughout: it
    # keeps its place in the feature vector, whatever the data
    unknown = {c: F.lit(0.0) for c in without_values(tr, num)}
    tr, te = tr.withColumns(unknown), te.withColumns(unknown)
    cats = [c for c in CATEGORICAL if c in df.columns]
    pm = feature_pipeline(cats, num).fit(tr)
    keep = ["icustay_id", "label", "features"]
    train = pm.transform(tr).select(*keep).persist(StorageLevel.MEMORY_AND_DISK)
    test = pm.transform(te).select(*keep)
    return Prepared(train, test, pm, num)


def scored(model, df: DataFrame) -> DataFrame:
    """(icustay_id, label, prediction, p1) with p1 = P(class 1)."""
    return model.transform(df).select("icustay_id", "label", "prediction",
                                      vector_to_array("probability")[1].alias("p1"))


def evaluator() -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction",
                                         metricName="areaUnderROC")


def random_forest(num_trees: int = 10, seed: int = 0, **kw) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=num_trees,
                                  seed=seed, **kw)


def gbt(max_iter: int = 250, seed: int = 0, **kw) -> GBTClassifier:
    return GBTClassifier(labelCol="label", featuresCol="features", maxIter=max_iter, seed=seed, **kw)


def rf_grid(est: RandomForestClassifier, trees=(5, 10, 20), depth=(5, 10, 20), bins=(10, 32)):
    return (ParamGridBuilder().addGrid(est.numTrees, list(trees)).addGrid(est.maxDepth, list(depth))
            .addGrid(est.maxBins, list(bins)).build())


def gbt_grid(est: GBTClassifier, iters=(20, 100, 250), step=(0.1, 0.03, 0.01), depth=(5, 10),
             min_inst=(1, 3, 5), subsample=(1.0, 0.8)):
    return (ParamGridBuilder().addGrid(est.maxIter, list(iters)).addGrid(est.stepSize, list(step))
            .addGrid(est.maxDepth, list(depth)).addGrid(est.minInstancesPerNode, list(min_inst))
            .addGrid(est.subsamplingRate, list(subsample)).build())


def cross_validate(est, grid, train: DataFrame, folds: int = 5, parallelism: int = 4, seed: int = 0,
                   id_col: str = "icustay_id"):
    """k-fold CV selecting by AUC over stratified exact folds of the ids (``foldCol``),
    which do not depend on partitioning."""
    tr = materialise(stratified_folds(train, id_col, "label", folds, seed), "cv_folds")
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=evaluator(),
                        numFolds=folds, foldCol="fold", parallelism=parallelism, seed=seed)
    return cv.fit(tr)


def staged_models(model: GBTClassificationModel, rounds) -> dict:
    """The model cut after each number of boosting rounds: boosting adds trees one by
    one, so a prefix equals a fit with that ``maxIter`` (same data and seed)."""
    sc = SparkContext._active_spark_context
    trees, weights = model._java_obj.trees(), model._java_obj.treeWeights()
    kind, out = sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, {}
    for n in sorted({min(n, len(weights)) for n in rounds}):
        some, of = sc._gateway.new_array(kind, n), sc._gateway.new_array(sc._jvm.double, n)
        for i in range(n):
            some[i], of[i] = trees[i], weights[i]
        java = sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{model.uid}_{n}", some, of)
        out[n] = GBTClassificationModel(java.setFeaturesCol(model.getFeaturesCol()))
    return out


def tune_boosted(train: DataFrame, rounds=(20, 100, 250), step=(0.1, 0.03, 0.01), depth=(5, 10), min_inst=(1, 3, 5),
                 subsample=(1.0, 0.8), folds: int = 5, seed: int = 0, id_col: str = "icustay_id") -> list[dict]:
    """Every point of the boosted grid with its mean AUC over stratified folds, best first.

    Points that differ in ``maxIter`` only share one fit of the most rounds, scored at its
    prefixes: 36 fits a fold stand for the published 108 points."""
    tr = materialise(stratified_folds(train, id_col, "label", folds, seed), "boosted_folds")
    total: dict[tuple, float] = {}
    for fold in range(folds):
        fit_on, valid = tr.where(F.col("fold") != fold), tr.where(F.col("fold") == fold)
        for point in product(step, depth, min_inst, subsample):
            most = gbt(max(rounds), seed, stepSize=point[0], maxDepth=point[1], minInstancesPerNode=point[2],
                       subsamplingRate=point[3]).fit(fit_on)
            for n, model in staged_models(most, rounds).items():
                total[n, *point] = total.get((n, *point), 0.0) + evaluator().evaluate(model.transform(valid)) / folds
    names = ("maxIter", "stepSize", "maxDepth", "minInstancesPerNode", "subsamplingRate")
    return [dict(zip(names, point)) | {"auc": auc} for point, auc in sorted(total.items(), key=lambda x: (-x[1], x[0]))]


def best_params(cv_model) -> dict:
    best = cv_model.bestModel
    out = {}
    for p in best.extractParamMap():
        if p.name in ("numTrees", "maxDepth", "maxBins", "maxIter", "stepSize",
                      "minInstancesPerNode", "subsamplingRate"):
            out[p.name] = best.getOrDefault(p)
    return out


def feature_importance(model, transformed: DataFrame, top: int = 20):
    """(feature, importance) rows with non-zero importance, ``top`` largest,
    ascending — names come from the assembled vector's ML attribute metadata."""
    meta = transformed.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    names = {}
    for group in meta.values():
        for a in group:
            names[a["idx"]] = a["name"]
    imp = model.featureImportances
    rows = [(names.get(int(i), f"f{int(i)}"), float(v)) for i, v in zip(imp.indices, imp.values)
            if v > 0]
    rows = sorted(rows, key=lambda r: (-r[1], r[0]))[:top]
    return sorted(rows, key=lambda r: (r[1], r[0]))
