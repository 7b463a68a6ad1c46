"""Metrics over the scores of a fitted model (rows-only keys: the scores come from
training; ``tests/test_model_metrics.py`` checks the operators against DuckDB over
the same written scores)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..ml import trees
from ..operators.metrics import auc, classification_report, confusion_matrix, decide, roc_points
from ..plans.assemble import IcuPipeline
from ..sources.fixtures import icu_sources
from ..sources.io import materialise


def scored_stays(spark, sf):
    """icustay_id, label, prediction, p1, decision of the test side, written once."""
    p = trees.prepare(IcuPipeline(icu_sources(spark, sf)).matrix(24))
    scores = trees.scored(trees.random_forest(10).fit(p.train), p.test)
    return materialise(scores.withColumn("decision", decide("p1")), "scores")


def q_model_roc(spark, sf):
    return roc_points(scored_stays(spark, sf), "p1", "label")


def q_model_report(spark, sf):
    """Report per class, confusion cells and AUC as (part, name, measure, value)."""
    s = scored_stays(spark, sf)
    report = classification_report(s, "label", "decision").select(
        F.lit("report").alias("part"), F.col("class").alias("name"), F.inline(F.array(*[
            F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
            for m in ("precision", "recall", "f1", "support")])))
    cells = confusion_matrix(s, "label", "decision").select(
        F.lit("confusion"), F.concat_ws("/", "label", "pred"), F.lit("n"), F.col("n").cast("double"))
    area = auc(s, "p1", "label").select(F.lit("auc"), F.lit("1"), F.lit("auc"), F.col("auc"))
    return report.union(cells).union(area)


QUERIES = {"model_roc": q_model_roc, "model_report": q_model_report}
