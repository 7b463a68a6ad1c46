"""Spark side of the metric and exploratory keys."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.metrics import auc, classification_report, confusion_matrix, decide, roc_points
from ..plans.explore import distinct_subjects, los_histogram, mortality_by_sex
from ..sources.fixtures import icu_sources
from ..sources.tables import read_table
from .common import rounded


def scored_events(spark, sf):
    """score = round(value) (many ties), label = purchase, prob = value / 400."""
    ev = read_table(spark, sf, "events", ["event_id", "event_type", "value"])
    return ev.select("event_id", F.round("value").alias("score"),
                     (F.col("event_type") == "purchase").cast("int").alias("label"),
                     decide(F.col("value") / F.lit(400.0), 0.5).alias("pred"))


def q_auc(spark, sf):
    return rounded(auc(scored_events(spark, sf), "score", "label"))


def q_roc_points(spark, sf):
    return rounded(roc_points(scored_events(spark, sf), "score", "label"))


def q_confusion_matrix(spark, sf):
    return confusion_matrix(scored_events(spark, sf), "label", "pred")


def q_classification_report(spark, sf):
    return rounded(classification_report(scored_events(spark, sf), "label", "pred"))


def q_eda_value_share(spark, sf):
    return rounded(mortality_by_sex(icu_sources(spark, sf).patients))


def q_eda_los_bins(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_shipdate"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    los = j.select((F.timestamp_diff("SECOND", "o_orderdate", "l_shipdate") / F.lit(86400.0)).alias("los"))
    return los_histogram(los, "los")


def q_eda_distinct_subjects(spark, sf):
    return distinct_subjects({
        "patients": read_table(spark, sf, "customer", ["c_custkey"]).withColumnRenamed("c_custkey", "subject_id"),
        "prescriptions": read_table(spark, sf, "orders", ["o_custkey"]).withColumnRenamed("o_custkey", "subject_id"),
        "diagnoses": read_table(spark, sf, "events", ["user_id"]).withColumnRenamed("user_id", "subject_id"),
    })


QUERIES = {
    "auc": q_auc,
    "roc_points": q_roc_points,
    "confusion_matrix": q_confusion_matrix,
    "classification_report": q_classification_report,
    "eda_value_share": q_eda_value_share,
    "eda_los_bins": q_eda_los_bins,
    "eda_distinct_subjects": q_eda_distinct_subjects,
}
