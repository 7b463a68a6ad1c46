"""Binary-classification metrics as DataFrame operators.

AUC and ROC points are exact and tie-aware: scores are first aggregated to
(score, positives, negatives) -- a partial aggregate, so a score shared by a
third of all rows is one row after the map side -- then cumulative counts
come from :func:`chartgrid.operators.cumulative.prefix_sums`.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.io import materialise
from .cumulative import prefix_sums


def score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    lab = F.col(label).cast("int")
    counts = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(F.when(lab == 1, 1).otherwise(0)).cast("bigint").alias("p"),
        F.sum(F.when(lab == 1, 0).otherwise(1)).cast("bigint").alias("n"))
    return materialise(counts, "score_counts")      # read several times, scored once


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row ``auc``: P(score_pos > score_neg) + 0.5 P(tie); NULL when a
    class is absent."""
    g = score_counts(df, score, label)
    c = prefix_sums(g, "score", ["n"], inclusive=False)          # negatives strictly below
    return c.agg(
        (F.sum(F.col("p") * (F.col("cum_n") + F.col("n") / F.lit(2.0)))
         / F.nullif(F.sum("p").cast("double") * F.sum("n").cast("double"), F.lit(0.0))).alias("auc"))


def roc_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, fpr, tpr): one point per distinct score, predicting
    positive when score >= threshold."""
    g = score_counts(df, score, label)
    c = prefix_sums(g, "score", ["p", "n"], descending=True, inclusive=True)
    tot = g.agg(F.sum("p").alias("P"), F.sum("n").alias("N")).first()
    P, N = (tot["P"] or 0), (tot["N"] or 0)
    return c.select(F.col("score").alias("threshold"),
                    (F.col("cum_n") / F.lit(float(N)) if N else F.lit(None).cast("double")).alias("fpr"),
                    (F.col("cum_p") / F.lit(float(P)) if P else F.lit(None).cast("double")).alias("tpr"))


def decide(prob, threshold: float = 0.5):
    """Class decision: 1 when prob > threshold."""
    c = F.col(prob) if isinstance(prob, str) else prob
    return F.when(c > F.lit(threshold), 1).otherwise(0)


def _cells(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    one = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    return df.agg(one((y == 0) & (p == 0)).alias("tn"), one((y == 0) & (p == 1)).alias("fp"),
                  one((y == 1) & (p == 0)).alias("fn"), one((y == 1) & (p == 1)).alias("tp"))


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Four rows (label, pred, n) including empty cells."""
    return _cells(df, label, pred).select(F.expr(
        "stack(4, 0L, 0L, tn, 0L, 1L, fp, 1L, 0L, fn, 1L, 1L, tp) AS (label, pred, n)"))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Rows for class 0, class 1, 'accuracy', 'macro avg', 'weighted avg' with
    precision, recall, f1 and support (undefined ratios are 0, as in the
    common report)."""
    c = _cells(df, label, pred)

    def ratio(a, b):
        return F.coalesce(a / F.nullif(b, F.lit(0)).cast("double"), F.lit(0.0))

    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    p1, r1 = ratio(tp, tp + fp), ratio(tp, tp + fn)
    p0, r0 = ratio(tn, tn + fn), ratio(tn, tn + fp)
    s1, s0 = (tp + fn), (tn + fp)
    tot = s0 + s1
    x = c.select(p0.alias("p0"), r0.alias("r0"), p1.alias("p1"), r1.alias("r1"),
                 s0.alias("s0"), s1.alias("s1"), tot.alias("tot"),
                 ratio(tp + tn, tot).alias("acc"))
    f = lambda p, r: ratio(F.lit(2.0) * p * r, p + r)
    x = x.withColumns({"f0": f(F.col("p0"), F.col("r0")), "f1": f(F.col("p1"), F.col("r1"))})
    w0, w1 = ratio(F.col("s0"), F.col("tot")), ratio(F.col("s1"), F.col("tot"))
    macro = lambda a, b: (F.col(a) + F.col(b)) / F.lit(2.0)
    wavg = lambda a, b: F.col(a) * w0 + F.col(b) * w1
    def row(name, p, r, f1, support):
        return F.struct(F.lit(name).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f1.cast("double").alias("f1"),
                        support.cast("bigint").alias("support"))

    none = F.lit(None).cast("double")
    rows = F.array(
        row("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        row("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        row("accuracy", none, none, F.col("acc"), F.col("tot")),
        row("macro avg", macro("p0", "p1"), macro("r0", "r1"), macro("f0", "f1"), F.col("tot")),
        row("weighted avg", wavg("p0", "p1"), wavg("r0", "r1"), wavg("f0", "f1"), F.col("tot")))
    return x.select(F.inline(rows))
