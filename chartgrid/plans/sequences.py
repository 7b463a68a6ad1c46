"""Data preparation for the sequence model (reference entry point C).

Steps, all DataFrame operators: per-entity missing fractions -> keep
entities whose every feature is < 30 % missing -> keep entities with exactly
``n_rows`` rows -> fill NULLs with global medians -> entity-level 80/20 split
-> replicate positive training entities 6 times as (id, copy) ->
sliding windows of ``length`` rows labelled with the following row.

``daily_series`` derives a per-user daily series from ``events`` for the
registered queries; the ICU form is ``IcuPipeline.sequences``.
"""
from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.grid import hour_grid
from ..operators.quality import complete_entities, complete_exact_entities
from ..operators.sample import hash_split, median_impute, oversample
from ..operators.sequence import sliding_windows_skew_safe, window_blocks

DAILY_FEATURES = ("avg_value", "min_value", "max_value", "sum_value", "n_events", "n_types")


def daily_series(events: DataFrame, days: int = 25, types: Sequence[str] = ("click", "purchase")) -> DataFrame:
    """(user_id, day) rows from the user's first event of ``types`` (day 0) to the
    last, ``days`` of them at most, with six daily features (NULL on days without
    such events), and the outcome: any purchase above 100 on a later day."""
    ev = events.where(F.col("event_type").isin(*types)).select("user_id", "ts", "event_type", "value")
    first = ev.groupBy("user_id").agg(F.min("ts").alias("first"))
    ev = ev.join(first, "user_id").select(
        "user_id", "event_type", "value", F.datediff("ts", "first").cast("bigint").alias("day"))
    users = ev.groupBy("user_id").agg(
        F.least(F.max("day"), F.lit(days - 1)).alias("__n"),
        F.max(F.when((F.col("day") >= days) & (F.col("event_type") == "purchase")
                     & (F.col("value") > 100), 1).otherwise(0)).alias("label"))
    grid = hour_grid(users, "__n", 0, "day").drop("__n")
    daily = ev.where(F.col("day") < days).groupBy("user_id", "day").agg(
        F.avg("value").alias("avg_value"), F.min("value").alias("min_value"),
        F.max("value").alias("max_value"), F.sum("value").alias("sum_value"),
        F.count(F.lit(1)).cast("double").alias("n_events"),
        F.count_distinct("event_type").cast("double").alias("n_types"))
    return grid.join(daily, ["user_id", "day"], "left").select(
        "user_id", "day", *DAILY_FEATURES, "label")


@dataclass
class SequencePrep:
    entity: str
    order: str
    features: Sequence[str]
    label: str
    threshold: float = 0.3
    n_rows: int = 25
    length: int = 24
    train_fraction: float = 0.8
    seed: int = 0
    copies: int = 6
    median_fit_on: str = "all"      # "all" (as published: before the split) or "train"
    block: int = 480                # positions of an entity that one stored block holds

    def complete(self, df: DataFrame) -> DataFrame:
        return complete_entities(df, self.entity, list(self.features), self.threshold)

    def exact(self, df: DataFrame) -> DataFrame:
        return complete_exact_entities(df, self.entity, list(self.features), self.threshold,
                                       self.n_rows)

    def imputed(self, df: DataFrame) -> DataFrame:
        ex = self.exact(df)
        if self.median_fit_on == "train":
            fit = hash_split(ex, self.entity, self.train_fraction, self.seed).where(
                F.col("split") == "train")
            return median_impute(ex, list(self.features), fit_df=fit)
        return median_impute(ex, list(self.features))

    def split(self, imputed: DataFrame) -> DataFrame:
        return hash_split(imputed, self.entity, self.train_fraction, self.seed)

    def train_oversampled(self, split_df: DataFrame) -> DataFrame:
        tr = split_df.where(F.col("split") == "train").drop("split")
        return oversample(tr, self.label, self.copies)

    def windows(self, df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
        """Windows per entity, or per entity and further ``keys`` (copy, split)."""
        return sliding_windows_skew_safe(df, [self.entity, *keys], self.order, list(self.features),
                                         self.label, self.length)

    def sides(self, split_df: DataFrame) -> DataFrame:
        """The oversampled training side and the test side, keyed by (entity, copy, split)."""
        train = self.train_oversampled(split_df).withColumn("split", F.lit("train"))
        test = split_df.where(F.col("split") == "test").withColumn("copy", F.lit(0))
        return train.unionByName(test)

    def split_windows(self, split_df: DataFrame) -> DataFrame:
        """Windows of both sides."""
        return self.windows(self.sides(split_df), ("copy", "split"))

    def split_blocks(self, split_df: DataFrame) -> DataFrame:
        """The same windows as blocks, stored without their copies."""
        return window_blocks(self.sides(split_df), [self.entity, "copy", "split"], self.order,
                             list(self.features), self.label, self.length, self.block)
