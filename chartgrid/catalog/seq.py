"""Spark side of the data-quality, sampling and sequence keys."""
from __future__ import annotations

from ..operators.quality import missing_fraction, null_profile
from ..operators.sample import hash_split, stratified_folds
from ..operators.sequence import windows_long, windows_of_blocks
from ..plans.sequences import DAILY_FEATURES, SequencePrep, daily_series
from ..sources.tables import read_table
from .common import rounded

PREP = SequencePrep("user_id", "day", DAILY_FEATURES, "label")


def series(spark, sf):
    return daily_series(read_table(spark, sf, "events", ["user_id", "ts", "event_type", "value"]))


def q_null_profile(spark, sf):
    return null_profile(series(spark, sf))


def q_missing_fraction(spark, sf):
    return rounded(missing_fraction(series(spark, sf), "user_id", list(DAILY_FEATURES)))


def q_complete_entities(spark, sf):
    return rounded(PREP.complete(series(spark, sf)))


def q_exact_length_entities(spark, sf):
    return rounded(PREP.exact(series(spark, sf)))


def q_median_impute(spark, sf):
    return rounded(PREP.imputed(series(spark, sf)))


def q_entity_split(spark, sf):
    ids = PREP.exact(series(spark, sf)).select("user_id").distinct()
    return hash_split(ids, "user_id", 0.8, 0)


def q_hash_split(spark, sf):
    lab = read_table(spark, sf, "labels", ["doc_id", "quality", "toxic"])
    return hash_split(lab, "doc_id", 0.8, 1)


def q_stratified_folds(spark, sf):
    return stratified_folds(read_table(spark, sf, "labels", ["doc_id", "toxic"]), "doc_id", "toxic")


def q_oversample(spark, sf):
    sp = PREP.split(PREP.imputed(series(spark, sf)))
    return rounded(PREP.train_oversampled(sp))


def q_sequence_windows(spark, sf):
    w = PREP.split_windows(PREP.split(PREP.imputed(series(spark, sf))))
    return rounded(windows_long(w, ["user_id", "copy", "split"], list(DAILY_FEATURES)))


def q_window_blocks(spark, sf):
    keys = ["user_id", "copy", "split"]
    b = PREP.split_blocks(PREP.split(PREP.imputed(series(spark, sf))))
    return rounded(windows_long(windows_of_blocks(b, keys, PREP.length, PREP.block), keys, list(DAILY_FEATURES)))


QUERIES = {
    "null_profile": q_null_profile,
    "missing_fraction": q_missing_fraction,
    "complete_entities": q_complete_entities,
    "exact_length_entities": q_exact_length_entities,
    "median_impute": q_median_impute,
    "entity_split": q_entity_split,
    "hash_split": q_hash_split,
    "stratified_folds": q_stratified_folds,
    "oversample": q_oversample,
    "sequence_windows": q_sequence_windows,
    "window_blocks": q_window_blocks,
}
