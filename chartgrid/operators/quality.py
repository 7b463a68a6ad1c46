"""Data-quality operators: NULL/NaN profile, per-entity missing fractions,
completeness and exact-length filters, schema profile."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN for floating columns (``isnan`` only where it is defined)."""
    dt = df.schema[c].dataType
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: missing count per column plus ``n_rows``."""
    cols = list(cols or df.columns)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count(F.when(is_missing(df, c), F.lit(1))).alias(c) for c in cols])


def missing_fraction(df: DataFrame, entity: str, features: Sequence[str]) -> DataFrame:
    """Per entity, the share of rows where each feature is missing."""
    return df.groupBy(entity).agg(
        *[F.avg(is_missing(df, f).cast("double")).alias(f) for f in features])


def complete_entities(df: DataFrame, entity: str, features: Sequence[str],
                      threshold: float = 0.3) -> DataFrame:
    """Rows of entities whose missing fraction is ``< threshold`` for every
    feature (one aggregate + a left-semi join)."""
    frac = missing_fraction(df, entity, features)
    ok = frac.where(F.greatest(*[F.col(f) for f in features]) < F.lit(threshold)) \
        if len(features) > 1 else frac.where(F.col(features[0]) < F.lit(threshold))
    return df.join(ok.select(entity), entity, "left_semi")


def exact_length_entities(df: DataFrame, entity: str, n: int) -> DataFrame:
    """Rows of entities that have exactly ``n`` rows."""
    ok = df.groupBy(entity).count().where(F.col("count") == n).select(entity)
    return df.join(ok, entity, "left_semi")


def schema_profile(df: DataFrame) -> DataFrame:
    """Per column type: type, n_columns, n_values (non-missing values in all of
    them), from one aggregate over the rows."""
    counts = df.agg(*[F.count(F.when(~is_missing(df, c), 1)).alias(c) for c in df.columns])
    each = F.array(*[F.struct(F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("n"))
                     for f in df.schema.fields])
    return (counts.select(F.inline(each)).groupBy("type")
            .agg(F.count("*").alias("n_columns"), F.sum("n").alias("n_values")))


def columns_of_type(df: DataFrame, *types) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def complete_exact_entities(df: DataFrame, entity: str, features: Sequence[str],
                            threshold: float, n: int) -> DataFrame:
    """``exact_length_entities(complete_entities(df, ...), n)`` in one pass:
    the completeness filter keeps or drops whole entities, so the row count
    of a kept entity is unchanged and both rules can be tested on one
    per-entity aggregate (one shuffle, one semi-join)."""
    stats = df.groupBy(entity).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.avg(is_missing(df, f).cast("double")).alias(f) for f in features])
    worst = F.greatest(*[F.col(f) for f in features]) if len(features) > 1 else F.col(features[0])
    ok = stats.where((worst < F.lit(threshold)) & (F.col("__n") == n)).select(entity)
    return df.join(ok, entity, "left_semi")
