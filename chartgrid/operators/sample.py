"""Entity-level sampling: portable hash split, stratified folds, minority
oversampling, median imputation."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mixed_hash(id_col, seed: int = 0) -> Column:
    """0 to 2^32 - 1: the first eight hex digits of ``md5('<seed>:<id>')``.

    Ids in any arithmetic pattern (strides, blocks) spread evenly, any SQL engine
    computes the same number, and it does not depend on partitioning
    (``randomSplit`` does).  A NULL id gives NULL.
    """
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    digest = F.md5(F.concat(F.lit(f"{seed}:"), c.cast("bigint").cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def portable_bucket(id_col, seed: int = 0, buckets: int = 1000) -> Column:
    """``mixed_hash`` modulo ``buckets``: every bucket holds about as many ids."""
    return F.pmod(mixed_hash(id_col, seed), F.lit(buckets))


def hash_split(df: DataFrame, id_col: str, train_fraction: float = 0.8, seed: int = 0,
               out_col: str = "split") -> DataFrame:
    """Tag every row 'train' / 'test' from its id (rows of one id stay together)."""
    cut = int(round(train_fraction * 1000))
    return df.withColumn(out_col, F.when(portable_bucket(id_col, seed) < cut, "train")
                         .otherwise("test"))


def split_sides(df: DataFrame, id_col: str, train_fraction: float = 0.8, seed: int = 0):
    t = hash_split(df, id_col, train_fraction, seed, "__split")
    return (t.where(F.col("__split") == "train").drop("__split"),
            t.where(F.col("__split") == "test").drop("__split"))


def stratified_folds(df: DataFrame, id_col: str, label_col: str, folds: int = 5, seed: int = 0,
                     out_col: str = "fold") -> DataFrame:
    """Exact folds 0 to ``folds - 1``: rows are ranked by (label, mixed hash of the id,
    id) and dealt in turn, so the sizes of the folds differ by one at most, in the
    table and in every class.  No fold lacks a class that has ``folds`` rows.

    The ranks come from :func:`chartgrid.operators.positions.positions`, so no class
    is sorted in one task.  Rows with equal label and id follow each other.
    """
    from .positions import positions
    ranked = positions(df.withColumn("__mix", mixed_hash(id_col, seed)), [], label_col, ["__mix", id_col], "__rank")
    return ranked.withColumn(out_col, F.pmod("__rank", F.lit(folds)).cast("int")).drop("__mix", "__rank")


def oversample(df: DataFrame, label_col: str, copies: int = 6, positive=1) -> DataFrame:
    """The rows with ``copies`` extra copies of the positive-label rows.  Ids stay
    as they are; (id, ``copy``) names an entity, 0 being the original."""
    last = F.when(F.col(label_col) == positive, F.lit(copies)).otherwise(F.lit(0))
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), last)))


def fill_with(df: DataFrame, values: dict) -> DataFrame:
    """``coalesce(c, value)`` per column, value a literal."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def median_impute(df: DataFrame, cols: Sequence[str], fit_df: DataFrame | None = None) -> DataFrame:
    """Fill NULLs of ``cols`` with each column's exact (interpolated) median,
    computed on ``fit_df`` (default: ``df`` itself, as the reference does).

    The medians come from :func:`chartgrid.operators.quantile.exact_medians`
    (distributed selection; one small row reaches the driver)."""
    from .quantile import exact_medians
    med = exact_medians(fit_df if fit_df is not None else df, cols)
    return fill_with(df, {c: med[c] for c in cols if med[c] is not None})
