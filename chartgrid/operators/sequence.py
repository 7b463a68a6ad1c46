"""Fixed-length sliding windows over each entity's ordered rows.

Window ``i`` of an entity holds rows ``[i, i+L)`` and is labelled with the
label of row ``i+L``; an entity with ``n`` rows yields ``max(0, n-L)``
windows.  Built from ``collect_list`` over a bounded ROWS frame and
``lead``.  ``sliding_windows_skew_safe`` first numbers the rows with
:func:`chartgrid.operators.positions.positions` and cuts each entity into
blocks of ``block`` positions; the ``L`` rows after a block are copied into
it, so every window is complete inside one (entity, block) partition and a
huge entity is spread over many tasks.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _keys(entity: str | Sequence[str]) -> list[str]:
    return [entity] if isinstance(entity, str) else list(entity)


def sliding_windows(df: DataFrame, entity: str | Sequence[str], order: str, features: Sequence[str],
                    label: str, length: int) -> DataFrame:
    """Columns: entity (one or several), ``start`` (order value of the first row),
    ``seq`` (array of ``length`` arrays of features, as double) and ``label``."""
    keys = _keys(entity)
    w = Window.partitionBy(*keys).orderBy(order)
    frame = w.rowsBetween(0, length - 1)
    step = F.array(*[F.col(f).cast("double") for f in features])
    return (df.select(*keys, order, label, step.alias("__step"))
              .withColumn("seq", F.collect_list("__step").over(frame))
              .withColumn("__y", F.lead(label, length).over(w))
              .where(F.col("__y").isNotNull())
              .select(*keys, F.col(order).alias("start"), "seq", F.col("__y").alias("label")))


def sliding_windows_skew_safe(df: DataFrame, entity: str | Sequence[str], order: str, features: Sequence[str],
                              label: str, length: int, block: int = 100_000) -> DataFrame:
    """Same output as :func:`sliding_windows`, without a per-entity partition."""
    from .positions import positions
    keys = _keys(entity)
    p = positions(df.select(*keys, order, label, *features), keys, order, name="__p")
    blk = F.floor(F.col("__p") / F.lit(block))
    # a row is used by its own block and, when it is among the first L rows of
    # its block, by the previous block (as the tail of that block's windows)
    owners = F.when((F.col("__p") % F.lit(block) < F.lit(length)) & (blk > 0),
                    F.array(blk, blk - 1)).otherwise(F.array(blk))
    x = p.withColumn("__blk", F.explode(owners))
    w = Window.partitionBy(*keys, "__blk").orderBy("__p")
    step = F.array(*[F.col(f).cast("double") for f in features])
    return (x.withColumn("seq", F.collect_list(step).over(w.rowsBetween(0, length - 1)))
             .withColumn("__y", F.lead(label, length).over(w))
             .where(F.col("__y").isNotNull() & (F.floor(F.col("__p") / F.lit(block)) == F.col("__blk")))
             .select(*keys, F.col(order).alias("start"), "seq", F.col("__y").alias("label")))


def window_blocks(df: DataFrame, entity: str | Sequence[str], order: str, features: Sequence[str],
                  label: str, length: int, block: int = 480) -> DataFrame:
    """The same windows without their copies: one row per ``block`` positions of an
    entity, followed by the ``length`` rows after it, so each row is stored
    ``1 + length / block`` times at most (and not once per window that holds it).

    Columns: entity, ``block_id`` (hash of entity and block), ``starts`` (order
    values), ``rows`` (array of arrays of features, as double) and ``labels`` (as
    double).  Window ``i < block`` of a block is ``rows[i, i + length)`` with the
    label of row ``i + length``.  Written under the shared checkpoint folder.
    """
    from ..sources.io import materialise
    from .positions import positions
    keys = _keys(entity)
    p = positions(df.select(*keys, order, label, *features), keys, order, name="__p")
    blk = F.floor(F.col("__p") / F.lit(block))
    owners = F.when((F.col("__p") % F.lit(block) < F.lit(length)) & (blk > 0),
                    F.array(blk, blk - 1)).otherwise(F.array(blk))
    row = F.struct(F.col("__p"), F.col(order).alias("start"),
                   F.array(*[F.col(f).cast("double") for f in features]).alias("row"),
                   F.col(label).cast("double").alias("label"))
    held = (p.select(*keys, F.explode(owners).alias("__blk"), row.alias("r")).groupBy(*keys, "__blk")
            .agg(F.sort_array(F.collect_list("r")).alias("r")))       # block + length rows at most
    return materialise(held.select(*keys, F.xxhash64(*keys, "__blk").alias("block_id"), F.col("r.start").alias("starts"),
                                   F.col("r.row").alias("rows"), F.col("r.label").alias("labels")), "window-blocks")


def windows_of_blocks(blocks: DataFrame, entity: str | Sequence[str], length: int, block: int = 480) -> DataFrame:
    """The output of :func:`sliding_windows` from what :func:`window_blocks` wrote."""
    n = F.least(F.lit(block), F.size("rows") - F.lit(length))
    w = blocks.where(n > 0).select(*_keys(entity), "starts", "rows", "labels", F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
    return w.select(*_keys(entity), F.get("starts", "i").alias("start"), F.slice("rows", F.col("i") + 1, length).alias("seq"),
                    F.get("labels", F.col("i") + length).alias("label")).where(F.col("label").isNotNull())


def windows_long(windows: DataFrame, entity: str | Sequence[str], features: Sequence[str]) -> DataFrame:
    """Unnest windows to one row per (entity, start, step) with feature columns."""
    keys = _keys(entity)
    x = windows.select(*keys, "start", "label", F.posexplode("seq").alias("step", "__v"))
    return x.select(*keys, "start", F.col("step").cast("bigint").alias("step"), "label",
                    *[F.col("__v")[i].alias(f) for i, f in enumerate(features)])
