"""Best row per group and ordinals.

``best_per_group`` keeps, per group, the first row under a multi-key order
with mixed directions.  It is written as ``min_by(payload, order_struct)``,
an aggregate with a map-side partial step, so a hot group is reduced inside
every input task before the shuffle instead of being sorted in one task (as
``row_number() ... = 1`` would).  NULL placement follows SQL defaults:
ascending keys put NULLs first, descending keys put them last.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import epoch_micros


def _order_fields(df: DataFrame, order: Sequence[tuple]) -> list[Column]:
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    fields = []
    for i, (name, asc) in enumerate(order):
        c = F.col(name)
        dt = types[name]
        if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            c = epoch_micros(c)
        elif isinstance(dt, T.DateType):
            c = F.datediff(c, F.lit("1970-01-01").cast("date"))
        elif isinstance(dt, T.BooleanType):
            c = c.cast("int")
        elif not isinstance(dt, T.NumericType):
            if not asc:
                raise TypeError(f"descending order on {dt} is not supported: {name}")
        if asc:   # NULLS FIRST
            fields += [F.col(name).isNotNull().alias(f"n{i}"), c.alias(f"k{i}")]
        else:     # NULLS LAST, larger first
            fields += [F.col(name).isNull().alias(f"n{i}"), (-c).alias(f"k{i}")]
    return fields


def best_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[tuple],
                   cols: Sequence[str] | None = None) -> DataFrame:
    """First row per ``keys`` under ``order`` = [(column, ascending), ...].

    The order should be total inside a group (add a tie-break key);
    otherwise which tied row is kept is unspecified, as with ``row_number``.
    """
    keys = list(keys)
    cols = [c for c in (cols or df.columns) if c not in keys]
    ordk = F.struct(*_order_fields(df, order))
    payload = F.struct(*[F.col(c) for c in cols])
    agg = df.groupBy(*keys).agg(F.min_by(payload, ordk).alias("__best"))
    return agg.select(*keys, *[F.col("__best")[c].alias(c) for c in cols])


def last_per_group(df: DataFrame, keys: Sequence[str], time_col: str,
                   cols: Sequence[str] | None = None, tie_break: Sequence[str] = ()) -> DataFrame:
    """Latest row per group (``row_number() over (order by time desc) = 1``)."""
    return best_per_group(df, keys, [(time_col, False)] + [(c, True) for c in tie_break], cols)


def ordinal(df: DataFrame, partition: Sequence[str], order: Sequence[Column],
            name: str = "ordinal") -> DataFrame:
    """``row_number()`` within ``partition`` (BIGINT).  Intended for
    dimension-sized partitions such as the stays of one subject; for fact
    tables with possibly huge groups use :func:`ordinal_skew_safe`."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w).cast("bigint"))


def ordinal_skew_safe(df: DataFrame, partition: Sequence[str], order_col: str,
                      ties: Sequence[str] = (), name: str = "ordinal") -> DataFrame:
    """1-based ``row_number()`` ordered by ``order_col`` (ascending, NULLs
    first) then ``ties``, computed without a per-group partition (see
    :mod:`chartgrid.operators.positions`)."""
    from .positions import positions
    p = positions(df, partition, order_col, ties, name="__pos")
    return p.withColumn(name, F.col("__pos") + F.lit(1)).drop("__pos")
