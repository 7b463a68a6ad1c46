"""Row positions within groups without sending a hot group to one task.

``row_number() over (partition by g order by t)`` sorts each group inside a
single task.  ``positions`` gives the same numbers (0-based) for any group size:

1. rows are range-partitioned by (group, order key, ties) and written with the
   number of their range, so a large group spans several ranges, also where many
   of its rows have one order key but different ties;
2. row counts per (group, range) give each range's offset within the group;
3. ``row_number`` within (group, range) + offset.

The ranges only decide how work is split; positions are exact.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import materialise


def positions(df: DataFrame, keys: Sequence[str], order_col: str, ties: Sequence[str] = (),
              name: str = "pos") -> DataFrame:
    """Add ``name`` = 0-based position of each row within ``keys`` ordered by
    ``order_col`` then ``ties`` (ascending, NULLs first)."""
    keys, order = list(keys), [order_col, *ties]
    x = materialise(df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in (*keys, *order)])
                    .withColumn("__range", F.spark_partition_id()), "positions")
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = x.groupBy(*keys, "__range").count().select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__range").alias("__r"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    same = F.col("__range") == F.col("__r")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    own = Window.partitionBy(*keys, "__range").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return x.join(offsets, same).select(
        *df.columns, (F.row_number().over(own) - 1 + F.col("__before")).cast("bigint").alias(name))
