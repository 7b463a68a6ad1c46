"""Exact prefix sums over an ordered key without a single-partition window.

A global ``sum() over (order by k)`` moves every row into one task.  Here the
(already aggregated) rows are range-partitioned by the key and written with the
number of their range; the totals per range (one row per partition) give each
range's offset, and the running sum inside a range is a window of its own.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import materialise


def prefix_sums(df: DataFrame, order_col: str, sum_cols: Sequence[str], descending: bool = False,
                inclusive: bool = True, prefix: str = "cum_") -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over rows ordered before (and, when
    ``inclusive``, at) each row.  ``order_col`` must be unique per row."""
    k = F.col(order_col).desc() if descending else F.col(order_col).asc()
    x = materialise(df.repartitionByRange(k).withColumn("__range", F.spark_partition_id()), "prefix_sums")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)    # one row per partition
    offsets = x.groupBy("__range").agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols]).select(
        "__range", *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{c}") for c in sum_cols])
    own = Window.partitionBy("__range").orderBy(k).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return x.join(offsets, "__range").select(*df.columns, *[
        (F.col(f"__o_{c}") + F.coalesce(F.sum(c).over(own), F.lit(0))).alias(prefix + c) for c in sum_cols])
