"""Last known value before each row, without one task per key.

``last(value, ignorenulls) over (partition by key order by time)`` sorts each key inside
one task.  ``last_value_scan`` gives the same values for any number of rows of a key:

1. rows are range-partitioned by (keys, order, ties) and written with the number of their
   range, so a burst of one key spans several ranges;
2. every range gives one row, its last known value and the keys of that value; a running
   last over them tells what a range inherits.  Keys stand together in the order, so what a
   range inherits is for its first key, or for a key that has ended;
3. inside (keys, range) a running last, else the inherited value if its keys are the row's.

One row per range is broadcast, never more, whatever the data holds.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import materialise

_RANGE = "__range"


def ranged(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` in ranges of ``by``, written with the number of each row's range."""
    return materialise(df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in by])
                       .withColumn(_RANGE, F.spark_partition_id()), "last-value")


def inherited(ranges: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """__r and __in: struct (keys, value) of the last known value before range ``__r``."""
    held = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate([*keys, *order])],
                    F.col(value).alias("value"))
    ends = ranges.groupBy(_RANGE).agg(F.max(F.when(F.col(value).isNotNull(), held)).alias("end"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)      # a row per range
    return ends.select(F.col(_RANGE).alias("__r"), F.last("end", ignorenulls=True).over(before).alias("__in"))


def last_value_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str,
                    ties: Sequence[str] = ()) -> DataFrame:
    """Add ``name``: the last ``value`` that is not NULL at or before each row, among rows of
    equal ``keys`` ordered by ``order`` (ascending, NULLs first).

    Where rows with values are equal in ``order`` the greatest value must come last: put the
    value itself into ``order``.  ``ties`` only spread equal rows over ranges; rows equal in
    ``order`` must not differ in whether they have a value.  NULL keys form a key of their
    own.  An empty frame gives an empty one."""
    keys, order = list(keys), list(order)
    x = ranged(df, [*keys, *order, *ties])
    w = (Window.partitionBy(*keys, _RANGE).orderBy(*[F.col(c).asc_nulls_first() for c in order])
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = F.last(value, ignorenulls=True).over(w)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col("__in")[f"c{i}"])
    joined = x.join(F.broadcast(inherited(x, keys, order, value)), F.col(_RANGE) == F.col("__r"), "left")
    return (joined.withColumn(name, F.coalesce(own, F.when(same, F.col("__in")["value"])))
            .drop(_RANGE, "__r", "__in"))
