"""Per-entity integer time grid (lateral unnest of a generated range)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hour_grid(df: DataFrame, upper_col: str, lower: int = -24, out_col: str = "hr") -> DataFrame:
    """One row per ``hr`` in ``[lower, upper_col]`` for every input row.

    A NULL upper bound or one below ``lower`` yields no rows (``sequence``
    would otherwise count *down*).  The generator streams inside the scan's
    task; the grid is never materialised on one node.
    """
    n = F.col(upper_col).cast("int")
    seq = F.when(n >= F.lit(lower), F.sequence(F.lit(lower), n))
    return (df.withColumn(out_col, F.explode(seq))
              .withColumn(out_col, F.col(out_col).cast("bigint")))
