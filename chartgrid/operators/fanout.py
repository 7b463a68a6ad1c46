"""Every row of a frame with every row of a fixed list.

``explode`` of a literal array makes the same rows, but Spark takes its result to be
as large as its input.  A join above it then broadcasts the fanned-out side through
the driver whenever the input file is below the broadcast limit, however many rows
come out.  A cross join with the list as a local relation multiplies the estimate, so
only sides that are small in fact are broadcast.  The list itself is: it holds
literals of the code, never data.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fan_out(df: DataFrame, columns: Sequence[str], rows: Sequence[Sequence[str]]) -> DataFrame:
    """``df`` with ``columns`` appended, one row for each of its rows and of ``rows``
    (SQL literals).  Without ``rows`` (NULL columns of no type) nothing comes out."""
    values = ", ".join("(" + ", ".join(r) + ")" for r in rows or [["NULL"] * len(columns)])
    fixed = df.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")
    return df.crossJoin(F.broadcast(fixed if rows else fixed.limit(0)))
