"""Helpers for the registered queries."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def r9(c):
    """Round a double to 9 places exactly as the oracle's ``round(x*1e9)/1e9``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * F.lit(1e9)) / F.lit(1e9) + F.lit(0.0)


def rounded(df: DataFrame) -> DataFrame:
    """Round every double column of a result to 9 places (comparison form)."""
    dbl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: r9(c) for c in dbl}) if dbl else df
