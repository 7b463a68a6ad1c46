"""Carry the previous row's values forward when it is recent enough."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame

from .asof import asof_self


def carry_previous(df: DataFrame, keys: Sequence[str], time_col: str, cols: Sequence[str],
                   max_gap_seconds: float, strict: bool = True,
                   prefix: str = "prev_") -> DataFrame:
    """Attach the immediately preceding row's ``cols`` (same ``keys``) when it
    is less than ``max_gap_seconds`` older (``<=`` with ``strict=False``).

    The latest strictly-earlier row inside the gap *is* the immediate
    predecessor whenever the predecessor is inside the gap, so this equals
    ``lag`` + a recency test (or a self join on row numbers), but runs as the
    scan of :mod:`chartgrid.operators.scan`, with ``df`` read once.
    Rows of one (keys, time) do not carry to each other.
    """
    return asof_self(df, keys, time_col, cols, max_gap_seconds, include_lower=not strict,
                     include_current=False, prefix=prefix)
