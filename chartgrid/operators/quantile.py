"""Exact quantiles of many columns by narrowing brackets.

Spark's exact ``percentile``/``median`` keeps a value -> count map of the whole
column in one aggregation buffer.  Here every wanted rank keeps an open bracket
of values that may hold it.  A round takes approximate percentiles around the
rank inside the bracket (values of the data, from a bounded sketch) and then
counts the rows below and up to each of them: a pivot is the answer, or it cuts
the bracket.  Both steps are one wide aggregate for all columns, so one row
reaches the driver.  A round shrinks a bracket some hundredfold, and by one
distinct value at least; the result does not depend on the number of rows.
"""
from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.io import materialise

ACCURACY = 1000      # of the sketch: rank error within a bracket is 1/ACCURACY


def exact_quantiles(df: DataFrame, cols: Sequence[str], q: float = 0.5) -> dict:
    """Exact linearly interpolated ``q``-quantile of each column (NULL and
    NaN ignored), like pandas ``quantile`` / Spark ``percentile``."""
    cols = list(cols)
    x = materialise(df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"c{i}")
                                for i, c in enumerate(cols)]), "quantiles")     # read twice a round
    sizes = x.agg(*[F.count(f"c{i}").alias(f"c{i}") for i in range(len(cols))]).first()
    open_, found = {}, {}
    for i in range(len(cols)):
        if sizes[i]:
            at = q * (sizes[i] - 1)
            for rank in {math.floor(at), math.ceil(at)}:
                open_[i, rank] = (None, None, 0, sizes[i])       # above, below, rows up to above, rows under below
    while open_:
        tasks = list(open_.items())
        pivots = x.agg(*[_around(f"c{i}", rank, *bracket).alias(f"t{t}")
                         for t, ((i, rank), bracket) in enumerate(tasks)]).first()
        asked = [(t, v) for t in range(len(tasks)) for v in sorted(set(pivots[t]))]
        counts = x.agg(*[f for t, v in asked for c in [F.col(f"c{tasks[t][0][0]}")]
                         for f in (F.count(F.when(c < F.lit(v), 1)), F.count(F.when(c <= F.lit(v), 1)))]).first()
        for n, (t, v) in enumerate(asked):
            key, under, upto = tasks[t][0], counts[2 * n], counts[2 * n + 1]
            if key not in open_:
                continue
            above, below, lo, hi = open_[key]
            if under <= key[1] < upto:
                found[key] = v
                del open_[key]
            elif upto <= key[1]:
                open_[key] = (v, below, upto, hi)
            else:
                open_[key] = (above, v, lo, under) if under < hi else open_[key]
    out: dict = {}
    for i, c in enumerate(cols):
        out[c] = None
        if sizes[i]:
            at = q * (sizes[i] - 1)
            a, b, part = found[i, math.floor(at)], found[i, math.ceil(at)], at - math.floor(at)
            out[c] = a if a == b else a * (1 - part) + b * part
    return out


def _around(col: str, rank: int, above, below, lo: int, hi: int):
    """Three values of the bracket near the rank."""
    c = F.col(col)
    inside = F.lit(True)
    if above is not None:
        inside = inside & (c > F.lit(above))
    if below is not None:
        inside = inside & (c < F.lit(below))
    at, step = (rank - lo + 0.5) / (hi - lo), 2 / ACCURACY
    shares = [min(1.0, max(0.0, at + d)) for d in (-step, 0.0, step)]
    return F.percentile_approx(F.when(inside, c), shares, ACCURACY)


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    return exact_quantiles(df, [col], q)[col]


def exact_medians(df: DataFrame, cols: Sequence[str]) -> dict:
    return exact_quantiles(df, cols, 0.5)
