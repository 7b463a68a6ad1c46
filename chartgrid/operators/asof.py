"""Look-back (as-of with tolerance) left join without a range join.

For every left row, attach the latest right row with equal keys whose time is
in ``[t - tolerance, t]`` (bounds configurable).  Instead of an equi-join on
the key plus a time residual -- which pairs every left row with every right
row of the key and explodes on hot keys -- both sides are unioned and a
running ``last(..., ignorenulls)`` picks the latest right row at or before
each left row; a final test on its time applies the tolerance.

Skew: the running last is a scan over ranges of (keys, time)
(:mod:`chartgrid.operators.scan`), so a key's rows are spread over as many tasks
as they fill, also where they fall into one short burst.
Of right rows with equal keys and time the one with the greatest values (in
the order given) wins.  A NULL key or time matches nothing, as in a join: such right
rows are dropped, such left rows pass through.

Where both sides are one table (``asof_self``) it is read once and each row is emitted
as a left and as a right row.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_micros
from .scan import last_value_scan

_T, _V, _SIDE, _TIE, _HIT = "__asof_t", "__asof_v", "__asof_side", "__asof_tie", "__asof_hit"
#: numbers of the sides in the order of one time's rows, by include_current: right rows
#: come first if the current instant counts, else last
_LEFT, _RIGHT = {True: 1, False: 0}, {True: 0, False: 1}


def _known(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known


def _payload(values: Sequence[str], time: str) -> Column:
    return F.struct(*[F.col(v).alias(v) for v in values], F.col(_T).alias("__t"), F.col(time).alias("__time"))


def _attach(both: DataFrame, columns: Sequence[str], keys: Sequence[str], values: Sequence[str], tol: int,
            include_lower: bool, include_current: bool, prefix: str, match_time_col: str | None) -> DataFrame:
    """Left rows of ``both`` (rows of the two sides) with the values of their match."""
    u = last_value_scan(both.withColumn(_TIE, F.xxhash64(*columns)), keys, [_T, _SIDE, _V], _V, _HIT, [_TIE])
    hit = F.col(_HIT)
    ok = _known(keys) & hit.isNotNull()
    ok = ok & (hit["__t"] >= F.col(_T) - F.lit(tol) if include_lower else hit["__t"] > F.col(_T) - F.lit(tol))
    if not include_current:
        ok = ok & (hit["__t"] < F.col(_T))
    out = [F.col(c) for c in columns]
    out += [F.when(ok, hit[v]).alias(prefix + v) for v in values]
    if match_time_col:
        out.append(F.when(ok, hit["__time"]).alias(match_time_col))
    return u.where(F.col(_SIDE) == _LEFT[include_current]).select(*out)


def _micros(tolerance_seconds: float) -> int:
    tol = int(round(tolerance_seconds * 1_000_000))
    if tol <= 0:
        raise ValueError("tolerance must be positive")
    return tol


def asof_lookback(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str,
                  right_time: str, values: Sequence[str], tolerance_seconds: float,
                  include_lower: bool = True, include_current: bool = True,
                  prefix: str = "", match_time_col: str | None = None) -> DataFrame:
    keys, tol = list(keys), _micros(tolerance_seconds)
    L = left.withColumn(_T, epoch_micros(left_time)).withColumn(_SIDE, F.lit(_LEFT[include_current]))
    R = (right.where(_known(keys) & F.col(right_time).isNotNull()).select(*keys, right_time, *values)
         .withColumn(_T, epoch_micros(right_time)).withColumn(_V, _payload(values, right_time))
         .select(*keys, _T, _V, F.lit(_RIGHT[include_current]).alias(_SIDE)))
    return _attach(L.unionByName(R, allowMissingColumns=True), left.columns, keys, values, tol,
                   include_lower, include_current, prefix, match_time_col)


def asof_self(df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str],
              tolerance_seconds: float, include_lower: bool = True, include_current: bool = True,
              prefix: str = "prev_", match_time_col: str | None = None) -> DataFrame:
    """``asof_lookback`` of a table against itself, reading it once."""
    keys, tol = list(keys), _micros(tolerance_seconds)
    usable = _known(keys) & F.col(_T).isNotNull()
    both = (df.withColumn(_T, epoch_micros(time)).withColumn("__asof_own", _payload(values, time))
            .withColumn(_SIDE, F.explode(F.when(usable, F.array(F.lit(0), F.lit(1)))
                                         .otherwise(F.array(F.lit(_LEFT[include_current])))))
            .withColumn(_V, F.when(F.col(_SIDE) == _RIGHT[include_current], F.col("__asof_own"))).drop("__asof_own"))
    return _attach(both, df.columns, keys, values, tol, include_lower, include_current, prefix, match_time_col)
