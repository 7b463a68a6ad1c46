"""Scalar helpers: three-valued predicates, interval tests, logistic score."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ne_3vl(c, value, null_safe: bool = False) -> Column:
    """``c != value`` with SQL three-valued logic.

    By default a NULL ``c`` makes the predicate NULL, so a ``where`` drops the
    row (how ``error != 1`` behaves in the warehouse queries).  With
    ``null_safe=True`` NULL rows are kept.
    """
    c = _c(c)
    return ~c.eqNullSafe(F.lit(value)) if null_safe else (c != F.lit(value))


def in_range(c, lo=None, hi=None, lo_inclusive: bool = False,
             hi_inclusive: bool = False) -> Column:
    """Interval membership; ``None`` bounds are open (unbounded)."""
    c = _c(c)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & ((c >= F.lit(float(lo))) if lo_inclusive else (c > F.lit(float(lo))))
    if hi is not None:
        cond = cond & ((c <= F.lit(float(hi))) if hi_inclusive else (c < F.lit(float(hi))))
    return cond


def logistic(z) -> Column:
    """1 / (1 + exp(-z))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))


def round_half_away(c, digits: int) -> Column:
    """Round a double to ``digits`` places on its binary value, half away from
    zero (``round(x * 10^d) / 10^d``) — the warehouse's float ROUND.  Spark's
    ``round`` works on the shortest decimal string instead, which differs at
    exact half-way strings such as 1845.26275."""
    m = float(10 ** digits)
    return F.round(_c(c) * F.lit(m)) / F.lit(m)
