"""Zone-less (TIMESTAMP_NTZ) time arithmetic with boundary-counting diffs.

All helpers return Catalyst expressions, so they stay inside whole-stage
codegen.  ``hour_diff`` counts hour *boundaries* crossed, like the warehouse
``DATETIME_DIFF(a, b, HOUR)``: 09:59 -> 10:00 is one hour, 10:00 -> 10:59 is
zero, and an event half an hour before the origin is hour -1 (a plain
``timestampdiff`` would say 0).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def EPOCH() -> Column:  # noqa: N802 - a constant, built lazily (needs a live session)
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def floor_hour(t) -> Column:
    """Truncate to the hour, keeping the zone-less type."""
    return F.date_trunc("HOUR", _c(t)).cast("timestamp_ntz")


def ceil_hour(t) -> Column:
    """Round up to the hour the way ``trunc(t + 59 min)`` does.

    10:00:30 stays 10:00 (seconds past the hour are not rounded up).
    """
    return floor_hour(_c(t) + F.expr("INTERVAL 59 MINUTES"))


def hour_diff(a, b) -> Column:
    """Hour boundaries between ``b`` and ``a`` (a - b), BIGINT."""
    return F.timestamp_diff("HOUR", floor_hour(b), floor_hour(a))


def day_diff(a, b) -> Column:
    """Calendar-day boundaries between ``b`` and ``a`` (a - b), INT."""
    return F.datediff(F.to_date(_c(a)), F.to_date(_c(b)))


def second_diff(a, b) -> Column:
    """Second boundaries between ``b`` and ``a`` (a - b), BIGINT."""
    return F.timestamp_diff("SECOND", F.date_trunc("SECOND", _c(b)).cast("timestamp_ntz"),
                           F.date_trunc("SECOND", _c(a)).cast("timestamp_ntz"))


def add_hours(t, n) -> Column:
    """``t + n hours`` (``n`` may be a literal or a column)."""
    n = F.lit(n) if not isinstance(n, Column) else n
    return _c(t) + F.make_dt_interval(F.lit(0), n.cast("int"))


def epoch_micros(t) -> Column:
    """Microseconds since 1970-01-01 of a zone-less timestamp (BIGINT).

    Used as a numeric order key for range frames; independent of the
    session zone.
    """
    return F.timestamp_diff("MICROSECOND", EPOCH(), _c(t))
