"""Assignment of events to the intervals of their key that hold them (J3, J11).

An equi-join on the key alone pairs every event of a key with every interval of
it.  Here an interval is placed in time buckets: its level is the smallest whose
bucket (``base * 4^level`` seconds) is as long as the interval, so it lies in two
buckets at most, whatever its length.  An event has one bucket per level that
occurs (at most ``LEVELS``).  The join is on (key, level, bucket) with the exact
limits as a residual, so a key with many intervals spreads over its buckets, and
an event meets only intervals near it.

Intervals are half-open, ``[start, end)``.  Defined cases: overlapping intervals
each get the event, of touching ones only the later; empty or reversed
intervals, null keys and null times match nothing; repeated rows on either side
stay repeated; intervals longer than the highest level's bucket share that level
and take as many buckets as they need.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fanout import fan_out

LEVELS = 12
BASE = 3600       # seconds of a bucket at level 0: 12 levels reach 478 years


def assign_intervals(events: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, start: str,
                     end: str, base: int = BASE) -> DataFrame:
    """Columns of ``events``, then those of ``intervals`` without the keys, one row for
    each event and interval of equal ``keys`` with ``start <= at < end``.  Other
    columns must have different names on the two sides."""
    keys = list(keys)
    shared = (set(events.columns) & set(intervals.columns)) - set(keys)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    sizes = [base * 1_000_000 * 4 ** k for k in range(LEVELS)]
    width = F.element_at(F.array(*[F.lit(s) for s in sizes]), F.col("__level") + 1)
    bucket = lambda micro: ((micro - F.pmod(micro, width)) / width).cast("bigint")
    long = micros(end) - micros(start)
    level = F.coalesce(*[F.when(long <= s, F.lit(k)) for k, s in enumerate(sizes)], F.lit(LEVELS - 1))
    placed = (intervals.where(F.col(start) < F.col(end)).withColumn("__level", level)
              .withColumn("__bucket", F.explode(F.sequence(bucket(micros(start)), bucket(micros(end) - 1)))))
    used = [r[0] for r in placed.select("__level").distinct().collect()]       # LEVELS rows at most
    seen = (fan_out(events.where(F.col(at).isNotNull()), ["__level"], [[str(k)] for k in sorted(used)])
            .withColumn("__bucket", bucket(micros(at))))
    rest = [c for c in intervals.columns if c not in keys]
    return seen.join(placed, [*keys, "__level", "__bucket"]).where(
        (F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).select(*events.columns, *rest)
