"""Per-entity multi-statistic roll-up (mean / min / max / sum) in one pass."""
from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_STATS = {"mean": F.avg, "min": F.min, "max": F.max, "sum": F.sum}


def stats_rollup(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Sequence[str]],
                 carried: Sequence[str] = (), sums: Sequence[str] = (),
                 rename: Mapping[str, str] | None = None) -> DataFrame:
    """``groupBy(keys)`` producing ``{name}_{stat}`` for every column listed under
    each stat, ``max(c)`` for functionally dependent ``carried`` columns and
    ``sum(c)`` for ``sums``.  ``rename`` maps a source column to the stem used
    in the output name.  All statistics are decomposable, so the plan is one
    partial + one final aggregate with a single shuffle on ``keys``.
    """
    rename = dict(rename or {})
    aggs = [F.max(c).alias(c) for c in carried]
    for stat, cols in stats.items():
        for c in cols:
            aggs.append(_STATS[stat](c).alias(f"{rename.get(c, c)}_{stat}"))
    aggs += [F.sum(c).alias(c) for c in sums]
    return df.groupBy(*keys).agg(*aggs)


def banded_rollup(df: DataFrame, keys: Sequence[str], order_col: str, spans: Sequence[int], stats: Mapping[str, Sequence[str]],
                  sums: Sequence[str] = (), rename: Mapping[str, str] | None = None, name: str = "hours") -> DataFrame:
    """:func:`stats_rollup` over ``order_col`` in [0, s] for every s of ``spans`` at once.

    A row falls into one band, up to the first span that holds it.  Per (keys, band) the
    mergeable states (sum, count, least, greatest) are aggregated once; a band's states
    then join every span from it on, at most ``len(spans)`` copies of one state row per
    band, and merge.  The rows themselves are read and aggregated once, however many
    spans there are.  Rows outside [0, max(spans)] or without an order count nowhere; a
    group appears in the spans that hold one of its rows at least.
    """
    rename, spans = dict(rename or {}), sorted(spans)
    t = F.col(order_col)
    band = F.lit(None).cast("int")
    for s in reversed(spans):
        band = F.when(t <= s, F.lit(s)).otherwise(band)
    cols = list(dict.fromkeys(c for of in stats.values() for c in of))
    needs = {c: [k for k, of in stats.items() if c in of] for c in cols}
    states, merged = [], []
    for c in cols:
        stem = rename.get(c, c)
        if "mean" in needs[c]:
            states += [F.sum(F.col(c).cast("double")).alias(f"{c}__s"), F.count(c).alias(f"{c}__n")]
        for k, f in (("min", F.min), ("max", F.max)):
            if k in needs[c]:
                states.append(f(c).alias(f"{c}__{k}"))
    for k, of in stats.items():
        for c in of:
            stem = rename.get(c, c)
            # try_divide: a column without any value has no mean
            value = {"mean": lambda: F.try_divide(F.sum(f"{c}__s"), F.sum(f"{c}__n").cast("double")),
                     "min": lambda: F.min(f"{c}__min"), "max": lambda: F.max(f"{c}__max")}[k]()
            merged.append(value.alias(f"{stem}_{k}"))
    states += [F.sum(c).alias(f"{c}__sum") for c in sums]
    merged += [F.sum(f"{c}__sum").alias(c) for c in sums]
    per_band = df.where((t >= 0) & (t <= spans[-1])).withColumn("__band", band).groupBy(*keys, "__band").agg(*states)
    reach = F.filter(F.array(*[F.lit(s) for s in spans]), lambda s: s >= F.col("__band"))
    return per_band.withColumn(name, F.explode(reach)).groupBy(*keys, name).agg(*merged)
