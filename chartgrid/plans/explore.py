"""Exploratory summaries (K13-K15) as distributed aggregates."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Category order of the length-of-stay histogram.
LOS_ORDER = ("0", "1", "2", "3", "4", "5", "6", "7", "8-14", ">14")


def value_share(df: DataFrame, group: str, value: str, out: str = "percentage") -> DataFrame:
    """Share of each ``value`` within its ``group`` (NULL labels are dropped,
    as a grouped value count does)."""
    c = df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group, value).count()
    w = Window.partitionBy(group)           # over (group, value) counts: a handful of rows
    return c.select(group, value, (F.col("count") / F.sum("count").over(w)).alias(out))


def mortality_by_sex(patients: DataFrame) -> DataFrame:
    lab = patients.select(
        F.when(F.col("expire_flag") == 1, "Deceased").when(F.col("expire_flag") == 0, "Alive")
         .alias("status"),
        F.when(F.col("gender") == "F", "Female").when(F.col("gender") == "M", "Male").alias("sex"))
    return value_share(lab, "sex", "status")


def los_label(los) -> F.Column:
    """Round half to even, then 8 < d < 14 -> '8-14', d >= 14 -> '>14', else d."""
    d = F.bround(F.col(los) if isinstance(los, str) else los, 0).cast("int")
    return (F.when((d < 14) & (d > 8), F.lit("8-14")).when(d >= 14, F.lit(">14"))
            .otherwise(d.cast("string")))


def los_histogram(df: DataFrame, los: str) -> DataFrame:
    """Count per label in the fixed plot order (zero counts kept); rows with a
    NULL anywhere are dropped first, labels outside the order are not shown."""
    lab = df.na.drop("any").select(los_label(los).alias("days"))
    agg = lab.agg(*[F.count(F.when(F.col("days") == v, 1)).alias(f"c{i}")
                    for i, v in enumerate(LOS_ORDER)])
    pairs = ", ".join(f"'{v}', c{i}" for i, v in enumerate(LOS_ORDER))
    return agg.select(F.expr(f"stack({len(LOS_ORDER)}, {pairs}) AS (days, n)"))


def distinct_subjects(sources: dict) -> DataFrame:
    """(source, n_subjects) for several (name -> DataFrame with ``subject_id``)."""
    parts = [df.agg(F.count_distinct("subject_id").alias("n_subjects"))
               .select(F.lit(name).alias("source"), "n_subjects") for name, df in sources.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
