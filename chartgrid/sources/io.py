"""Sinks and file sources: Parquet round trip, CSV export / import (S2-S5)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def save_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                 partition_by=None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads the files instead of
    recomputing the whole plan); the folder comes from ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    """CSV export of a feature table; NULL is written as an empty field."""
    df.write.mode("overwrite").option("header", header).option("nullValue", "").csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             header: bool = True, infer_schema: bool = False) -> DataFrame:
    """CSV scan.  An explicit schema is preferred; ``infer_schema`` mirrors
    ``options(header, inferschema)``.  Literal ``NaN`` in a double column is
    turned into NULL so NaN and empty fields mean the same (missing)."""
    r = spark.read.option("header", header)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", infer_schema)
    df = r.csv(path)
    dbl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if dbl:
        df = df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in dbl})
    return df
