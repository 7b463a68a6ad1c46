"""Readers for the Parquet tables the queries run on."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..session import configure

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Scan one table; ``columns`` prunes the Parquet read schema."""
    configure(spark)
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df

