"""Small helpers shared by the operators of this package."""
from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col):
    """A-Z to a-z, every other character as it is."""
    return F.translate(col, UPPER, UPPER.lower())


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back, so that
    later jobs do not recompute it and a lost executor costs only its own tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small frame (removed with its last reference)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors where they would not find it themselves
    (neither PYTHONPATH nor the working folder has it), as ``--py-files`` would."""
    root, sc = Path(__file__).resolve().parents[2], spark.sparkContext
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if sc.applicationId in _shipped or any(p and Path(p).resolve() == root for p in known):
        return
    own = _shipped[sc.applicationId] = tempfile.TemporaryDirectory()    # the driver's; Spark serves the file
    sc.addPyFile(shutil.make_archive(f"{own.name}/chartgrid", "zip", root, "chartgrid"))


def map_rows(df: DataFrame, schema: str, rows: Callable[[Iterable[dict]], Iterator[tuple]],
             chunk: int = 4096) -> DataFrame:
    """``mapInArrow`` for a function from an iterator of column lists to tuples.

    ``rows`` gets an iterator of ``dict name -> pyarrow array`` (one per batch)
    and yields tuples in the order of ``schema``; they leave in bounded batches.
    """
    from pyspark.sql.types import StructType, _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    arrow = to_arrow_schema(parsed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        named = (dict(zip(b.schema.names, b.columns)) for b in batches)
        for row in rows(named):
            held.append(row)
            if len(held) >= chunk:
                yield _batch(held, arrow)
                held = []
        if held:
            yield _batch(held, arrow)

    return df.mapInArrow(run, parsed)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


__all__ = ["table", "ascii_lower", "keep", "cut", "ship", "map_rows"]
