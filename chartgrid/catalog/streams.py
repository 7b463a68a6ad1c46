"""Streaming form of the hourly vitals, checked against the batch oracle."""
from __future__ import annotations

import os

from ..plans.assemble import IcuPipeline
from ..session import scratch_path
from ..sources.fixtures import chartevents, icu_sources
from ..streaming.hourly import HourlyPartials, stream_hourly_vitals
from .common import rounded


def q_vitals_stream(spark, sf):
    """Read ``events`` as a file stream (one micro-batch per file, so the
    table is fed in batches), derive chart rows, and merge the partials."""
    kept = IcuPipeline(icu_sources(spark, sf)).kept
    ev_schema = spark.read.parquet(os.path.join(sf, "events.parquet")).schema
    stream = (spark.readStream.schema(ev_schema).option("maxFilesPerTrigger", 1)
              .parquet(os.path.join(sf, "events*.parquet")))
    base = scratch_path(spark, "vitals_stream")
    q = stream_hourly_vitals(spark, chartevents(stream), kept, os.path.join(base, "out"),
                             os.path.join(base, "ckpt"))
    q.awaitTermination()
    return rounded(HourlyPartials(os.path.join(base, "out")).merged(spark))


QUERIES = {"vitals_stream": q_vitals_stream}
