"""Session set-up shared by the library, tests and the bench."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Settings every pipeline relies on.  Zone-less timestamps are compared and
#: truncated in UTC so hour arithmetic does not depend on the host zone.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Coalesce small shuffles toward one partition per core, not toward
    # 1 MB chunks: small-but-CPU-heavy stages (windows, generators) keep their
    # parallelism.  Large shuffles are unaffected (they are far above 64 KB).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    # Spark takes a scan to be as large as its file.  Keys, times and categories
    # are about eight times as large as rows, and a join would broadcast all of
    # them through the driver; by its rows a side is still broadcast, while it
    # runs, if its measured size is below the limit.
    "spark.sql.sources.fileCompressionFactor": "8.0",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app: str = "chartgrid", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.  The number of
    shuffle partitions is 8 on a local master and the cluster's own elsewhere,
    unless it is given."""
    if shuffle_partitions is None and master.startswith("local["):
        shuffle_partitions = 8
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # no stack trace per column call: it doubles the time to build wide plans
         .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for k, v in SESSION_CONF.items():
        if spark.conf.get(k, None) != v and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    zone = "spark.sql.session.timeZone"
    if spark.conf.get(zone) != SESSION_CONF[zone]:      # hour arithmetic would change
        raise RuntimeError(f"{zone} is {spark.conf.get(zone)} and cannot be set to {SESSION_CONF[zone]}")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    Only when the setting is absent on a local master (tests) a private
    folder is created; on a cluster the setting is required.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: lineage cuts and "
                               "written intermediates must survive the loss of a machine")
        d = tempfile.mkdtemp(prefix="chartgrid-ckpt-")   # single-machine runs / tests only
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    import uuid
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
