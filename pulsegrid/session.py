"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "pulsegrid") -> SparkSession:
    """Build (or reuse) a session with AQE, Arrow and no web UI.

    On a cluster the master, partition counts and the checkpoint folder come
    from the submit configuration; the values here only fill what is unset.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          # Arrow batches of windows: rows x samples stays small even for 250 Hz channels
          .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
          .config("spark.sql.session.timeZone", "UTC"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local") and not os.environ.get("PULSEGRID_DRIVER_MEMORY") == "":
        # local mode: the driver JVM is the only executor; the cluster sets its own sizes
        b = b.config("spark.driver.memory", os.environ.get("PULSEGRID_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the session names none (local tests) a fresh folder is made;
    on a cluster the setting must point at shared storage, or this raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="pulsegrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediates."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of queries that run inside go when each has ended, not when the driver's garbage does."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once into a Parquet table of the shared checkpoint folder; its shuffle files go at once.

    Columnar and compressed, so a fraction of the same rows in ``checkpoint()``."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
