"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session of this engine relies on. AQE gives runtime
# re-planning: broadcast decisions from measured sizes, skew-join splitting
# of hot keys, and coalescing of small shuffle partitions.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "ledgerlake",
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    On a cluster, ``master`` stays None and the launcher decides; the
    shuffle partition count should then be sized so that one partition of
    the largest fact fits executor memory (roughly input bytes / 128 MB).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, the same in every
    application (Spark's own checkpoint folder is a new one below it each time).

    Only a local session may do without the setting: there one machine-local
    folder is visible to the driver and to its executors.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
        spark.sparkContext.setCheckpointDir(path)  # found again by the next call
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and materialised layers, registered as
    Spark's checkpoint folder if none is."""
    path = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


# Settings of queries that write or read whole layers. Shuffle files go when the
# query ends: else they lie on the executors' disks until the driver happens to
# collect its garbage, maybe after the last query. The planner takes a file's
# size for that of its rows: those of a written dimension take some ten times as
# much memory, and the driver builds whatever is broadcast.
LOAD_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.sources.fileCompressionFactor": "10.0",
}


@contextmanager
def loading(spark: SparkSession):
    """Holds ``LOAD_CONF`` in ``spark`` within it, for queries that run there."""
    before = {k: spark.conf.get(k, None) for k in LOAD_CONF}
    for k, v in LOAD_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return os.path.join(checkpoint_dir(spark), *parts)
