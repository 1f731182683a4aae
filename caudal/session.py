"""Session construction and shared-storage helpers.

Library code never creates a session on its own; callers pass one in. The
helpers here are for tests, the bench and command-line use.
"""

from __future__ import annotations

import atexit
import logging
import os
import tempfile

from pyspark.sql import SparkSession

LOG = logging.getLogger(__name__)

# Settings every caudal job relies on: UTC wall clock, AQE for runtime
# re-planning (coalescing, skew splits, broadcast conversion of sides whose
# measured size is under the threshold), no UI server.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "caudal", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is read as is; without it this raises.
    Only in local mode, where driver and executors are one process, an unset folder is made here.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="caudal-ckpt-", dir=os.environ.get("CAUDAL_SCRATCH"))
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables.

    It is removed when the driver process ends, or by ``remove_scratch``.
    """
    base = ensure_checkpoint_dir(spark)
    path = base.rstrip("/") + "/" + name
    _SCRATCH.append((spark, path))
    return path


@atexit.register
def remove_scratch() -> None:
    """Delete the folders that ``scratch_path`` named, through Spark's file systems."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)
        except Exception as e:  # noqa: BLE001 - the JVM may be gone; the folder then stays for the store's owner
            LOG.debug("scratch folder %s stays: %s", path, e)
