"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Defaults that matter for correctness against the oracle (UTC, ANSI) and
# for scale (AQE re-planning, skew-join splitting, partition coalescing).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files (surrogate-key numbering) are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "stellate", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests
    and the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """One JVM: the driver's disk is the only disk."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def _on_local_disk(spark: SparkSession, path: str) -> bool:
    if path.startswith("file:"):
        return True
    default = spark._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return path.startswith("/") and default.startswith("file:")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder for intermediate tables on the storage every executor sees.

    Uses the cluster's ``spark.checkpoint.dir`` (registering it with the
    SparkContext if that has no checkpoint dir yet), else the checkpoint dir
    the SparkContext already has.  Without either a local session (tests)
    gets a private scratch folder; any other raises, since a folder on the
    driver's own disk isn't seen by the executors.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if root and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="stellate-ckpt-")
        sc.setCheckpointDir(root)
    path = "/".join([root.rstrip("/"), *parts]) if parts else root
    if _on_local_disk(spark, path):
        os.makedirs(path.removeprefix("file:"), exist_ok=True)
    return path
