"""Session settings the change-feed semantics depend on, and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session must carry for correct results:
#  - UTC, so month buckets of offset timestamps do not depend on the host zone;
#  - ANSI stays on (Spark 4 default); parsing code uses try_cast where input may be junk.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # times with statistics per row group, so that a cut-off by time can skip row groups
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Settings for scale: runtime re-planning, skew splitting, partition coalescing.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required (and scale) settings to an existing session."""
    for key, value in {**REQUIRED_CONF, **SCALE_CONF}.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tidemark", master: str | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        **REQUIRED_CONF,
        **SCALE_CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # reliable checkpoints are removed once their DataFrame is garbage collected
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def require_local(master: str) -> None:
    """Raise unless driver and executors are one process, with one file system."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all of {master} shares")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and job state.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir). When neither is
    set, a local run (tests) gets a fresh folder; on a cluster that is an error, as
    executors would not see it.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc.getCheckpointDir() is None:
        require_local(sc.master)
    if sc.getCheckpointDir() is None:
        # Register the configured folder for checkpoint(); invent one only when unset.
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tidemark-"))
    return (configured or sc.getCheckpointDir()).rstrip("/")


def new_work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the filesystem Spark reads through.

    Checking first (rather than reading and catching the error) keeps failed queries out
    of the session's listeners and logs, and lets every other read error surface.
    """
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the library's own work files, if it is there."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
