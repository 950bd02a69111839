"""Spark session helpers.

Library functions never create sessions themselves; jobs, tests and the bench
call :func:`build_session` (or pass in their own).  :func:`checkpoint_dir`
reads the cluster's shared checkpoint folder and only falls back to a scratch
folder when none is configured (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes (the
# only place a join side is broadcast without an explicit row-count check),
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "shopfloor",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with :data:`DEFAULT_CONF`.

    ``master`` and ``shuffle_partitions`` are set only when given (tests and the
    bench pin them for local mode); otherwise the cluster's submit settings
    apply, so a cluster job is never pinned to one machine or a handful of
    shuffle partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    When a local session has none, a scratch folder is created and registered.
    On a cluster a missing setting is an error: executors on different machines
    would each write to their own disk and could not read each other's parts.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="shopfloor-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint directory for written intermediates."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
