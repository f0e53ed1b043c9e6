"""Session settings the reports are written for.

On a cluster the session is created by the platform; ``configure`` only fills in settings that are
still unset, so a cluster's own values (shuffle partitions, checkpoint folder, ...) always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the plans rely on. AQE re-plans joins at runtime from measured shuffle sizes: a side
# becomes a broadcast only when its materialised size is under the threshold (a checked bound),
# otherwise the join stays sort-merge, and a skewed partition is split (skewJoin).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",  # off: it goes by the estimated size of a plan
    "spark.sql.files.maxPartitionBytes": "128MB",
    # A month of audits is the filter-building side when the audits are joined to all posts
    # (response times, interactions); the default 10MB limit would switch the runtime bloom
    # filter off at scale. A bloom filter never drops a matching row: results cannot change.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply DEFAULTS where the session has no value yet (runtime-settable SQL confs only)."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    # Month, day and hour are computed in the session zone; the reports are defined in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "venue_analytics") -> SparkSession:
    """Return the active session, or build a local one (tests, bench) with the UI off."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return configure(active)
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("VA_DRIVER_MEMORY", "16g")))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session (tests, bench) that names none gets a scratch folder; a cluster session
    without the setting gets ``None`` (callers refuse then), because a machine-local folder is not
    reachable after an executor is lost.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            return None
        # spark.checkpoint.dir is a startup setting; a running local session takes the folder
        # through the context instead
        current = tempfile.mkdtemp(prefix="va-ckpt-")
    spark.sparkContext.setCheckpointDir(current)
    return current
