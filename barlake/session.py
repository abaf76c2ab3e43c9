"""Session defaults and the shared folder for tables and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. The zone is pinned so that `to_date` buckets bars
# the same way on every cluster; ANSI stays on (Spark 4 default).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Sizing for large inputs, applied by the command line unless the submitter set a
# value: start with many shuffle partitions and let AQE coalesce them towards the
# advisory size; split skewed join partitions; read files in 256 MB splits.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
}


ADVISORY_BYTES = 256 << 20


def tune_for_scale(
    spark: SparkSession, overrides: dict[str, str] | None = None, input_bytes: int | None = None
) -> None:
    """Apply :data:`SCALE_DEFAULTS` for keys the submitter did not set.

    ``input_bytes`` (what the job is about to shuffle) raises the initial number of shuffle
    partitions so that each gets about the advisory size.
    """
    submitted = spark.sparkContext.getConf()
    defaults = dict(SCALE_DEFAULTS)
    if input_bytes is not None:
        key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        defaults[key] = str(max(int(defaults[key]), input_bytes // ADVISORY_BYTES + 1))
    for key, value in {**defaults, **(overrides or {})}.items():
        if overrides and key in overrides or not submitted.contains(key):
            spark.conf.set(key, value)


def build_session(
    master: str = "local[*]",
    app_name: str = "barlake",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and local runs; on a cluster use the one spark-submit made."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("BARLAKE_DRIVER_MEMORY", "8g"))
        # Checkpoints cut lineage; delete their files once nothing refers to them.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_session(spark: SparkSession) -> None:
    """Apply the zone pin to a session someone else built (D14)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def is_local(spark: SparkSession) -> bool:
    """One JVM holds driver and executors; ``local-cluster`` has executors of its own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    On a cluster the setting must exist: a machine-local folder would be lost with
    its executor. Only a local session (tests) gets a temporary one when unset.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if configured is None:
            if not is_local(spark):
                raise RuntimeError(
                    "spark.checkpoint.dir is not set; point it at shared storage"
                )
            configured = tempfile.mkdtemp(prefix="barlake-ckpt-")
            spark.conf.set("spark.checkpoint.dir", configured)
        spark.sparkContext.setCheckpointDir(configured)
    return configured or spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder below the shared folder."""
    return "/".join([shared_dir(spark).rstrip("/"), "barlake", *parts, uuid.uuid4().hex])
