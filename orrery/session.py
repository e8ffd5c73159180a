"""Session construction and the shared scratch/checkpoint location."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
    # A checkpoint's files go when its frame is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Defaults for a large cluster (applied when no master is given, i.e. under
# spark-submit): many shuffle partitions that AQE coalesces to ~256 MB each,
# 256 MB scan splits, skew splitting for hot keys.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "orrery", extra: dict | None = None) -> SparkSession:
    """Build a session with AQE on, UTC time and ANSI casts, or return the
    active one unchanged (its owner configured it).

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the
    submitter decides them; AQE coalesces shuffle partitions at runtime.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_CONF)
    if not master:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named in ``spark.checkpoint.dir`` (or already set on the
    context) wins. Only when nothing is configured -- local tests -- a fresh
    folder is made so that ``checkpoint()`` works.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can "
                               "reach (shared storage); a machine-local folder cannot work")
        configured = tempfile.mkdtemp(prefix="orrery-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def work_root(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written tables.

    Written tables, not executor-local state, carry results between stages,
    so a lost executor only costs a task retry. The configured folder itself
    is used (Spark puts RDD checkpoints in a per-application subfolder), so
    separate applications find each other's finished builds.
    """
    app_dir = ensure_checkpoint_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    base = (configured or app_dir).rstrip("/")
    return "/".join([base, "orrery", *parts])


def unique_name(prefix: str) -> str:
    return f"{prefix}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files, cached blocks and checkpoints that
    nothing refers to any more. It does so when the driver collects its
    garbage, which may be long after the last job that read them. What the
    last job read may stay until the next one."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
