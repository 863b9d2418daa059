"""Session settings, and the shared folder used for checkpoints and stream state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a running session accepts.  Partition counts, memory and broadcast
# thresholds stay with the cluster; AQE sizes shuffles from what it measures.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows here are small and the work per row is not: let adaptive execution keep
    # more, smaller partitions than its 1 MB default while cores are idle.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
    # Split a hot join partition even when the aggregate above would otherwise
    # have reused the join's partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Merge session windows map-side, so a busy user is reduced before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator here relies on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "tidemart", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """Create a session; the master normally comes from spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        # Checkpoints of frames that are no longer referenced are deleted.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: the one the cluster names in spark.checkpoint.dir.

    Only a local-mode session may fall back to a temporary folder, because there
    the driver and the executors are the same machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tidemart-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    spark = df.sparkSession
    root = shared_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)
