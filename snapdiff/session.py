"""Session helpers: a local session for tests/bench and the shared checkpoint folder.

On a cluster the checkpoint folder must be the shared one named by
``spark.checkpoint.dir``; we only invent a local one when the session runs
in local mode and nothing was configured (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "snapdiff") -> SparkSession:
    """Session used by tests and the bench; real jobs bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("SNAPDIFF_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it only when unset.

    Order: the SparkContext's current folder, then ``spark.checkpoint.dir``
    from the session conf; a private /tmp folder only in local mode.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; iterative operators need a shared "
                "(cluster-visible) folder to cut lineage"
            )
        configured = tempfile.mkdtemp(prefix="snapdiff-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss; never localCheckpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back.

    Cuts lineage like :func:`cut_lineage` with one job instead of two and
    without the checkpoint's RDD on the driver; for jobs of many steps. The tables stay
    until the folder is emptied."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_parallel(*thunks):
    """Run independent driver-side steps (each submitting its own Spark jobs)
    concurrently, so small stages of one snapshot overlap with the other's.
    Returns the results in order."""
    from concurrent.futures import ThreadPoolExecutor

    if len(thunks) <= 1:
        return [t() for t in thunks]
    with ThreadPoolExecutor(max_workers=len(thunks)) as pool:
        futures = [pool.submit(t) for t in thunks]
        return [f.result() for f in futures]


def cluster_settings(input_bytes: int, executors: int, cores_per_executor: int) -> dict[str, str]:
    """Spark settings sized for a run over ``input_bytes`` of snapshot tables.

    Shuffle partitions target ~256 MB of shuffle input each (joins here
    expand at most a few times before partial aggregation shrinks them), and
    never fewer than two waves of the cluster's cores, so AQE can coalesce
    downwards and split skewed partitions. Scan splits use the same size.
    Apply with ``SparkSession.builder.config(map=...)``; checkpointing needs
    ``spark.checkpoint.dir`` on shared storage in addition."""
    target = 256 * 1024 * 1024
    cores = max(1, executors * cores_per_executor)
    partitions = max(2 * cores, -(-int(input_bytes) // target))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
