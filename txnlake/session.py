"""Session construction and cluster-level settings.

Library functions never create a session; they take the caller's.  This
module is for tests, the bench and command-line runs.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins and coalesces partitions
# at run time; skew-join splitting covers a hot key on the anti-join; the
# session zone is pinned so hour/day features never depend on the host.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files are deleted once their RDD is garbage-collected, so the
    # shared checkpoint folder does not grow run after run.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[8]",
    app: str = "txnlake",
    shuffle_partitions: int = 8,
    driver_memory: str = "16g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, target_partition_mb: int = 256, max_partitions: int = 200_000) -> dict[str, str]:
    """Shuffle sizing for a given input volume.

    The initial shuffle partition count is sized so each partition holds
    about ``target_partition_mb`` of the input (AQE then coalesces small ones
    at run time, and splits skewed ones above the same size), instead of the
    default 200, which at 100 TB would put 500 GB into each task.
    """
    target = target_partition_mb * 1024 * 1024
    parts = max(8, min(max_partitions, -(-int(input_bytes) // target)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{target_partition_mb}m",
        "spark.sql.files.maxPartitionBytes": f"{min(target_partition_mb, 512)}m",
    }


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Spark registers that setting on the SparkContext at start-up; it is used
    as is.  Only a local-mode session (tests) without one gets a fallback
    folder; on a cluster a missing setting is an error, because a folder on
    one machine is not visible to the executors that read checkpoints back.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="txnlake-ckpt-", dir="/tmp")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
