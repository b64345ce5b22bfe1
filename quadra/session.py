"""Session helpers: a local session for tests/bench and the shared scratch root."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants (AQE re-plans joins and partition
# counts from real shuffle sizes; skew handling splits hot keys).
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session as used by the tests and the bench (UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quadra")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUADRA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only a local session without it gets a folder of
    its own, which is deleted when the driver ends; on a cluster the executors
    would each write to their own disk, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quadra-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared scratch root."""
    return f"{scratch_root(spark)}/quadra/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run, sized from the input volume.

    Shuffle partitions are chosen so one partition holds about
    ``target_partition_bytes`` (and at least two waves of tasks), scan splits
    and AQE's advisory size match that, and skew handling splits any
    partition five times the median — e.g. 100 TB on 8,000 cores gives
    ~400,000 partitions of 256 MB, each sorting and spilling within an
    executor's memory.
    """
    partitions = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        **ENGINE_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
