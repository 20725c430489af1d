"""Session helpers.

The library never changes cluster settings on its own; of the session's it lowers the rows of an
Arrow batch while whole texts go to Python (``llm.storage.text_batches``).  ``local_session`` is for
tests and the benchmark; ``shared_dir`` returns the cluster's shared folder for
checkpoints and written tables.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("feedlens")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read; without it
    this raises, since a folder of the driver's machine would not be seen by the
    executors.  With a local master (a test run) a fresh folder is made and registered.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder when the master is {master}")
        path = tempfile.mkdtemp(prefix="feedlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (for written tables)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "feedlens", *parts, uuid.uuid4().hex)


def cluster_settings(largest_shuffle_bytes: int, total_cores: int, target_partition_bytes: int = 200 << 20) -> dict[str, str]:
    """Suggested settings for a large cluster (apply with ``spark.conf.set``).

    Shuffle partitions are sized so the largest shuffle gives partitions of
    about ``target_partition_bytes`` (never fewer than two waves of tasks);
    AQE then coalesces small partitions and splits skewed ones at run time.
    """
    parts = max(2 * total_cores, -(-largest_shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
