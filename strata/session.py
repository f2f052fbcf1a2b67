"""Session settings for local runs, tests and the bench (clusters bring their own)."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE (runtime coalescing, skew-join
# splitting, broadcast conversion from runtime sizes), UTC, no UI server.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "strata", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = {**BASE_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": os.environ.get("STRATA_DRIVER_MEMORY", "16g")}
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20, cores: int | None = None) -> dict[str, str]:
    """Session settings sized from the input volume (apply with ``spark.conf.set``).

    Shuffle partitions ≈ input / 256 MB (at least 2× the cores so every core has
    work), rounded up; AQE then coalesces small ones and splits skewed ones at
    the same advisory size. Scan splits use the same target.
    """
    parts = max(1, -(-input_bytes // target_partition_bytes))
    if cores:
        parts = max(parts, 2 * cores)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 4),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
