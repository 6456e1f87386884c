"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every delaylens job expects. Timestamps are handled as TIMESTAMP_NTZ throughout,
# so results do not depend on the session zone; UTC is pinned anyway for log readability.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ui.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM never compiles a method of more than 8,000 bytes of code; a plan that would need one runs
    # operator by operator instead, several times as fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Checkpoint files of collected DataFrames are removed from the shared folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "delaylens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("DELAYLENS_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Settings sized to the input volume (for a cluster run; local tests use the defaults).

    Shuffle partitions ~ input / 256 MB (at least 2 waves of the cluster's cores), so a
    partition fits executor memory without spilling at any scale; input splits of 256 MB;
    AQE coalesces small partitions and splits skewed ones (a partition 5x the median and over
    1 GB is split). For 100 TB this gives ~400k shuffle partitions.
    """
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
        # Broadcast only below a runtime-checked size; above it AQE keeps the sort-merge join.
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder, setting a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` must name a shared (HDFS/object store) folder, which
    is used as is; without it a cluster job stops here. Only a session whose executors are this
    process (tests, local runs) gets a folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="delaylens-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/delaylens/{name}-{uuid.uuid4().hex[:12]}"
