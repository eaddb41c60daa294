"""Spark session settings shared by every job in the package.

The event-time semantics depend on a UTC session zone (minute and hour
buckets are truncated on the session zone), so ``prepare`` is applied to any
session handed to us, including one built by a caller.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings every query relies on.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # upload only the changed state each micro-batch, snapshot in the background
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


MB = 1024 * 1024


def scale_conf(input_bytes: int, target_partition_mb: int = 128) -> dict[str, str]:
    """Shuffle and scan sizing from the input size.

    ``spark.sql.shuffle.partitions`` is the *upper* bound of reduce tasks:
    about one per ``target_partition_mb`` of input, so a wide stage's
    partitions fit in executor memory without spilling.  AQE then coalesces
    the small aggregated stages down toward the advisory size and splits
    skewed partitions.  Scans read 256 MB splits.  At 100 TB this is about
    800k shuffle partitions before coalescing.
    """
    parts = max(8, -(-int(input_bytes) // (target_partition_mb * MB)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 * MB),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_mb * MB),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * MB),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_mb * MB),
    }


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; cheap and idempotent."""
    for key, value in SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a ``with`` block; a streaming query keeps those of its start."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def build_session(master: str | None = None, app: str = "plume",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests, the bench and command-line use."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and staged tables.

    On a cluster this is the shared folder named in ``spark.checkpoint.dir``;
    a local folder is created only when nothing is configured and the master
    is local (tests); elsewhere executors would not see it, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has executors
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="plume-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint root."""
    root = checkpoint_root(spark)
    path = f"{root}/plume/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path
