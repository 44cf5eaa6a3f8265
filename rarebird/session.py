"""Session helpers: shared folders for checkpoints and models, local sessions for tests."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rarebird") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("RAREBIRD_DRIVER_MEMORY", "16g"))
    )
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the context (``setCheckpointDir``) or from ``spark.checkpoint.dir``. When neither is set
    one is placed under the warehouse, but only for a local master or a warehouse on a shared file
    system: a folder of one machine would scatter the files over the executors' own disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = _shared_root(spark) + "/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    on_one_machine = "://" not in root or root.startswith("file:")
    if on_one_machine and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path for outputs (models, table files) that every executor sees: beside the checkpoints if a
    checkpoint folder is configured, but never inside the folder of one run's checkpoints."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    base = (f"{configured.rstrip('/')}/outputs" if configured else f"{_shared_root(spark)}/_outputs")
    tail = "/".join(p.strip("/") for p in parts if p)
    if unique:
        tail = f"{tail}-{uuid.uuid4().hex[:12]}" if tail else uuid.uuid4().hex[:12]
    return f"{base}/rarebird/{tail}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for the intermediate tables of one run, beside the checkpoints."""
    return f"{checkpoint_dir(spark).rstrip('/')}/rarebird/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's file system layer."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder when the driver's JVM ends."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
