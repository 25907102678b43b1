"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None, app: str = "readerflow") -> SparkSession:
    """Session for tests and the benchmark (local mode, no UI, AQE on)."""
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.variant.allowDuplicateKeys", "true")  # as JSON readers do: the last of repeated keys counts
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="readerflow-ckpt-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and written tables.

    Read from ``spark.checkpoint.dir``; only a local session without one (tests)
    gets a fresh folder. On a cluster a machine's own folder would lose rows, so
    there the setting is required.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="readerflow-ckpt-"))
        d = sc.getCheckpointDir()
    return d


def package_on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    That holds for local sessions and for nodes that share the installation;
    other clusters ship the package with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def cluster_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Suggested SQL settings for a cluster run over ``input_bytes`` of data.

    Scan splits of ``target_partition_bytes`` (whole row groups still bound a
    split from below), an initial shuffle width of at least 3 waves over the
    cores or one partition per target size, and AQE to coalesce small shuffle
    partitions and split skewed ones at runtime. Per-task memory stays near the
    target size, so sorts and aggregations spill gracefully instead of failing.
    """
    waves = 3 * max(1, total_cores)
    by_size = -(-int(input_bytes) // target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(max(waves, by_size)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        # AQE's runtime broadcast decision is taken on measured sizes
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.variant.allowDuplicateKeys": "true",
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> None:
    for k, v in settings.items():
        spark.conf.set(k, v)
