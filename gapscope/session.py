"""Session helpers: a local session for tests/bench, and the shared scratch root.

Operators never create sessions; they take and return DataFrames. Anything
that must be written between steps (landed files, lineage cuts, the audit
log in query bindings) goes under the folder the cluster names in
``spark.checkpoint.dir``. Only when that is unset (a bare local session, as
in tests) do we pick one ourselves.
"""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench: AQE on, UTC, no UI."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gapscope")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    A private one is made only where none is configured and the session is
    local, as in tests; on a cluster that is an error. What is written below
    it stays until the caller removes ``<folder>/gapscope`` after the run.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root
    if sc.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder that the driver and all executors share "
                f"(master {sc.master}); a machine-local folder would split the data between machines")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="gapscope-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the scratch root (created by the writer)."""
    root = scratch_root(spark)
    if root.startswith("file:") and not root.startswith("file://"):
        root = root[len("file:"):]
    return f"{root.rstrip('/')}/gapscope/{name}-{uuid.uuid4().hex}"


def cluster_settings(input_bytes: int, executor_cores: int, executors: int,
                     target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Configuration for a cluster run sized from the input volume.

    Shuffle partitions start high enough that each holds about
    ``target_partition_bytes`` of the input (never fewer than two waves of
    tasks); AQE then coalesces small ones and splits skewed ones at run
    time. File splits match the target, so a scan task fits executor memory.
    """
    slots = max(1, executor_cores * executors)
    partitions = max(2 * slots, math.ceil(input_bytes / target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.session.timeZone": "UTC",
        # an overflowing sum must fail, not wrap
        "spark.sql.ansi.enabled": "true",
    }
