"""SparkSession construction and shared-folder helpers."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "quayside") -> SparkSession:
    """Build (or reuse) a session tuned for this engine.

    AQE is on so shuffle partitions coalesce at runtime, small join sides are converted to
    broadcast only after their real size is known, and skewed shuffle partitions are split.
    The session time zone is pinned to UTC so hour/day parts never depend on the host.
    """
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Column construction without per-call Python stack capture (it only enriches
        # error messages, and costs several py4j round trips per expression node).
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("QUAYSIDE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
        # let HotSpot JIT generated methods above 8 KB of bytecode (large fused stages)
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure_session(spark)
    return spark


def configure_session(spark: SparkSession) -> None:
    """Settings every query relies on, applied to any session handed to us."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a private one only when none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object-store) folder and is
    used as is. Only when it is unset and all runs in one process, as in local tests, is a fresh temporary folder set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not current:
        current = tempfile.mkdtemp(prefix="quayside-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for written round trips."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/quayside-{name}-{uuid.uuid4().hex[:12]}"
