"""Session helpers.

The engine only relies on runtime SQL settings, so it works with a session
built elsewhere (a cluster's, the test driver's).  ``prepare`` pins the few
settings whose defaults would change results; ``build_session`` is for local
runs and tests.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that change results, not just speed.
RESULT_SETTINGS = {
    # Dates and timestamps are rendered in UTC; conversions never depend on it.
    "spark.sql.session.timeZone": "UTC",
}

# Settings for the execution plan; applied only by ``build_session``.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Delete reliable-checkpoint files once their DataFrame is garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


# Target bytes per task: big enough to amortise task overhead, small enough
# to sort and aggregate in executor memory without heavy spilling.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def scale_settings(input_bytes: int, total_cores: int) -> dict:
    """Partition sizing for a job reading ``input_bytes`` on ``total_cores``:
    enough shuffle partitions that each holds about 128 MB (at least 3 waves
    of tasks), scans split at 128 MB, and AQE coalescing small ones."""
    by_size = -(-int(input_bytes) // TARGET_PARTITION_BYTES)
    shuffle = max(total_cores * 3 if input_bytes > TARGET_PARTITION_BYTES else total_cores, by_size)
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RESULT_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of an execution go when it ends; else they stay until the driver happens to collect its
    garbage, and those of many micro-batches add up on the executors' disks.  The session keeps its own setting."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def submitted() -> bool:
    """Whether spark-submit started this driver: its master and sizes are set there."""
    return "PYSPARK_GATEWAY_PORT" in os.environ


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "changefold", extra: dict | None = None) -> SparkSession:
    """A session with the engine's settings.  Master, driver memory and shuffle partitions are set only as given, or
    when nothing else sets them: a plain Python process gets ``local[$BENCH_CPUS]``."""
    builder = SparkSession.builder.appName(app_name)
    cpus = os.environ.get("BENCH_CPUS", "8")
    if not master and not submitted():
        master = f"local[{cpus}]"
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
            shuffle_partitions = shuffle_partitions or int(cpus)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**PLAN_SETTINGS, **RESULT_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written tables and stream checkpoints.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system).
    Only when it is unset, as in local tests, a fresh local folder is made and
    registered as the checkpoint directory.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = jdir.get() if jdir.isDefined() else None
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder; "
                               "a machine-local folder is not visible to other executors")
        path = tempfile.mkdtemp(prefix="changefold-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder below ``work_dir`` for one run."""
    import uuid

    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
