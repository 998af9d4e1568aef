"""Session settings and the shared folder that multi-step jobs write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app_name: str = "wardstone", cores: int | str = 8) -> SparkSession:
    """A local session for tests and the benchmark, with a shared folder of its own; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cores) if cores != "*" else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .config("spark.checkpoint.dir", os.environ.get("WARDSTONE_SHARED_DIR") or tempfile.mkdtemp(prefix="wardstone-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    A missing setting is an error, because a driver-local folder would be
    invisible to the executors. Only a session that is one process, and so has
    no other executors, gets a folder of its own when nothing is set.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="wardstone-")
    return _LOCAL_FOLDERS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, never used before."""
    return f"{shared_dir(spark)}/wardstone/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``checkpoint()`` and the tree learner's own checkpoints usable."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a result several later steps read, and continue from the stored copy.

    Later steps do not repeat the work behind it, and a lost executor costs no
    recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
