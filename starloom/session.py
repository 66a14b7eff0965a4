"""Session helpers: building a session for local runs and resolving the shared
checkpoint folder.

On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
system path).  Only when the session has none — local runs and tests — do we
pick a private scratch folder ourselves.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "starloom", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench: AQE on, UTC, no UI."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # checkpoint files of DataFrames that are no longer referenced are removed
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads the cluster's setting; sets a private one only when none is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: executors must read checkpoints "
                               "written by other executors")
        configured = tempfile.mkdtemp(prefix="starloom-ckpt-")  # local runs and tests only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What the jobs inside shuffle is removed from the executors' disks as each ends.

    Without it shuffle files stay until the driver happens to collect its
    garbage.  For jobs that write a table: nothing reads their shuffles again.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def drop_path(spark: SparkSession, path: str, stays: bool = False) -> None:
    """Remove a folder of our own, on whatever file system it is; with ``stays`` the folder itself stays, empty."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.delete(at, True)
    if stays:
        system.mkdirs(at)
