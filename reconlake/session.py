"""Session helpers: a local session for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with UTC as time zone. A cluster session comes from the caller."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reconlake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="reconlake-warehouse-"))
        .getOrCreate()
    )


# the setting itself belongs to the core and cannot be set in a running session
_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    In local mode without that setting a temporary folder is made once per session; on a
    cluster a missing setting is an error, since executors could not share a local folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="reconlake-scratch-")
    return _LOCAL_ROOTS[application]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`scratch_path` named; nothing else is ever deleted."""
    root = scratch_root(spark)
    if not path.startswith(f"{root}/") or ".." in path:
        raise ValueError(f"{path} is not below {root}")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs inside delete their shuffle files when they end, and not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the scratch folder; nothing is created yet."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"
