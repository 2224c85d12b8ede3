"""What operators with Python code on the executors share."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import SparkSession

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package wherever the driver was started.

    On a cluster the package comes with ``--py-files``; the extra path does no harm there.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, PACKAGE_ROOT])


#: Bytes of an Arrow batch of texts: neither side of a Python worker holds more of them at once.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Limits batches by size, not only by their 10,000 rows, unless the session has a lower limit."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if now is None or not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


_TABLES: dict[str, Callable[[], None]] = {}


def keeps(owner: str, drop: Callable[[], None]) -> None:
    """Says how to drop the lookup tables that an operator keeps from task to task."""
    _TABLES[owner] = drop


_LAST: list[str] = []


def in_use(owner: str) -> None:
    """Drops the tables of all other operators, and hands back what Arrow keeps of them: a worker that serves
    one stage after the other then holds those of one only."""
    if _LAST == [owner]:
        return
    _LAST[:] = [owner]
    for name, drop in _TABLES.items():
        if name != owner:
            drop()
    gc.collect()
    pa.default_memory_pool().release_unused()
