"""Append-only audit log.

Every attempt is a pair of events with one run id: IN_PROGRESS when it starts and a final status
when it ends. Nothing is updated in place, so plain Parquet tables are enough.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

IN_PROGRESS, SUCCESS, ERROR, SKIPPED = "IN_PROGRESS", "SUCCESS", "ERROR", "SKIPPED"

AUDIT = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("partition_columns", T.StringType()),
        T.StructField("managed_table", T.StringType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)
MIGRATION_LOG = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("source_count", T.LongType()),
        T.StructField("target_count", T.LongType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
    ]
)


def started(run_id: str, table: str, at: dt.datetime, path: str | None = None,
            partition_columns: str | None = None) -> tuple:
    return (run_id, table, path, at, at, None, IN_PROGRESS, partition_columns, table, 0, None)


def finished(run_id: str, table: str, start: dt.datetime, end: dt.datetime, status: str,
             rows: int = 0, error: str | None = None, path: str | None = None,
             partition_columns: str | None = None) -> tuple:
    return (run_id, table, path, end, start, end, status, partition_columns, table, rows, error)


def events(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), AUDIT)


def migration_log(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), MIGRATION_LOG)


def latest_status(log: DataFrame) -> DataFrame:
    """Last event of every table, whole history in one grouping.

    Events of the same instant are ordered by run id, and a final status beats IN_PROGRESS.
    """
    order = F.struct(
        "event_time",
        "run_id",
        (F.col("status") != IN_PROGRESS).alias("is_final"),
        "status",
        "rows_processed",
    )
    last = log.groupBy("table_name").agg(F.max(order).alias("last"))
    return last.select(
        "table_name",
        F.col("last.status").alias("status"),
        F.col("last.event_time").alias("event_time"),
        F.col("last.run_id").alias("run_id"),
        F.col("last.rows_processed").alias("rows_processed"),
    )


def pending(tasks: DataFrame, log: DataFrame, skip_statuses: Sequence[str] = (SUCCESS,)) -> DataFrame:
    """Tasks whose latest status is not one of those that mean done."""
    done = latest_status(log).filter(F.col("status").isin(*skip_statuses)).select("table_name")
    return tasks.join(done, "table_name", "left_anti")


def run_summary(log: DataFrame) -> DataFrame:
    """Number of rows per status."""
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("tables"))
