"""Parquet folders and catalog tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reconlake.functions.columns import align_to, qualified
from reconlake.operators.counts import stack


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Snappy Parquet; a frame without rows still leaves its schema behind."""
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_parquet_counted(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> int:
    """Writes and returns the number of rows written, in the same job."""
    seen = Observation()
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, partition_by, mode)
    return seen.get["rows"]


def write_fanned_out(df: DataFrame, path: str, files: int = 32) -> None:
    """A fixed number of files. Prefer :func:`write_balanced`, which sizes them by bytes."""
    write_parquet(df.repartition(files), path)


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Evenly sized write tasks; rows with equal column values come together.

    Adaptive execution splits a value that is too big for one task and merges small ones.
    """
    return df.hint("rebalance", *columns)


def write_balanced(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    write_parquet(balanced(df, *partition_by), path, partition_by)


def ensure_schema(spark: SparkSession, *name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {qualified(*name)}{where}")


def use_catalog(spark: SparkSession, catalog: str) -> None:
    spark.catalog.setCurrentCatalog(catalog)


def create_empty(df: DataFrame, table: str, **options: str) -> None:
    """A table with the frame's columns and no rows."""
    df.limit(0).write.options(**options).saveAsTable(table)


def create_or_replace(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def create_only(df: DataFrame, table: str) -> None:
    """Fails when the table exists."""
    df.write.mode("errorifexists").saveAsTable(table)


def append(df: DataFrame, table: str) -> None:
    """Insert by position after the columns were matched by name."""
    target = df.sparkSession.table(table)
    align_to(df, target.columns).write.insertInto(table)


def overwrite(df: DataFrame, table: str) -> None:
    """Replace all rows; the frame must not read the table itself."""
    target = df.sparkSession.table(table)
    align_to(df, target.columns).write.insertInto(table, overwrite=True)


def append_counted(df: DataFrame, table: str) -> int:
    seen = Observation()
    append(df.observe(seen, F.count(F.lit(1)).alias("rows")), table)
    return seen.get["rows"]


def overwrite_counted(df: DataFrame, table: str) -> int:
    seen = Observation()
    overwrite(df.observe(seen, F.count(F.lit(1)).alias("rows")), table)
    return seen.get["rows"]


def replace_staged(df: DataFrame, table: str, staging: str) -> int:
    """Replace all rows by way of a staged copy; returns the number of staged rows.

    The table is touched only after the new rows are complete on storage, so a failing
    source cannot leave it empty, and the frame may read the table itself. Should the last
    step fail, the staged copy still holds every row.
    """
    spark = df.sparkSession
    rows = write_parquet_counted(df, staging)
    staged = spark.read.schema(df.schema).parquet(staging)
    overwrite(staged, table)
    return rows


def append_results(frames: Sequence[DataFrame], table: str) -> None:
    """Many small results as one plan and one append; creates the table when missing."""
    stack(frames).write.mode("append").saveAsTable(table)


@contextmanager
def temp_view(df: DataFrame, name: str) -> Iterator[str]:
    """The frame under a name for SQL, dropped afterwards."""
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)
