"""Chunk plans: by row offset and by time range."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reconlake.functions import dates, status
from reconlake.functions.columns import col

CHUNK = "chunk_id"
NO_TIME = -1  # chunk of the rows whose timestamp is NULL
_SECONDS_PER_DAY = 86_400
_PART, _POS = "__part", "__pos"


def offset_plan(spark: SparkSession, total_rows: int, chunk_size: int = 1_000_000) -> DataFrame:
    """chunk_id, offset and row count of each chunk of ``total_rows`` rows."""
    n = -(-total_rows // chunk_size)
    start = F.col("id") * F.lit(chunk_size)
    return spark.range(n).select(
        F.col("id").alias(CHUNK),
        start.alias("offset"),
        F.least(F.lit(chunk_size), F.lit(total_rows) - start).alias("rows"),
    )


def positioned(df: DataFrame) -> DataFrame:
    """Adds the task number and the position within the task of every row.

    Meant to be written out before it is used: the numbers are those of one execution.
    """
    rid = F.monotonically_increasing_id()
    return df.select(
        "*",
        F.shiftright(rid, 33).cast("int").alias(_PART),
        rid.bitwiseAND(F.lit((1 << 33) - 1)).alias(_POS),
    )


def range_ordered(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows range-partitioned and sorted by the keys, across tasks, ready for :func:`positioned`.

    The last key is a running number, so even rows that are equal in all keys are split
    between tasks.
    """
    order = [col(k) for k in keys]
    tie = "__tie"
    numbered = df.withColumn(tie, F.monotonically_increasing_id())
    return numbered.repartitionByRange(*order, F.col(tie)).sortWithinPartitions(*order, tie).drop(tie)


def numbered_chunks(staged: DataFrame, chunk_size: int) -> DataFrame:
    """chunk_id for rows that were written with :func:`positioned`; exact chunk sizes.

    Row numbers are the position in the task plus the rows of all earlier tasks. The prefix sum
    runs over one record per task, never over the rows.
    """
    sizes = staged.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(_PART, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    number = F.col("start") + F.col(_POS)
    # the broadcast side has one record per task of the staged write
    return (
        staged.join(F.broadcast(starts), _PART)
        .withColumn(CHUNK, dates.whole_quotient(number, F.lit(chunk_size)))
        .drop(_PART, _POS, "start")
    )


def time_bounds(df: DataFrame, ts: str) -> DataFrame:
    """First and last timestamp as wall clock, and all rows: one row, NULLs when there is none."""
    clock = col(ts).cast("timestamp_ntz")
    return df.agg(
        F.min(clock).alias("min_ts"), F.max(clock).alias("max_ts"), F.count(F.lit(1)).alias("rows")
    )


def _chunk_of(first: Column, clock: Column, chunk_days: int) -> Column:
    elapsed = dates.seconds_between(first, clock)
    return dates.whole_quotient(elapsed, F.lit(chunk_days * _SECONDS_PER_DAY))


def time_plan(bounds: DataFrame, chunk_days: int = 30) -> DataFrame:
    """Half-open ranges of ``chunk_days`` from the first to the last timestamp.

    The end of the last one is at most a day after the last timestamp. Without any timestamp
    there is no range.
    """
    lo, hi = F.col("min_ts"), F.col("max_ts")
    last = _chunk_of(lo, hi, chunk_days)
    ids = bounds.filter(lo.isNotNull()).select(
        lo, hi, F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias(CHUNK)
    )
    return ids.select(
        CHUNK,
        F.timestamp_add("DAY", F.col(CHUNK) * chunk_days, lo).alias("start_ts"),
        F.least(
            F.timestamp_add("DAY", (F.col(CHUNK) + 1) * chunk_days, lo),
            F.timestamp_add("DAY", F.lit(1), hi),
        ).alias("end_ts"),
    )


def with_time_chunk(
    df: DataFrame, ts: str, first: dt.datetime | None, chunk_days: int = 30
) -> DataFrame:
    """chunk_id of every row; rows without a timestamp go to chunk -1 instead of being lost.

    ``first`` is the first timestamp, as found by :func:`time_bounds`. The id is arithmetic on
    the row, so nothing is shuffled or joined.
    """
    if first is None:
        return df.withColumn(CHUNK, F.lit(NO_TIME).cast("bigint"))
    origin = F.lit(str(first)).cast("timestamp_ntz")
    chunk = _chunk_of(origin, col(ts).cast("timestamp_ntz"), chunk_days)
    return df.withColumn(CHUNK, F.coalesce(chunk, F.lit(NO_TIME)))


def manifest(chunked: DataFrame, key: str) -> DataFrame:
    """Rows and key range of each chunk."""
    return chunked.groupBy(CHUNK).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(col(key)).alias("min_key"),
        F.max(col(key)).alias("max_key"),
    )


def time_manifest(df: DataFrame, ts: str, chunk_days: int = 30) -> DataFrame:
    """Planned range and row count of each time chunk, ranges without rows included.

    One lazy plan: the first timestamp is a scalar subquery, so no join touches the rows.
    """
    bounds = time_bounds(df, ts)
    first = bounds.select("min_ts").scalar()
    chunk = _chunk_of(first, col(ts).cast("timestamp_ntz"), chunk_days)
    rows = (
        df.select(F.coalesce(chunk, F.lit(NO_TIME)).alias(CHUNK))
        .groupBy(CHUNK)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return time_plan(bounds, chunk_days).join(rows, CHUNK, "full").fillna(0, subset=["rows"])


def export_check(source_rows: int, chunk_rows: DataFrame, reread: DataFrame) -> DataFrame:
    """Source count against the sum over chunks and against a re-read of what was written."""
    counts = chunk_rows.select(F.lit("chunks").alias("side"), F.col("rows")).unionByName(
        reread.agg(F.count(F.lit(1)).alias("rows")).withColumn("side", F.lit("reread"))
    )

    def total(side: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col("rows"))), F.lit(0))

    agreed = (F.col("chunk_rows") == source_rows) & (F.col("reread_rows") == source_rows)
    return counts.agg(
        F.lit(source_rows).cast("bigint").alias("source_rows"),
        total("chunks").alias("chunk_rows"),
        total("reread").alias("reread_rows"),
    ).withColumn(
        "status",
        F.when(agreed, status.VALIDATION_SUCCESS).otherwise(status.VALIDATION_FAILED),
    )
