"""Chunked exports to Parquet, by row offset and by time range."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.operators import chunks, keyset
from reconlake.operators.even_chunks import EvenChunks
from reconlake.operators.repair import repair_numbers
from reconlake.session import scratch_path
from reconlake.sinks import tables as sink
from reconlake.sources import jdbc


#: Chunk folders of an export at most. With more chunks than that, neighbours share a folder, where the chunk is a
#: column by which files are sorted: a file and a folder per small chunk cost more than its rows.
MOST_FOLDERS = 1_000
#: Partition column of shared folders: the first chunk that a folder may hold.
FOLDER = "chunks_from"


@dataclass(frozen=True)
class Export:
    """What was written: the folder, its manifest (one row per chunk), the three-way check, and the planned limits.

    A manifest's ``path`` is the folder that holds the chunk, by itself or, beyond MOST_FOLDERS, among others.
    """

    path: str
    source_rows: int
    manifest: DataFrame
    check: DataFrame
    plan: DataFrame | None = None


def chunk_path(path: str, chunk_id: int) -> str:
    return f"{path}/{chunks.CHUNK}={chunk_id}"


def _finish(path: str, written: DataFrame, source_rows: int, plan: DataFrame | None = None) -> Export:
    # grouping by the partition column alone is answered from file footers
    folder = FOLDER if FOLDER in written.columns else chunks.CHUNK
    counts = written.groupBy(*{chunks.CHUNK, folder}).agg(F.count(F.lit(1)).alias("rows"))
    where = F.concat(F.lit(f"{path}/{folder}="), F.col(folder).cast("string"))
    listed = counts.select(chunks.CHUNK, "rows", where.alias("path"))
    return Export(path, source_rows, listed, chunks.export_check(source_rows, counts, written), plan)


def _write_chunks(
    chunked: DataFrame, path: str, source_rows: int, rows_per_chunk: int, plan: DataFrame | None = None, balanced: bool = True
) -> Export:
    """Writes rows that know their chunk; chunk ids are below the number of chunks that the rows fill, or -1."""
    most = source_rows // rows_per_chunk + 1
    together = -(-most // MOST_FOLDERS)
    folder = chunks.CHUNK
    if together > 1:
        chunk, folder = F.col(chunks.CHUNK), FOLDER
        chunked = chunked.withColumn(FOLDER, F.when(chunk < 0, chunk).otherwise(chunk - chunk % together))
    if source_rows == 0:
        # no chunk folder would exist, so the empty table is written in one piece
        sink.write_parquet(chunked, path)
    else:
        out = sink.balanced(chunked, folder) if balanced else chunked
        if together > 1:
            out = out.sortWithinPartitions(FOLDER, chunks.CHUNK)
        sink.write_parquet(out, path, [folder])
    return _finish(path, chunked.sparkSession.read.schema(chunked.schema).parquet(path), source_rows, plan)


def export_by_offset(
    df: DataFrame, path: str, chunk_size: int = 1_000_000, order_by: Sequence[str] = ()
) -> Export:
    """Chunks of exactly ``chunk_size`` rows, the last one shorter, below ``path``.

    Rows keep the order of the scan, or a global order by the given keys. They are staged once
    with their position, so that the numbering cannot change between counting and writing;
    after that a row's chunk is arithmetic and the final write shuffles nothing.
    """
    spark = df.sparkSession
    ordered = chunks.range_ordered(df, list(order_by)) if order_by else df
    staging = scratch_path(spark, "export")
    source_rows = sink.write_parquet_counted(chunks.positioned(ordered), staging)
    numbered = chunks.numbered_chunks(spark.read.parquet(staging), chunk_size)
    return _write_chunks(numbered, path, source_rows, chunk_size, balanced=False)


def export_by_offset_repaired(
    df: DataFrame,
    path: str,
    chunk_size: int = 5_000_000,
    order_by: Sequence[str] = (),
    decimals_to: str = "double",
) -> Export:
    """The same after decimals were brought to a type that every reader accepts."""
    return export_by_offset(repair_numbers(df, decimals_to), path, chunk_size, order_by)


def export_by_time(df: DataFrame, path: str, ts: str, chunk_days: int = 30) -> Export:
    """One folder per time range below ``path``; rows without a timestamp go to chunk -1.

    Write tasks are balanced by size: a range that holds most rows is split over several.
    """
    spark = df.sparkSession
    found = chunks.time_bounds(df, ts).first()
    chunked = chunks.with_time_chunk(df, ts, found["min_ts"], chunk_days)
    source_rows = found["rows"]
    if source_rows == 0:
        sink.write_parquet(chunked, path)
    else:
        sink.write_balanced(chunked, path, [chunks.CHUNK])
    written = spark.read.schema(chunked.schema).parquet(path)
    return _finish(path, written, source_rows)


def export_remote_by_time(
    spark: SparkSession,
    url: str,
    name: str,
    ts: str,
    path: str,
    chunk_days: int = 30,
    reads_per_chunk: int = 1,
    column: str | None = None,
    literal: str = "TIMESTAMP '{}'",
    **options: str,
) -> Export:
    """The same from a remote table: bounds and row count come from the database.

    Every time range is read by ``reads_per_chunk`` tasks with a predicate of their own; raise it
    when one range holds much of the table. ``column`` is the SQL of the timestamp column when
    that differs from its name.
    """
    column = column or ts
    found = jdbc.time_bounds(spark, url, name, column, **options).first()
    source_rows, first, last = int(found["rows"]), found["min_ts"], found["max_ts"]
    ranges = []
    if first is not None:
        step = dt.timedelta(days=chunk_days) / reads_per_chunk
        start = first
        while start <= last:
            end = start + step if start <= dt.datetime.max - step else None
            ranges.append((start, end))
            if end is None:
                break
            start = end
    predicates = jdbc.time_predicates(column, ranges, literal=literal)
    rows = jdbc.by_predicates(spark, url, name, predicates, **options)
    chunked = chunks.with_time_chunk(rows, ts, first, chunk_days)
    if source_rows == 0:
        sink.write_parquet(chunked, path)
    else:
        # a read task holds rows of one chunk already, so nothing is shuffled
        sink.write_parquet(chunked, path, [chunks.CHUNK])
    written = spark.read.schema(chunked.schema).parquet(path)
    return _finish(path, written, source_rows)


def export_by_time_even(df: DataFrame, path: str, ts: str, rows_per_chunk: int = 1_000_000) -> Export:
    """One folder per time range of about equal rows (up to MOST_FOLDERS); rows without a timestamp go to chunk -1.

    The ranges come from a histogram (see :mod:`reconlake.operators.even_chunks`), so empty spans make none,
    and a busy hour is cut as far down as it has to be.
    """
    even = EvenChunks.of(df, ts, rows_per_chunk)
    return _write_chunks(even.assign(df, ts), path, df.count(), rows_per_chunk, even.plan())


def export_remote_by_time_even(
    spark: SparkSession,
    url: str,
    name: str,
    ts: str,
    path: str,
    rows_per_chunk: int = 1_000_000,
    connections: int = 8,
    column: str | None = None,
    literal: str = "TIMESTAMP '{}'",
    part: str = "EXTRACT({part} FROM {column})",
    **options: str,
) -> Export:
    """The same from a remote table: the database counts its rows per day, and per hour if a day is dense.

    Only ranges that hold rows are read, by at most ``connections`` tasks at a time, however many ranges
    there are.
    """
    column = column or ts
    keys = ("YEAR", "MONTH", "DAY", "HOUR")

    def counts(parts: tuple[str, ...]) -> DataFrame:
        found = jdbc.period_counts(spark, url, name, column, None, parts, part, **options)
        day = F.unix_date(F.make_date("dpYear", "dpMonth", "dpDay")).cast("bigint")
        hour = F.col("dpHour").cast("bigint") if "HOUR" in parts else F.lit(0).cast("bigint")
        return found.select(((day * 24 + hour) * 3_600_000_000).alias("begin"), F.col("source_count").alias("n"))

    source_rows = int(jdbc.row_count(spark, url, name, **options).first()[0])
    even = EvenChunks.of_counts(counts(keys[:3]), counts(keys), rows_per_chunk)
    plan = even.plan()
    ranges = [(r["start_ts"], r["end_ts"]) for r in plan.orderBy(chunks.CHUNK).collect()]
    predicates = jdbc.time_predicates(column, ranges, literal=literal)
    rows = jdbc.by_predicates(spark, url, name, predicates, **options).coalesce(connections)
    return _write_chunks(even.assign(rows, ts), path, source_rows, rows_per_chunk, plan)


def export_by_key(df: DataFrame, path: str, key: str, rows_per_chunk: int = 1_000_000) -> Export:
    """One folder per range of the key (up to MOST_FOLDERS); rows without a key go to chunk -1.

    No sort and no row numbers: the limits of the ranges are exact quantiles, and a row's chunk follows from
    its key.
    """
    pages = keyset.key_pages(df, key, rows_per_chunk)
    chunked = keyset.with_key_page(df, key, [upto for _, upto in _limits(pages)])
    return _write_chunks(chunked, path, df.count(), rows_per_chunk, pages)


def _limits(pages: DataFrame) -> list[tuple]:
    """(after_key, upto_key) of each page; one entry per page comes to the driver."""
    return [(r["after_key"], r["upto_key"]) for r in pages.orderBy(chunks.CHUNK).collect()]


def export_remote_by_key(
    spark: SparkSession,
    url: str,
    name: str,
    key: str,
    path: str,
    rows_per_chunk: int = 1_000_000,
    connections: int = 8,
    column: str | None = None,
    **options: str,
) -> Export:
    """The same from a remote table, page by page as ``key > a AND key <= b``; no row is counted off or skipped.

    The key column is read once to find the limits; at most ``connections`` pages are read at a time.
    """
    column = column or key
    keys = jdbc.table(spark, url, f"(SELECT {column} FROM {name}) keys_only", **options).toDF(key)
    staged = scratch_path(spark, "remote-keys")
    source_rows = sink.write_parquet_counted(keys, staged)
    pages = keyset.key_pages(spark.read.schema(keys.schema).parquet(staged), key, rows_per_chunk)
    limits = _limits(pages)
    predicates = keyset.key_predicates(column, limits)
    rows = jdbc.by_predicates(spark, url, name, predicates, **options).coalesce(connections)
    chunked = keyset.with_key_page(rows, key, [upto for _, upto in limits])
    return _write_chunks(chunked, path, source_rows, rows_per_chunk, pages)
