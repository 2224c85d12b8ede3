"""Full, guarded and incremental loads, and catalog copies."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from reconlake.errors import ENGINE_ERRORS
from reconlake.functions import dates, status
from reconlake.functions.columns import align_to
from reconlake.operators import audit, key_sketches
from reconlake.operators.incremental import incremental_rows, rows_not_in
from reconlake.operators.repair import apply_decisions, misfits, profile
from reconlake.operators.schema_guard import frame_differences
from reconlake.session import discard, scratch_path
from reconlake.sinks import tables as sink


@dataclass(frozen=True)
class LoadResult:
    table: str
    status: str
    source_rows: int = 0
    target_rows: int = 0
    error: str | None = None
    misfits: Mapping[str, int] = field(default_factory=dict)


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def verify_counts(table: str, source_rows: int, target_rows: int) -> LoadResult:
    same = source_rows == target_rows
    return LoadResult(
        table,
        status.VALIDATION_SUCCESS if same else status.VALIDATION_FAILED,
        source_rows,
        target_rows,
        None if same else f"source has {source_rows} rows, target {target_rows}",
    )


def full_load(df: DataFrame, table: str, source_rows: int | None = None) -> LoadResult:
    """Create the table when missing, replace its rows, compare counts.

    The source is counted by a scan of its own, or apart by the caller (``source_rows``); what was
    written is no evidence. A source read with ``tolerant=True`` has to be counted apart, or its
    skipped files reported by :func:`reconlake.sources.files.skipped_files`.
    """
    spark = df.sparkSession
    expected = df.count() if source_rows is None else source_rows
    if not spark.catalog.tableExists(table):
        sink.create_empty(df, table)
    sink.overwrite_counted(df, table)
    return verify_counts(table, expected, spark.table(table).count())


def schema_conflicts(df: DataFrame, table: str) -> list[str]:
    """Differences between a frame and an existing table, position by position.

    The list is at most as long as the wider of the two schemas.
    """
    rows = frame_differences(df.sparkSession, df, df.sparkSession.table(table))
    return [
        f"Column {r.ordinal_position}: source {r.source_column} ({r.source_type}), "
        f"target {r.target_column} ({r.target_type})"
        for r in rows.orderBy("ordinal_position").collect()
    ]


def guarded_load(
    df: DataFrame,
    table: str,
    declared: Mapping[str, str] | None = None,
    zone: str | None = "Asia/Kolkata",
    source_rows: int | None = None,
) -> LoadResult:
    """Repair dates, move timestamps to UTC, check the schema, replace the rows, compare counts.

    On a schema conflict the table is left as it is. Values that have not the form of their column are
    NULL in the table; the result counts them per column and is then no success.
    """
    spark = df.sparkSession
    expected = df.count() if source_rows is None else source_rows
    decisions = profile(df, declared or {})
    ready = apply_decisions(df, decisions)
    if zone:
        ready = dates.to_utc(ready, zone)
    if spark.catalog.tableExists(table):
        conflicts = schema_conflicts(ready, table)
        if conflicts:
            return LoadResult(table, "COPY_FAILURE", error="\n".join(conflicts))
        staging = scratch_path(spark, "load")
        sink.replace_staged(ready, table, staging)
        discard(spark, staging)
    else:
        sink.create_empty(ready, table)
        sink.append_counted(ready, table)
    result = verify_counts(table, expected, spark.table(table).count())
    lost = misfits(decisions)
    if lost:
        text = ", ".join(f"{n} values of {name} do not fit" for name, n in sorted(lost.items()))
        result = replace(
            result,
            status=status.VALIDATION_FAILED,
            error="; ".join(filter(None, [result.error, text])),
            misfits=lost,
        )
    return result


def incremental_load(
    new: DataFrame,
    table: str,
    date_column: str | None,
    cutoff: str | dt.date,
    null_safe: bool = True,
    dedupe: bool = False,
) -> LoadResult:
    """Append the rows after the cutoff that the table lacks; rows are counted as written."""
    spark = new.sparkSession
    if not spark.catalog.tableExists(table):
        return LoadResult(table, audit.ERROR, error=f"Target table {table} does not exist")
    if date_column is None:
        return LoadResult(table, audit.SKIPPED, error=f"No date column in {table}")
    rows = incremental_rows(new, spark.table(table), date_column, cutoff, null_safe, dedupe)
    inserted = sink.append_counted(rows, table)
    return LoadResult(table, audit.SUCCESS, inserted, inserted)


def indexed_load(new: DataFrame, table: str, sketches: str, date_column: str, cutoff: str | dt.date) -> LoadResult:
    """The incremental load of a large table: only files that may hold rows of the delta are read.

    ``sketches`` is the folder of :mod:`reconlake.operators.key_sketches`, made at the first load; later loads add
    those of the files they wrote. Files without a sketch are read, so a lost folder costs time, not rows.
    """
    spark = new.sparkSession
    if not spark.catalog.tableExists(table):
        return LoadResult(table, audit.ERROR, error=f"Target table {table} does not exist")
    if not key_sketches.exist(spark, sketches):
        key_sketches.write_sketches(spark.table(table), sketches, date_column)
    delta = dates.after(align_to(new, spark.table(table).columns), date_column, cutoff)
    narrowed = key_sketches.may_hold(spark.table(table), delta, sketches)
    rows = rows_not_in(delta, dates.after(narrowed, date_column, cutoff))
    inserted = sink.append_counted(rows, table)
    key_sketches.add_sketches(spark.table(table), sketches)
    return LoadResult(table, audit.SUCCESS, inserted, inserted)


def copy_tables(
    spark: SparkSession,
    names: Sequence[str],
    source_name: Callable[[str], str],
    target_name: Callable[[str], str],
) -> DataFrame:
    """Copy each table, compare counts, and return one log row per table.

    A table that fails is a row with its error; the others go on.
    """
    rows = []
    for name in names:
        start, source, target = now(), source_name(name), target_name(name)
        if not spark.catalog.tableExists(source):
            error = f"Source table {source} does not exist"
            rows.append((name, source, target, "FAILED", None, None, error, start, now()))
            continue
        try:
            df = spark.table(source)
            sink.create_or_replace(df, target)
            n_source, n_target = df.count(), spark.table(target).count()
            outcome = "SUCCESS" if n_source == n_target else "COUNT_MISMATCH"
            rows.append((name, source, target, outcome, n_source, n_target, None, start, now()))
        except ENGINE_ERRORS as e:
            rows.append((name, source, target, "FAILED", None, None, str(e), start, now()))
    return audit.migration_log(spark, rows)


def audited(
    spark: SparkSession,
    log_table: str,
    table: str,
    work: Callable[[], LoadResult],
    skip_statuses: Sequence[str] = (audit.SUCCESS,),
    path: str | None = None,
    partition_columns: str | None = None,
) -> LoadResult:
    """Run one load between two audit events, unless its latest status means done.

    Whatever the work raises, the end event is written; errors that are not the engine's go on.
    """
    if spark.catalog.tableExists(log_table):
        task = spark.createDataFrame([(table,)], "table_name string")
        if audit.pending(task, spark.table(log_table), skip_statuses).isEmpty():
            return LoadResult(table, audit.SKIPPED)
    run, start = uuid.uuid4().hex, now()
    first = audit.events(spark, [audit.started(run, table, start, path, partition_columns)])
    first.write.mode("append").saveAsTable(log_table)
    unknown: BaseException | None = None
    try:
        result = work()
    except BaseException as e:
        unknown = None if isinstance(e, (*ENGINE_ERRORS, ValueError)) else e
        result = LoadResult(table, audit.ERROR, error=str(e) or type(e).__name__)
    good = result.status in (audit.SUCCESS, status.VALIDATION_SUCCESS)
    final = audit.SUCCESS if good else result.status
    if result.status in (status.VALIDATION_FAILED, "COPY_FAILURE"):
        final = audit.ERROR
    last = audit.finished(
        run, table, start, now(), final, result.target_rows, result.error, path, partition_columns
    )
    audit.events(spark, [last]).write.mode("append").saveAsTable(log_table)
    if unknown is not None:
        raise unknown
    return result


def pending_tables(
    spark: SparkSession, tasks: DataFrame, log_table: str, skip_statuses: Sequence[str] = (audit.SUCCESS,)
) -> DataFrame:
    """Tasks still to do; all of them when there is no log yet."""
    if not spark.catalog.tableExists(log_table):
        return tasks
    return audit.pending(tasks, spark.table(log_table), skip_statuses)
