"""Day counts of tables whose date column is found on each side by itself.

Two catalogs may name, type or order the date columns of a table differently. Each side is counted by the
first date column that it has; a report says for each day whether the counts agree, and for each table whether
both sides were counted by the same column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reconlake.functions import dates, status
from reconlake.operators.counts import TablePair, stack
from reconlake.operators.discovery import column_sheet, date_profile

_LISTED = (
    "table_name string, source_date_column string, target_date_column string, "
    "source_fetch string, target_fetch string"
)


def found_dates(spark: SparkSession, tables: Mapping[str, DataFrame]) -> dict[str, str]:
    """First date column of each table that has one, from the schemas alone."""
    if not tables:
        return {}
    # positions stand for the names, which may have more parts than a sheet holds
    numbered = {str(i): df for i, df in enumerate(tables.values())}
    names = list(tables)
    found = date_profile(column_sheet(spark, numbered)).where("has_date")
    return {names[int(r.table_name)]: r.date_columns[0] for r in found.select("table_name", "date_columns").collect()}


def _fetch(df: DataFrame | None, error: str | None, column: str | None) -> str | None:
    """Why a side cannot be counted by day; None if it can."""
    if df is None:
        return f"ERROR: missing/access - {(error or '')[:200]}"
    if column is None:
        return status.SKIPPED_NO_DATE
    if column.lower() not in [c.lower() for c in df.columns]:
        return f"ERROR: no column {column}"
    return None


def reconcile_own_days(
    spark: SparkSession,
    pairs: Sequence[TablePair],
    start_date: str,
    source_dates: Mapping[str, str] | None = None,
    target_dates: Mapping[str, str] | None = None,
) -> DataFrame:
    """Day counts of many tables, each side by its own date column; one exchange for all tables.

    Columns: table_name, dpYear, dpMonth, dpDay, source_count, target_count, validation_status (Not Applicable for a
    day that one side lacks), source_date_column, target_date_column, date_column_validation, source_fetch and
    target_fetch (SUCCESS, or why a side has no days). A table that has no day on either side is one row
    without a day. Rows without a date are in no day. Date columns that are not given are found by type and name.
    """
    if source_dates is None:
        source_dates = found_dates(spark, {p.table_name: p.source for p in pairs if p.source is not None})
    if target_dates is None:
        target_dates = found_dates(spark, {p.table_name: p.target for p in pairs if p.target is not None})
    listed, days = [], []
    for p in pairs:
        name, columns = p.table_name, (source_dates.get(p.table_name), target_dates.get(p.table_name))
        sides = ((p.source, p.source_error), (p.target, p.target_error))
        notes = [_fetch(df, error, column) for (df, error), column in zip(sides, columns)]
        listed.append((name, *columns, *notes))
        for is_source, (df, _), column, note in zip((True, False), sides, columns, notes):
            if note is None:
                kept = dates.since(df, column, start_date)
                day = dates.as_temporal(kept, column).cast("date").alias("day")
                days.append(kept.select(F.lit(name).alias("table_name"), day, F.lit(is_source).alias("from_source")))
    tables = spark.createDataFrame(listed, _LISTED)
    none = tables.select("table_name", F.lit(None).cast("date").alias("day"), F.lit(None).cast("boolean").alias("from_source"))
    counts = stack([none, *days]).groupBy("table_name", "day").agg(
        F.nullif(F.count_if("from_source"), F.lit(0)).alias("source_count"),
        F.nullif(F.count_if(~F.col("from_source")), F.lit(0)).alias("target_count"),
    )
    of_table = Window.partitionBy("table_name")
    known = counts.withColumns(
        {
            "last_day": F.max("day").over(of_table),
            "in_source": F.count(F.when(F.col("day").isNotNull(), F.col("source_count"))).over(of_table) > 0,
            "in_target": F.count(F.when(F.col("day").isNotNull(), F.col("target_count"))).over(of_table) > 0,
        }
    ).where("day IS NOT NULL OR last_day IS NULL")

    def fetch(side: str):
        nothing = F.lit(f"no_data_since_{start_date}")
        return F.coalesce(f"{side}_fetch", F.when(F.col(f"in_{side}"), F.lit(status.SUCCESS)).otherwise(nothing))

    # undated rows are counted under no day; they are no count of a day
    dated = {c: F.when(F.col("day").isNotNull(), F.col(c)) for c in ("source_count", "target_count")}
    return known.withColumns(dated).join(tables, "table_name").select(
        "table_name",
        F.year("day").alias("dpYear"),
        F.month("day").alias("dpMonth"),
        F.day("day").alias("dpDay"),
        "source_count",
        "target_count",
        status.three_way_label(F.col("source_count"), F.col("target_count")).alias("validation_status"),
        "source_date_column",
        "target_date_column",
        status.same_column_label(F.col("source_date_column"), F.col("target_date_column")).alias("date_column_validation"),
        fetch("source").alias("source_fetch"),
        fetch("target").alias("target_fetch"),
    )


def table_days(days: DataFrame) -> DataFrame:
    """Per table of :func:`reconcile_own_days`: both counts, days seen, days that differ, and whether all agree.

    All agree if there is a day, every day has one count on both sides, and one column dates both.
    """
    differs = F.col("dpDay").isNotNull() & (F.col("validation_status") != "Success")
    return days.groupBy("table_name").agg(
        F.sum("source_count").alias("source_count"),
        F.sum("target_count").alias("target_count"),
        F.count("dpDay").alias("days"),
        F.count_if(differs).alias("differing_days"),
        F.bool_and((F.col("validation_status") == "Success") & (F.col("date_column_validation") == "Success")).alias("equal"),
    )
