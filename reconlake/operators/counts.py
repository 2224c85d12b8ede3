"""Count reconciliation: total, per month, per day, and date ranges.

Both sides are stacked and grouped once, instead of being grouped apart and full-joined. Partial
aggregation runs next to each scan, so the single exchange carries at most one row per task and
group however skewed the tables are, and NULL keys meet each other as they should. Any number
of table pairs share one plan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reconlake.functions import dates, status
from reconlake.functions.columns import cast_to, col

DAY_RESULT = T.StructType(
    [
        T.StructField("target_table_name", T.StringType()),
        T.StructField("dpYear", T.IntegerType()),
        T.StructField("dpMonth", T.IntegerType()),
        T.StructField("dpDay", T.IntegerType()),
        T.StructField("source_count", T.LongType()),
        T.StructField("target_count", T.LongType()),
        T.StructField("validation_status", T.StringType()),
        T.StructField("date_column_used", T.StringType()),
    ]
)
MONTH_RESULT = T.StructType([f for f in DAY_RESULT.fields if f.name != "dpDay"])
TOTAL_RESULT = T.StructType(
    [
        T.StructField("source_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("catalog_table", T.StringType()),
        T.StructField("source_count", T.LongType()),
        T.StructField("catalog_count", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("source_error", T.StringType()),
        T.StructField("catalog_error", T.StringType()),
    ]
)


@dataclass(frozen=True)
class TablePair:
    """One table on both sides. A side that could not be opened is None with its error text."""

    table_name: str
    source: DataFrame | None
    target: DataFrame | None
    date_column: str | None = None
    source_error: str | None = None
    target_error: str | None = None
    comparable: bool = True


def stack(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of the frames, in their order. Joined in pairs, so that no frame is analysed once per other."""
    frames = list(frames)
    while len(frames) > 1:
        pairs = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2])]
        frames = pairs + frames[len(pairs) * 2 :]
    return frames[0]


def side_counts(
    source: DataFrame, target: DataFrame, always: DataFrame | None = None
) -> DataFrame:
    """Rows per distinct key on both sides; the frames hold key columns only.

    A key that one side lacks has count 0 there. The keys in ``always`` are reported even when
    neither side has them.
    """
    keys = source.columns
    tagged = source.withColumn("from_source", F.lit(True)).unionByName(
        target.withColumn("from_source", F.lit(False))
    )
    if always is not None:
        tagged = tagged.unionByName(
            always.withColumn("from_source", F.lit(None).cast("boolean")), allowMissingColumns=True
        )
    return tagged.groupBy(*[col(k) for k in keys]).agg(
        F.count_if(F.col("from_source")).alias("source_count"),
        F.count_if(~F.col("from_source")).alias("target_count"),
    )


def merge_counts(
    source: DataFrame, target: DataFrame, keys: Sequence[str], missing: int | None = 0
) -> DataFrame:
    """Both counts per key, from sides that were counted apart, such as in a remote database.

    ``source`` has the keys and source_count, ``target`` the keys and target_count. A key that a
    side lacks gets ``missing`` there; None leaves it unknown.
    """
    counted = source.select(*keys, "source_count").unionByName(
        target.select(*keys, "target_count"), allowMissingColumns=True
    )
    sums = [F.sum(c) for c in ("source_count", "target_count")]
    if missing is not None:
        sums = [F.coalesce(c, F.lit(missing)) for c in sums]
    return counted.groupBy(*[col(k) for k in keys]).agg(
        sums[0].alias("source_count"), sums[1].alias("target_count")
    )


def one_sided_days(df: DataFrame, date_column: str, start_date: str | None, name: str) -> DataFrame:
    """Rows per dpYear, dpMonth, dpDay of one side, in a column of the given name."""
    days = _day_keys(df, date_column, start_date, ()).groupBy("day").agg(F.count(F.lit(1)).alias(name))
    return days.select(
        F.year("day").alias("dpYear"), F.month("day").alias("dpMonth"), F.day("day").alias("dpDay"), name
    )


def _day(df: DataFrame, date_column: str) -> Column:
    return dates.as_temporal(df, date_column).cast("date")


def _day_keys(
    df: DataFrame, date_column: str, start_date: str | None, by: Sequence[str]
) -> DataFrame:
    kept = dates.since(df, date_column, start_date)
    return kept.select(*[col(b) for b in by], _day(kept, date_column).alias("day"))


def _month_keys(
    df: DataFrame, date_column: str, start_date: str | None, by: Sequence[str]
) -> DataFrame:
    kept = dates.since(df, date_column, start_date)
    # one 4-byte key per row; year and month are taken from it after the grouping
    return kept.select(*[col(b) for b in by], F.last_day(_day(kept, date_column)).alias("month"))


def day_counts(
    source: DataFrame,
    target: DataFrame,
    date_column: str,
    start_date: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Counts per ``by`` group and day: dpYear, dpMonth, dpDay, source_count, target_count."""
    counts = side_counts(
        _day_keys(source, date_column, start_date, by),
        _day_keys(target, date_column, start_date, by),
    )
    return counts.select(
        *[col(b) for b in by],
        F.year("day").alias("dpYear"),
        F.month("day").alias("dpMonth"),
        F.day("day").alias("dpDay"),
        "source_count",
        "target_count",
    )


def month_counts(
    source: DataFrame,
    target: DataFrame,
    date_column: str,
    start_date: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Counts per ``by`` group and month."""
    counts = side_counts(
        _month_keys(source, date_column, start_date, by),
        _month_keys(target, date_column, start_date, by),
    )
    return counts.select(
        *[col(b) for b in by],
        F.year("month").alias("dpYear"),
        F.month("month").alias("dpMonth"),
        "source_count",
        "target_count",
    )


def with_status(counts: DataFrame) -> DataFrame:
    return counts.withColumn(
        "validation_status", status.equal_label(F.col("source_count"), F.col("target_count"))
    )


def three_way(
    counts: DataFrame,
    source_date_column: Column | None = None,
    target_date_column: Column | None = None,
    common_days_only: bool = False,
) -> DataFrame:
    """Day counts with the three-way status: a day that only one side has is Not Applicable.

    ``common_days_only`` drops the days that the source lacks, as an older report did; by
    default they stay visible.
    """
    known = counts.withColumns(
        {
            "source_count": F.nullif(F.col("source_count"), F.lit(0)),
            "target_count": F.nullif(F.col("target_count"), F.lit(0)),
        }
    )
    if common_days_only:
        known = known.filter(F.col("source_count").isNotNull())
    out = known.withColumn(
        "validation_status", status.three_way_label(F.col("source_count"), F.col("target_count"))
    )
    if source_date_column is not None and target_date_column is not None:
        out = out.withColumn(
            "date_column_validation",
            status.same_column_label(source_date_column, target_date_column),
        )
    return out


def _literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def readable_pair(p: TablePair) -> bool:
    return p.comparable and p.source is not None and p.target is not None


def checked_columns(p: TablePair) -> TablePair:
    """A side that lacks the date column counts as one that cannot be read, with the reason."""

    def lacks(df: DataFrame | None) -> bool:
        return df is not None and p.date_column.lower() not in [c.lower() for c in df.columns]

    error = f"no column {p.date_column}"
    if p.date_column and lacks(p.source):
        p = replace(p, source=None, source_error=error)
    if p.date_column and lacks(p.target):
        p = replace(p, target=None, target_error=error)
    return p


def _error_text(p: TablePair, longest: int | None = None) -> str:
    if p.target is None:
        return f"ERROR: target missing/access - {(p.target_error or '')[:longest]}"
    return f"ERROR: source query - {(p.source_error or '')[:longest]}"


def reconcile_days(
    spark: SparkSession, pairs: Sequence[TablePair], start_date: str
) -> DataFrame:
    """Day-wise report over many tables in one plan, in ``DAY_RESULT`` form.

    A table without a date column, an unreadable side, and a table with no rows since
    ``start_date`` on either side each give one row that says so.
    """
    pairs = [checked_columns(p) for p in pairs]
    checked = [p for p in pairs if readable_pair(p) and p.date_column]
    notes = [
        (
            p.table_name,
            *[None] * 5,
            status.SKIPPED_NO_DATE if readable_pair(p) else _error_text(p, 200),
            p.date_column,
        )
        for p in pairs
        if not (readable_pair(p) and p.date_column)
    ]
    parts = []
    if checked:
        by = ["target_table_name", "date_column_used"]

        def side(p: TablePair, df: DataFrame) -> DataFrame:
            kept = dates.since(df, p.date_column, start_date)
            return kept.select(
                F.lit(p.table_name).alias(by[0]),
                F.lit(p.date_column).alias(by[1]),
                _day(kept, p.date_column).alias("day"),
            )

        listed = _literal_rows(
            spark,
            [(p.table_name, p.date_column) for p in checked],
            T.StructType([DAY_RESULT[0], DAY_RESULT[7]]),
        )
        counts = side_counts(
            stack(side(p, p.source) for p in checked),
            stack(side(p, p.target) for p in checked),
            listed,
        )
        # the listed key without a day stays only where the table has no day at all
        last_day = F.max("day").over(Window.partitionBy(by[0]))
        kept = counts.withColumn("last_day", last_day).filter(
            F.col("day").isNotNull() | F.col("last_day").isNull()
        )
        found = F.col("day").isNotNull()
        parts.append(
            kept.select(
                by[0],
                F.year("day").alias("dpYear"),
                F.month("day").alias("dpMonth"),
                F.day("day").alias("dpDay"),
                F.when(found, F.col("source_count")).alias("source_count"),
                F.when(found, F.col("target_count")).alias("target_count"),
                F.when(found, status.equal_label(F.col("source_count"), F.col("target_count")))
                .otherwise(f"not_data_found_since_{start_date}")
                .alias("validation_status"),
                by[1],
            )
        )
    if notes or not parts:
        parts.append(_literal_rows(spark, notes, DAY_RESULT))
    return stack(parts)


def reconcile_months(spark: SparkSession, pairs: Sequence[TablePair]) -> DataFrame:
    """Month-wise report over many tables; a table without a date column is counted in total.

    A table of which no date is known has one row that says so; see :func:`undated_rows`.
    """
    pairs = [checked_columns(p) for p in pairs]
    notes = [
        (p.table_name, *[None] * 4, _error_text(p), p.date_column)
        for p in pairs
        if not readable_pair(p)
    ]
    checked = [p for p in pairs if readable_pair(p)]
    parts = []
    if checked:

        def side(p: TablePair, df: DataFrame) -> DataFrame:
            if p.date_column:
                df = dates.since(df, p.date_column, None)
                month = F.last_day(_day(df, p.date_column))
            else:
                month = F.lit(None).cast("date")
            return df.select(
                F.lit(p.table_name).alias("target_table_name"),
                F.lit(p.date_column).cast("string").alias("date_column_used"),
                month.alias("month"),
            )

        # two empty copies have no rows, but are equal all the same
        listed = _literal_rows(
            spark,
            [(p.table_name, p.date_column) for p in checked],
            T.StructType([DAY_RESULT[0], DAY_RESULT[7]]),
        )
        counts = side_counts(
            stack(side(p, p.source) for p in checked),
            stack(side(p, p.target) for p in checked),
            listed,
        )
        # the listed key without a month stays where it is the only one, or the table's total
        last_month = F.max("month").over(Window.partitionBy("target_table_name"))
        counts = counts.withColumn("last_month", last_month).filter(
            F.col("month").isNotNull() | F.col("last_month").isNull()
        )
        months = with_status(
            counts.withColumns({"dpYear": F.year("month"), "dpMonth": F.month("month")})
        )
        undated = F.col("month").isNull() & F.col("date_column_used").isNotNull()
        label = F.when(undated, "not_data_found").otherwise(F.col("validation_status"))
        parts.append(cast_to(months.withColumn("validation_status", label), MONTH_RESULT))
    if notes or not parts:
        parts.append(_literal_rows(spark, notes, MONTH_RESULT))
    return stack(parts)


def undated_rows(spark: SparkSession, pairs: Sequence[TablePair]) -> DataFrame:
    """One row per table: rows on either side whose date is NULL or cannot be read.

    Reports by period cannot show these rows. An unreadable side, or one without the column, is NULL.
    """
    pairs = [checked_columns(p) for p in pairs if p.date_column]
    listed = _literal_rows(
        spark,
        [(p.table_name, p.date_column, p.source is not None, p.target is not None) for p in pairs],
        "table_name string, date_column string, source_readable boolean, target_readable boolean",
    )

    def side(name: str) -> DataFrame:
        frames = [
            getattr(p, name).select(
                F.lit(p.table_name).alias("table_name"),
                dates.as_temporal(getattr(p, name), p.date_column).isNull().alias("undated"),
            )
            for p in pairs
            if getattr(p, name) is not None
        ]
        kept = stack(frames) if frames else spark.createDataFrame([], "table_name string, undated boolean")
        return kept.where("undated").select("table_name")

    counts = side_counts(side("source"), side("target"), listed.select("table_name"))
    known = listed.join(counts, "table_name").select(
        "table_name",
        "date_column",
        F.when(F.col("source_readable"), F.col("source_count")).alias("source_undated"),
        F.when(F.col("target_readable"), F.col("target_count")).alias("target_undated"),
    )
    same = F.coalesce(F.col("source_undated") == F.col("target_undated"), F.lit(False))
    return known.withColumn("is_matching", same)


def reconcile_totals(
    spark: SparkSession, pairs: Sequence[TablePair], source_catalog: str = "", catalog: str = ""
) -> DataFrame:
    """Total row counts over many tables in one plan, in ``TOTAL_RESULT`` form.

    Counting reads no column at all, and all scans feed one grouping. Empty tables count 0,
    unreadable sides NULL.
    """

    def named(prefix: str, name: str) -> str:
        return f"{prefix}.{name}" if prefix else name

    def names_of(side: list[tuple[str, DataFrame | None]]) -> DataFrame:
        frames = [df.select(F.lit(n).alias("name")) for n, df in side if df is not None]
        return stack(frames) if frames else spark.createDataFrame([], "name string")

    listed = _literal_rows(
        spark,
        [
            (
                p.table_name,
                p.table_name.split(".")[0] if "." in p.table_name else None,
                p.table_name.split(".")[-1],
                named(source_catalog, p.table_name),
                named(catalog, p.table_name),
                p.source_error or "",
                p.target_error or "",
                p.source is not None,
                p.target is not None,
            )
            for p in pairs
        ],
        "name string, source_schema string, table_name string, source_table string, "
        "catalog_table string, source_error string, catalog_error string, source_readable boolean, "
        "target_readable boolean",
    )
    counts = side_counts(
        names_of([(p.table_name, p.source) for p in pairs]),
        names_of([(p.table_name, p.target) for p in pairs]),
        listed.select("name"),
    ).withColumnRenamed("target_count", "catalog_count")
    known = listed.join(counts, "name").withColumns(
        {
            "source_count": F.when(F.col("source_readable"), F.col("source_count")),
            "catalog_count": F.when(F.col("target_readable"), F.col("catalog_count")),
        }
    )
    return cast_to(
        known.withColumn(
            "status", status.total_label(F.col("source_count"), F.col("catalog_count"))
        ),
        TOTAL_RESULT,
    )


def _column_bounds(p: TablePair, df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
    bounds = df.agg(
        *[
            F.struct(
                F.lit(c).alias("date_column"),
                F.min(dates.as_temporal(df, c)).cast("timestamp_ntz").alias("min_date"),
                F.max(dates.as_temporal(df, c)).cast("timestamp_ntz").alias("max_date"),
            ).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    )
    return bounds.select(
        F.lit(p.table_name).alias("table_name"),
        F.lit(side).alias("side"),
        F.inline(F.array(*[F.col(f"c{i}") for i in range(len(columns))])),
    )


RANGE_COLUMNS = "table_name string, date_column string, side string, min_date timestamp_ntz, max_date timestamp_ntz"


def date_ranges(pairs: Sequence[TablePair], columns: dict[str, Sequence[str]]) -> DataFrame:
    """First and last value of every date column on both sides.

    One pass per table side, whatever the number of its date columns. Every column asked for is a row;
    a side that cannot be read or lacks the column has NULLs there, and the two sides then match
    only if both were read and hold no date.
    """
    spark = SparkSession.active()
    asked = [(p.table_name, c) for p in pairs for c in columns.get(p.table_name, ())]
    listed = _literal_rows(spark, asked, "table_name string, date_column string")

    def held(df: DataFrame, names: Sequence[str]) -> list[str]:
        there = {c.lower() for c in df.columns}
        return [c for c in names if c.lower() in there]

    parts = [
        _column_bounds(p, df, held(df, columns[p.table_name]), side)
        for p in pairs
        for side, df in (("source", p.source), ("target", p.target))
        if df is not None and held(df, columns.get(p.table_name, ()))
    ]
    found = stack([*parts, spark.createDataFrame([], RANGE_COLUMNS)])
    side = F.col("side")

    def pick(name: str, which: str) -> Column:
        return F.max(F.when(side == which, F.col(name))).alias(f"{which}_{name}")

    ranges = found.unionByName(listed, allowMissingColumns=True).groupBy("table_name", "date_column").agg(
        pick("min_date", "source"),
        pick("max_date", "source"),
        pick("min_date", "target"),
        pick("max_date", "target"),
        F.count_distinct("side").alias("sides"),
    )
    same = F.col("source_min_date").eqNullSafe(F.col("target_min_date")) & F.col(
        "source_max_date"
    ).eqNullSafe(F.col("target_max_date"))
    return ranges.withColumn("is_matching", same & (F.col("sides") == 2)).drop("sides")


def estimate_vs_catalog(estimates: DataFrame, catalog_counts: DataFrame) -> DataFrame:
    """Estimated against real counts, for tables that both sides list."""
    left = estimates.select(
        "schema_name", "table_name", F.col("estimated_row_count").alias("source_count")
    )
    right = catalog_counts.select(
        "schema_name", "table_name", F.col("row_count").alias("catalog_count")
    )
    return left.join(right, ["schema_name", "table_name"]).withColumn(
        "is_matching", F.col("source_count") == F.col("catalog_count")
    )
