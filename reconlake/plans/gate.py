"""Decide which SQL scripts may run on the target, run them, and check what they wrote."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from reconlake.errors import ENGINE_ERRORS
from reconlake.functions import status
from reconlake.operators import counts as C
from reconlake.operators import levels
from reconlake.operators import lineage as L
from reconlake.operators.discovery import date_profile
from reconlake.operators.own_dates import reconcile_own_days, table_days
from reconlake.operators.rollups import count_check
from reconlake.operators.row_hashes import reconcile_hashes
from reconlake.plans.reports import in_batches
from reconlake.session import scratch_path
from reconlake.sources.catalog import Reader, open_pairs

#: Results of statements that the driver holds before they are written.
RESULTS_TOGETHER = 200
_RESULT = (
    "file_path string, file_name string, position int, query string, status string, error_message string"
)
_OUTCOME = "file_path string, outcome string"
READY = "ready"
ROWS_DIFFER = "rows differ"


def day_verdicts(days: DataFrame) -> DataFrame:
    """Per table of a day-count frame (table_name, source_count, target_count): what its days say."""
    s, t = F.col("source_count"), F.col("target_count")
    return days.groupBy("table_name").agg(
        F.lit(True).alias("has_date"),
        F.count_if(s > 0).alias("source_days"),
        F.count_if(t > 0).alias("target_days"),
        F.count_if((s > 0) & (t > 0)).alias("common_days"),
        F.count_if(~s.eqNullSafe(t)).alias("bad_days"),
        F.lit(0).cast("bigint").alias("bad_totals"),
    )


def total_verdicts(totals: DataFrame) -> DataFrame:
    """The same columns for tables without a date column, from their total counts."""
    same = F.coalesce(F.col("source_count") == F.col("target_count"), F.lit(False))
    zero = F.lit(0).cast("bigint")
    return totals.select(
        "table_name",
        F.lit(False).alias("has_date"),
        zero.alias("source_days"),
        zero.alias("target_days"),
        zero.alias("common_days"),
        zero.alias("bad_days"),
        (~same).cast("bigint").alias("bad_totals"),
    )


_VERDICT = (
    "table_name string, has_date boolean, source_days bigint, target_days bigint, common_days bigint, "
    "bad_days bigint, bad_totals bigint, note string"
)


def hash_verdicts(hashes: DataFrame) -> DataFrame:
    """The same columns from a row-hash report: a note if the rows differ or were not compared.

    Distinct rows stand in for days, so that a date table without any since the start says so.
    """
    equal = (F.col("validation_status") == status.MATCH) & (F.col("multiset_status") == status.MATCH)
    rows = {"source_days": "source_hash_count", "target_days": "target_hash_count", "common_days": "source_hash_count"}
    note = F.when(F.col("error_message").isNotNull(), F.concat(F.lit("ERROR: "), "error_message"))
    return hashes.select(
        "table_name",
        F.lit(False).alias("has_date"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in rows.items()],
        *[F.lit(0).cast("bigint").alias(c) for c in ("bad_days", "bad_totals")],
        note.when(~equal, ROWS_DIFFER).alias("note"),
    )


def _with_note(verdicts: DataFrame) -> DataFrame:
    if "note" in verdicts.columns:
        return verdicts
    return verdicts.withColumn("note", F.lit(None).cast("string"))


def table_reasons(verdicts: DataFrame, start_date: str) -> DataFrame:
    """table_name, has_date, reason: whether each table was compared and agrees.

    A table that could not be compared says so; only one that was compared and is equal is ready.
    """
    none_since = F.col("note").startswith("not_data_found")
    differ = F.coalesce(F.col("note") == ROWS_DIFFER, F.lit(False))
    dated = F.col("has_date")
    reason = (
        F.when(F.col("note").isNotNull() & ~none_since & ~differ, "table not compared")
        .when(none_since | (dated & (F.col("source_days") == 0)), f"no source data since {start_date}")
        .when(dated & (F.col("target_days") == 0), f"no target data since {start_date}")
        .when(dated & (F.col("common_days") == 0), "no common day in source and target")
        .when((F.col("bad_days") > 0) | (F.col("bad_totals") > 0), "counts differ")
        .when(differ, ROWS_DIFFER)
        .otherwise(READY)
    )
    return _with_note(verdicts).select("table_name", "has_date", reason.alias("reason"))


def _in_order(start_date: str) -> list[str]:
    """The reasons of a table, from the one that a script reports first to the last."""
    return [
        "table not found",
        "table not compared",
        f"no source data since {start_date}",
        f"no target data since {start_date}",
        "no common day in source and target",
        "counts differ",
        ROWS_DIFFER,
        READY,
    ]


def decide(
    lineage: DataFrame, verdicts: DataFrame, start_date: str, require_date_column: bool = False
) -> DataFrame:
    """One row per script: file_path, total_tables, dated_tables, ready, reason.

    A script is ready when every table it reads was compared and is equal by itself: each day of a
    date table, the total of another. Otherwise it gives the first reason among its tables.
    ``require_date_column`` rejects scripts that use dateless tables only. The verdicts have one
    row per table, so the join cannot multiply anything.
    """
    used = lineage.select("file_path", F.explode_outer("source_table_names").alias("table_name"))
    order = _in_order(start_date)
    reason = F.coalesce("reason", F.lit("table not found"))
    rank: Column = F.array_position(F.array(*map(F.lit, order)), reason)
    named = F.col("table_name").isNotNull()
    per_script = (
        used.join(table_reasons(verdicts, start_date), "table_name", "left")
        .groupBy("file_path")
        .agg(
            F.count("table_name").alias("total_tables"),
            F.count_if(F.col("has_date")).alias("dated_tables"),
            F.min(F.when(named, rank)).cast("int").alias("first_reason"),
        )
    )
    result = (
        F.when(F.col("total_tables") == 0, "no source table in script")
        .when(F.col("first_reason") == 1, order[0])
        .when(F.lit(require_date_column) & (F.col("dated_tables") == 0), "no date column")
        .otherwise(F.get(F.array(*map(F.lit, order)), F.col("first_reason") - 1))
    )
    return per_script.select(
        "file_path",
        "total_tables",
        "dated_tables",
        (result == READY).alias("ready"),
        result.alias("reason"),
    )


def _compared(
    spark: SparkSession, pairs: Sequence[C.TablePair], start_date: str, how: str = "counts"
) -> DataFrame:
    """One verdict per table, each with a note if it could not be compared."""
    if how == "hash":
        dated = {p.table_name for p in pairs if p.date_column}
        verdicts = hash_verdicts(reconcile_hashes(pairs, start_date))
        return verdicts.withColumn("has_date", F.col("table_name").isin(*dated)) if dated else verdicts
    pairs = [C.checked_columns(p) for p in pairs]
    readable = [p for p in pairs if C.readable_pair(p)]
    dated = [p for p in readable if p.date_column]
    parts = [spark.createDataFrame([], _VERDICT)]
    if dated:
        days = C.reconcile_days(spark, dated, start_date).select(
            F.col("target_table_name").alias("table_name"),
            F.coalesce("source_count", F.lit(0)).alias("source_count"),
            F.coalesce("target_count", F.lit(0)).alias("target_count"),
            F.when(F.col("dpDay").isNull(), F.col("validation_status")).alias("note"),
        )
        notes = days.groupBy("table_name").agg(F.max("note").alias("note"))
        undated = C.undated_rows(spark, dated).select(
            "table_name", (~F.col("is_matching")).cast("bigint").alias("bad_undated")
        )
        verdicts = day_verdicts(days.drop("note")).join(notes, "table_name").join(undated, "table_name")
        parts.append(
            verdicts.withColumn("bad_totals", F.col("bad_totals") + F.col("bad_undated")).drop(
                "bad_undated"
            )
        )
    dateless = [p for p in readable if not p.date_column]
    if dateless:
        totals = C.reconcile_totals(spark, dateless).select(
            F.col("source_table").alias("table_name"),
            "source_count",
            F.col("catalog_count").alias("target_count"),
        )
        parts.append(_with_note(total_verdicts(totals)))
    missing = [
        (p.table_name, bool(p.date_column), 0, 0, 0, 0, 0, f"ERROR: {p.source_error or p.target_error}")
        for p in pairs
        if not C.readable_pair(p)
    ]
    parts.append(spark.createDataFrame(missing, _VERDICT))
    return C.stack(parts)


def corpus_verdicts(
    spark: SparkSession,
    lineage: DataFrame,
    sheet: DataFrame,
    read_source: Reader,
    read_target: Reader,
    start_date: str,
    tables_per_plan: int = 100,
    how: str = "counts",
) -> DataFrame:
    """Verdicts of all tables that the scripts read, staged in plans of bounded size.

    Names that the sheet does not list are not opened: a pattern may take them from a comment. The
    others are brought to the driver, because each one has to be opened there; their number is
    that of the catalog's tables, not of rows or scripts. A table whose comparison fails
    while running is a verdict with a note, and the others go on.
    """
    listed = date_profile(sheet).select(
        F.concat_ws(".", "schema_name", "table_name").alias("table_name"),
        F.try_element_at("date_columns", F.lit(1)).alias("date_column"),
    )
    names = (
        L.corpus_tables(lineage)
        .filter("role = 'source'")
        .join(listed, "table_name")
        .select("table_name", "date_column")
        .collect()
    )
    pairs = open_pairs(
        [r.table_name for r in names],
        read_source,
        read_target,
        {r.table_name: r.date_column for r in names},
    )
    staged = scratch_path(spark, "verdicts")
    spark.createDataFrame([], _VERDICT).write.parquet(staged)
    in_batches(
        pairs,
        lambda part: _compared(spark, part, start_date, how),
        lambda df: df.write.mode("append").parquet(staged),
        tables_per_plan,
    )
    return spark.read.schema(_VERDICT).parquet(staged)


def check_scripts(
    spark: SparkSession,
    scripts: DataFrame,
    sheet: DataFrame,
    read_source: Reader,
    read_target: Reader,
    start_date: str,
    require_date_column: bool = False,
    how: str = "counts",
) -> DataFrame:
    """Decisions for a script corpus against two catalogs; see :func:`corpus_verdicts`.

    ``how`` compares by ``counts`` (days, or totals without a date column) or by row ``hash``
    (of the rows since the start, or of all without a date column).
    """
    lineage = L.script_lineage(scripts)
    verdicts = corpus_verdicts(
        spark, lineage, sheet, read_source, read_target, start_date, how=how
    )
    return decide(lineage, verdicts, start_date, require_date_column)


class _Results:
    """Results of statements, appended to a folder whenever so many are together; the driver keeps no more."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.rows = spark, path, []
        spark.createDataFrame([], _RESULT).write.parquet(path)

    def add(self, s: Row, outcome: str, error: str | None = None) -> None:
        self.rows.append((s.file_path, s.file_name, s.position, s.query, outcome, error))
        if len(self.rows) >= RESULTS_TOGETHER:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            self.spark.createDataFrame(self.rows, _RESULT).coalesce(1).write.mode("append").parquet(self.path)
        self.rows = []

    def frame(self) -> DataFrame:
        return self.spark.read.schema(_RESULT).parquet(self.path)


def _run(spark: SparkSession, scripts: DataFrame, results: _Results) -> None:
    todo = L.statements(scripts).orderBy("file_path", "position")
    try:
        for s in todo.toLocalIterator():
            try:
                result = spark.sql(s.query)
                if result.columns:
                    result.write.format("noop").mode("overwrite").save()
                results.add(s, "Success")
            except ENGINE_ERRORS as e:
                results.add(s, "Failed", str(e))
    finally:
        results.flush()


def run_scripts(spark: SparkSession, scripts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Run the statements of ready scripts in order; one result row per statement.

    The statements are streamed to the driver one by one, which is where SQL is submitted.
    A statement that fails is a row with its error, and the next one runs. A query is run to its
    end, without keeping its result. Results go to the scratch folder as they come.
    """
    ready = decisions.filter("ready").select("file_path")
    results = _Results(spark, scratch_path(spark, "results"))
    _run(spark, scripts.join(ready, "file_path", "left_semi"), results)
    return results.frame()


def run_by_level(
    spark: SparkSession, scripts: DataFrame, decisions: DataFrame, lineage: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Run ready scripts level by level; returns the results per statement, and per script what became of it.

    A script does not run when a table it reads is written by a script that was not ready, did not run, failed,
    or is in a cycle: its outcome is then ``Blocked``. Other outcomes are ``Success``, ``Failed``, ``Not ready``,
    and the states of :func:`reconlake.operators.levels.run_levels` for scripts without a level.
    """
    lineage = L.script_lineage(scripts) if lineage is None else lineage
    at = scratch_path(spark, "order")
    ready = decisions.filter("ready").select("file_path", F.lit(True).alias("ready"))
    levels.run_levels(lineage).join(ready, "file_path", "left").write.parquet(at)
    order = spark.read.parquet(at)
    uses = levels.uses(lineage)
    results = _Results(spark, scratch_path(spark, "results"))
    outcomes = scratch_path(spark, "outcomes")
    stuck = order.filter("level IS NULL").select("file_path", F.col("state").alias("outcome"))
    stuck.write.parquet(outcomes)
    last = order.agg(F.max("level")).first()[0]
    for level in range(-1 if last is None else last + 1):
        so_far = spark.read.schema(_OUTCOME).parquet(outcomes)
        bad = so_far.filter("outcome <> 'Success'").join(uses.filter("writes"), "file_path").select("table_name")
        blocked = uses.filter("reads").join(bad, "table_name", "left_semi").select("file_path").distinct()
        here = scratch_path(spark, "level")
        order.filter(F.col("level") == level).join(
            blocked.withColumn("blocked", F.lit(True)), "file_path", "left"
        ).select(
            "file_path",
            F.when(F.col("blocked"), "Blocked").when(F.col("ready"), "Success").otherwise("Not ready").alias("outcome"),
        ).write.parquet(here)
        planned = spark.read.schema(_OUTCOME).parquet(here)
        _run(spark, scripts.join(planned.filter("outcome = 'Success'"), "file_path", "left_semi"), results)
        failed = results.frame().filter("status = 'Failed'").select("file_path").distinct()
        ended = planned.join(failed.withColumn("failed", F.lit(True)), "file_path", "left").select(
            "file_path", F.when(F.col("failed"), "Failed").otherwise(F.col("outcome")).alias("outcome")
        )
        ended.write.mode("append").parquet(outcomes)
    return results.frame(), spark.read.schema(_OUTCOME).parquet(outcomes)


def check_targets(
    spark: SparkSession,
    lineage: DataFrame,
    read_intermediate: Reader,
    read_final: Reader,
    names: Sequence[str] | None = None,
    how: str = "totals",
) -> DataFrame:
    """The tables the scripts write, in both catalogs, per script and table.

    ``how``: by ``totals``, or by row ``hash``, which also finds changed rows of the same number; the
    counts are then those of distinct rows.
    """
    if names is None:
        targets = L.corpus_tables(lineage).filter("role = 'target'").select("table_name")
        names = [r.table_name for r in targets.collect()]
    used = L.script_tables(lineage, "target").withColumnRenamed("file_path", "sql_file")
    pairs = open_pairs(names, read_intermediate, read_final)
    key = ["schema_name", "table_name"]
    if how == "hash":
        hashes = reconcile_hashes(pairs)
        part = F.split("table_name", r"\.")
        equal = (F.col("validation_status") == status.MATCH) & (F.col("multiset_status") == status.MATCH)
        found = hashes.select(
            F.get(part, F.lit(0)).alias("schema_name"),
            F.get(part, F.lit(1)).alias("table_name"),
            F.col("source_hash_count").alias("source_count"),
            F.col("target_hash_count").alias("target_count"),
            equal.alias("equal"),
        )
        same = F.coalesce("equal", F.lit(False))
        return used.join(found, key, "left").select(
            "sql_file", *key, "source_count", "target_count",
            F.when(same, "Target rows match").otherwise("Not Validated").alias("validation_status"),
            F.when(same, status.PASSED).otherwise(status.FAILED).alias("execution_status"),
        )
    totals = C.reconcile_totals(spark, pairs).select(
        F.col("source_schema").alias("schema_name"),
        "table_name",
        "source_count",
        F.col("catalog_count").alias("target_count"),
    )
    return count_check(used.join(totals, key, "left"), "Target")


def check_target_days(
    spark: SparkSession,
    lineage: DataFrame,
    read_intermediate: Reader,
    read_final: Reader,
    start_date: str,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """The tables the scripts write, in both catalogs, day by day since the start, per script and table.

    Finds rows that moved between days, which totals miss. A table without a date column, or that a side lacks,
    is not validated; :func:`check_targets` compares such tables by totals or hashes.
    """
    if names is None:
        targets = L.corpus_tables(lineage).filter("role = 'target'").select("table_name")
        names = [r.table_name for r in targets.collect()]
    used = L.script_tables(lineage, "target").withColumnRenamed("file_path", "sql_file")
    days = reconcile_own_days(spark, open_pairs(names, read_intermediate, read_final), start_date)
    part = F.split("table_name", r"\.")
    found = table_days(days).select(
        F.get(part, F.lit(0)).alias("schema_name"),
        F.get(part, F.lit(1)).alias("table_name"),
        "source_count", "target_count", "days", "differing_days", "equal",
    )
    key, same = ["schema_name", "table_name"], F.coalesce("equal", F.lit(False))
    return used.join(found, key, "left").select(
        "sql_file", *key, "source_count", "target_count", "days", "differing_days",
        F.when(same, "Target days match").otherwise("Not Validated").alias("validation_status"),
        F.when(same, status.PASSED).otherwise(status.FAILED).alias("execution_status"),
    )
