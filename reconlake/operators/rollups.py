"""Per-script roll-ups of table results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reconlake.functions import status


def script_summary(results: DataFrame, passed: Column, script: str = "sql_file") -> DataFrame:
    """Tables that pass and fail per script and whether all pass."""
    ok = F.coalesce(passed, F.lit(False))
    return results.groupBy(script).agg(
        F.bool_and(ok).alias("all_passed"),
        F.count_if(ok).alias("pass_count"),
        F.count_if(~ok).alias("fail_count"),
        F.count(F.lit(1)).alias("total_tables"),
    )


def script_verdict(results: DataFrame, script: str = "sql_file") -> DataFrame:
    """Pass or Fail per script, from the number of tables that do not match."""
    bad = F.coalesce(F.col("validation_status") != status.MATCH, F.lit(True))
    return (
        results.groupBy(script)
        .agg(F.count(F.lit(1)).alias("total_count"), F.count_if(bad).alias("not_match_count"))
        .withColumn("file_status", status.from_failures(F.col("not_match_count")))
    )


def count_check(counts: DataFrame, what: str = "Source") -> DataFrame:
    """Adds the two status columns of a total-count check; an unknown count never passes."""
    same = F.coalesce(F.col("source_count") == F.col("target_count"), F.lit(False))
    return counts.withColumns(
        {
            "validation_status": F.when(same, f"{what} count match").otherwise("Not Validated"),
            "execution_status": F.when(same, status.PASSED).otherwise(status.FAILED),
        }
    )


def target_summary(results: DataFrame, script: str = "sql_file") -> DataFrame:
    """Passed when every target table of the script passed, else Failed."""
    every = F.bool_and(F.coalesce(F.col("execution_status") == status.PASSED, F.lit(False)))
    return results.groupBy(script).agg(
        F.when(every, status.PASSED).otherwise(status.FAILED).alias("status")
    )


def pass_fail_totals(summary: DataFrame) -> DataFrame:
    """Number of passed and failed scripts, one row."""
    return summary.agg(
        F.count_if(F.col("status") == status.PASSED).alias("passed_files"),
        F.count_if(F.col("status") == status.FAILED).alias("failed_files"),
    )


def failed_tables(
    totals: DataFrame, statuses: tuple[str, ...] = (status.FAIL, status.CATALOG_QUERY_FAIL)
) -> DataFrame:
    """Tables to load again."""
    return totals.filter(F.col("status").isin(*statuses))
