"""Status labels. The values are fixed: reports of earlier runs use the same words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUCCESS, FAILURE, FAIL = "SUCCESS", "FAILURE", "FAIL"
SOURCE_QUERY_FAIL, CATALOG_QUERY_FAIL = "SOURCE_QUERY_FAIL", "CATALOG_QUERY_FAIL"
MATCH, NOT_MATCH = "Match", "Not Match"
PASSED, FAILED = "Passed", "Failed"
SKIPPED_NO_DATE = "SKIPPED: No Date Column"
VALIDATION_SUCCESS, VALIDATION_FAILED = "VALIDATION_SUCCESS", "VALIDATION_FAILED"


def equal_label(a: Column, b: Column, yes: str = SUCCESS, no: str = FAILURE) -> Column:
    return F.when(a == b, yes).otherwise(no)


def three_way_label(a: Column, b: Column) -> Column:
    """Not Applicable when a side is unknown, else Success or Failure."""
    return (
        F.when(a.isNull() | b.isNull(), "Not Applicable")
        .when(a == b, "Success")
        .otherwise("Failure")
    )


def same_column_label(a: Column, b: Column) -> Column:
    """Success when both names agree; two unknown names agree."""
    return F.when(a.eqNullSafe(b), "Success").otherwise("Failure")


def total_label(source_count: Column, target_count: Column) -> Column:
    """Total-count status; NULL stands for a side that could not be read."""
    return (
        F.when(source_count.isNull(), SOURCE_QUERY_FAIL)
        .when(target_count.isNull(), CATALOG_QUERY_FAIL)
        .when(source_count == target_count, SUCCESS)
        .otherwise(FAIL)
    )


def from_failures(failures: Column, yes: str = "Pass", no: str = "Fail") -> Column:
    return F.when(failures == 0, yes).otherwise(no)
