"""Positional comparison of two schemas before a load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.operators.discovery import TABLE, column_sheet


def schema_differences(source_sheet: DataFrame, target_sheet: DataFrame) -> DataFrame:
    """Positions at which two column sheets differ in lower-case name or in type.

    One row per (schema, table, position); a position that one side lacks has NULLs there.
    Both sides are stacked and grouped, so any number of tables is compared in one shuffle.
    """

    def side(sheet: DataFrame, is_source: bool) -> DataFrame:
        return sheet.select(
            *TABLE,
            "ordinal_position",
            F.lit(is_source).alias("is_source"),
            F.lower("column_name").alias("name"),
            F.lower("data_type").alias("type"),
        )

    s = F.col("is_source")
    both = (
        side(source_sheet, True)
        .unionByName(side(target_sheet, False))
        .groupBy(*TABLE, "ordinal_position")
        .agg(
            F.max(F.when(s, F.col("name"))).alias("source_column"),
            F.max(F.when(s, F.col("type"))).alias("source_type"),
            F.max(F.when(~s, F.col("name"))).alias("target_column"),
            F.max(F.when(~s, F.col("type"))).alias("target_type"),
        )
    )
    equal = F.col("source_column").eqNullSafe(F.col("target_column")) & F.col(
        "source_type"
    ).eqNullSafe(F.col("target_type"))
    return both.filter(~equal)


def schema_verdicts(source_sheet: DataFrame, target_sheet: DataFrame) -> DataFrame:
    """Per table of either sheet: column counts, number of mismatches, and a verdict."""

    def side(sheet: DataFrame, is_source: bool) -> DataFrame:
        return sheet.select(*TABLE, F.lit(is_source).alias("is_source"))

    s = F.col("is_source")
    sizes = (
        side(source_sheet, True)
        .unionByName(side(target_sheet, False))
        .groupBy(*TABLE)
        .agg(
            F.count_if(s).alias("source_columns"),
            F.count_if(~s).alias("target_columns"),
        )
    )
    wrong = (
        schema_differences(source_sheet, target_sheet)
        .groupBy(*TABLE)
        .agg(F.count(F.lit(1)).alias("mismatches"))
    )
    joined = sizes.join(wrong, TABLE, "left").fillna(0, subset=["mismatches"])
    verdict = (
        F.when(F.col("source_columns") != F.col("target_columns"), "Column count mismatch")
        .when(F.col("mismatches") > 0, "Schema mismatch")
        .otherwise("Match")
    )
    return joined.withColumn("verdict", verdict)


def frame_differences(spark: SparkSession, source: DataFrame, target: DataFrame) -> DataFrame:
    """The same for two frames."""
    name = "source.target"
    return schema_differences(
        column_sheet(spark, {name: source}), column_sheet(spark, {name: target})
    ).drop(*TABLE)
