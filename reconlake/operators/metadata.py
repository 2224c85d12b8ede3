"""Table-level and column-level reports over catalog tables, and row estimates.

Every joined side is first reduced to one row per key, so no join can multiply rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE = ["schema_name", "table_name"]


def row_estimates(storage: DataFrame) -> DataFrame:
    """Estimated rows per table: live rows summed per super projection, largest projection wins.

    ``storage``: schema_name, anchor_table_name, projection_id, is_super_projection,
    total_row_count, deleted_row_count.
    """
    per_projection = (
        storage.filter("is_super_projection")
        .groupBy("schema_name", F.col("anchor_table_name").alias("table_name"), "projection_id")
        .agg(F.sum(F.col("total_row_count") - F.col("deleted_row_count")).alias("rows"))
    )
    return per_projection.groupBy(*TABLE).agg(F.max("rows").alias("estimated_row_count"))


def storage_of(containers: DataFrame, projections: DataFrame) -> DataFrame:
    """Storage rows of super projections, from the two remote catalog tables."""
    super_only = projections.filter("is_super_projection").select(
        "projection_id", "anchor_table_name", "is_super_projection"
    )
    return containers.join(super_only, "projection_id")


def largest_first(tables: DataFrame, estimates: DataFrame) -> DataFrame:
    """Work list with its estimates, 0 when unknown, largest table first."""
    joined = tables.join(estimates, TABLE, "left").fillna(0, subset=["estimated_row_count"])
    return joined.orderBy(F.col("estimated_row_count").desc(), *TABLE)


def only_listed(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows whose (schema, table) is in the list."""
    return df.join(pairs.select(*TABLE), TABLE, "left_semi")


def storage_sizes(projection_storage: DataFrame) -> DataFrame:
    """Megabytes, gigabytes and rows per table."""
    used = F.sum("used_bytes")
    return projection_storage.groupBy(
        F.col("anchor_table_schema").alias("table_schema"),
        F.col("anchor_table_name").alias("table_name"),
    ).agg(
        (used / (1024 * 1024)).alias("size_mb"),
        (used / (1024 * 1024 * 1024)).alias("size_gb"),
        F.sum("row_count").alias("row_count"),
    )


def _key_flags(constraints: DataFrame) -> DataFrame:
    kind = F.col("constraint_type")
    return constraints.groupBy("table_id").agg(
        F.bool_or(kind == "p").alias("has_primary_key"),
        F.bool_or(kind == "f").alias("has_foreign_keys"),
    )


def table_report(
    tables: DataFrame,
    views: DataFrame,
    projection_storage: DataFrame,
    projections: DataFrame,
    constraints: DataFrame,
) -> DataFrame:
    """One row per user table: sizes, segmentation, owner, view text and key flags."""
    segmentation = projections.groupBy(F.col("anchor_table_id").alias("table_id")).agg(
        F.min(F.struct("projection_id", "is_segmented", "segment_expression")).alias("p")
    )
    view_text = views.groupBy("table_id").agg(F.max("view_definition").alias("view_definition"))
    joined = (
        tables.filter(~F.col("is_system_table"))
        .join(view_text, "table_id", "left")
        .join(_key_flags(constraints), "table_id", "left")
        .join(segmentation, "table_id", "left")
        .join(storage_sizes(projection_storage), ["table_schema", "table_name"], "left")
    )
    return joined.select(
        "table_schema",
        "table_name",
        "is_temp_table",
        "is_flextable",
        F.coalesce("view_definition", F.lit("")).alias("view_definition"),
        F.coalesce("size_mb", F.lit(0.0)).alias("size_mb"),
        F.coalesce("size_gb", F.lit(0.0)).alias("size_gb"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce(F.col("p.is_segmented"), F.lit(False)).alias("is_segmented"),
        F.coalesce(F.col("p.segment_expression"), F.lit("")).alias("segment_expression"),
        "owner_name",
        F.coalesce("has_primary_key", F.lit(False)).alias("has_primary_key"),
        F.coalesce("has_foreign_keys", F.lit(False)).alias("has_foreign_keys"),
    )


def column_report(
    columns: DataFrame, tables: DataFrame, constraints: DataFrame, constraint_columns: DataFrame
) -> DataFrame:
    """One row per column of a user table with its primary-key and foreign-key membership.

    A column that is in several constraints of a kind shows the first by name.
    """
    kind, name = F.col("constraint_type"), F.col("constraint_name")
    keys = (
        constraint_columns.join(
            constraints.select("constraint_id", "constraint_type", "constraint_name"),
            "constraint_id",
        )
        .groupBy("table_id", "column_name")
        .agg(
            F.min(F.when(kind == "p", name)).alias("pk"),
            F.min(F.when(kind == "f", name)).alias("fk"),
        )
    )
    user_tables = tables.filter(~F.col("is_system_table")).select("table_id")
    joined = columns.join(user_tables, "table_id", "left_semi").join(
        keys, ["table_id", "column_name"], "left"
    )
    return joined.select(
        "table_schema",
        "table_name",
        "column_name",
        "data_type",
        "is_nullable",
        "column_default",
        "ordinal_position",
        "character_maximum_length",
        "numeric_precision",
        "numeric_scale",
        F.col("pk").isNotNull().alias("is_primary_key"),
        F.coalesce("pk", F.lit("")).alias("pk_constraint_name"),
        F.col("fk").isNotNull().alias("is_foreign_key"),
        F.coalesce("fk", F.lit("")).alias("fk_constraint_name"),
    )


def in_catalog_order(report: DataFrame) -> DataFrame:
    """Sorted by schema, table and, where present, column position."""
    keys = [c for c in ("table_schema", "table_name", "ordinal_position") if c in report.columns]
    return report.orderBy(*keys)


def catalog_row_counts(info_tables: DataFrame) -> DataFrame:
    """Rows per table, summed over the entries of an information schema."""
    return info_tables.groupBy(*TABLE).agg(F.sum("row_count").alias("row_count"))
