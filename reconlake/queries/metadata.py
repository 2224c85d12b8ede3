"""Catalog reports and row estimates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reconlake.operators import metadata as M
from reconlake.operators.counts import estimate_vs_catalog
from reconlake.queries import fixtures as fx
from reconlake.queries import query

_ESTIMATES = """est AS (SELECT schema_name, table_name, max(rows) AS estimated_row_count
FROM (SELECT schema_name, anchor_table_name AS table_name, projection_id,
             CAST(sum(total_row_count - deleted_row_count) AS bigint) AS rows
      FROM storage WHERE is_super_projection GROUP BY ALL) GROUP BY ALL)"""
_STORAGE = fx.ctes(storage=fx.STORAGE, info=fx.INFO_TABLES, listed=fx.LISTED)


@query("row_estimates", f"{_STORAGE}, {_ESTIMATES} SELECT * FROM est")
def row_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.row_estimates(fx.STORAGE.frame(spark, sf_dir))


@query(
    "work_list",
    f"""{_STORAGE}, {_ESTIMATES} SELECT schema_name, table_name,
coalesce(estimated_row_count, 0) AS estimated_row_count
FROM (SELECT DISTINCT * FROM listed) LEFT JOIN est USING (schema_name, table_name)""",
)
def work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = fx.LISTED.frame(spark, sf_dir).distinct()
    return M.largest_first(listed, M.row_estimates(fx.STORAGE.frame(spark, sf_dir)))


@query(
    "recon_estimate",
    f"""{_STORAGE}, {_ESTIMATES},
cat AS (SELECT schema_name, table_name, CAST(sum(row_count) AS bigint) AS n FROM info GROUP BY ALL)
SELECT schema_name, table_name, estimated_row_count AS source_count, n AS catalog_count,
       estimated_row_count = n AS is_matching
FROM est JOIN cat USING (schema_name, table_name)""",
)
def recon_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return estimate_vs_catalog(
        M.row_estimates(fx.STORAGE.frame(spark, sf_dir)),
        M.catalog_row_counts(fx.INFO_TABLES.frame(spark, sf_dir)),
    )


_CATALOG = fx.ctes(
    tables=fx.CAT_TABLES,
    views=fx.CAT_VIEWS,
    storage=fx.CAT_STORAGE,
    projections=fx.CAT_PROJECTIONS,
    constraints=fx.CAT_CONSTRAINTS,
    constraint_columns=fx.CAT_CONSTRAINT_COLUMNS,
    columns=fx.CAT_COLUMNS,
)


@query(
    "metadata_tables",
    f"""{_CATALOG},
ps AS (SELECT anchor_table_schema, anchor_table_name, sum(used_bytes) / (1024 * 1024) AS size_mb,
              sum(used_bytes) / (1024 * 1024 * 1024) AS size_gb,
              CAST(sum(row_count) AS bigint) AS row_count FROM storage GROUP BY ALL),
p AS (SELECT * FROM projections QUALIFY row_number() OVER (PARTITION BY anchor_table_id
      ORDER BY projection_id, is_segmented, segment_expression) = 1)
SELECT t.table_schema, t.table_name, is_temp_table, is_flextable,
       coalesce(view_definition, '') AS view_definition, coalesce(size_mb, 0) AS size_mb,
       coalesce(size_gb, 0) AS size_gb, coalesce(row_count, 0) AS row_count,
       coalesce(is_segmented, false) AS is_segmented,
       coalesce(segment_expression, '') AS segment_expression, owner_name,
       EXISTS (SELECT 1 FROM constraints c WHERE c.table_id = t.table_id
               AND c.constraint_type = 'p') AS has_primary_key,
       EXISTS (SELECT 1 FROM constraints c WHERE c.table_id = t.table_id
               AND c.constraint_type = 'f') AS has_foreign_keys
FROM tables t LEFT JOIN views v ON t.table_id = v.table_id
LEFT JOIN ps ON t.table_schema = ps.anchor_table_schema AND t.table_name = ps.anchor_table_name
LEFT JOIN p ON t.table_id = p.anchor_table_id WHERE NOT is_system_table""",
)
def metadata_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = M.table_report(
        fx.CAT_TABLES.frame(spark, sf_dir),
        fx.CAT_VIEWS.frame(spark, sf_dir),
        fx.CAT_STORAGE.frame(spark, sf_dir),
        fx.CAT_PROJECTIONS.frame(spark, sf_dir),
        fx.CAT_CONSTRAINTS.frame(spark, sf_dir),
    )
    return M.in_catalog_order(report)


@query(
    "metadata_columns",
    f"""{_CATALOG},
k AS (SELECT cc.table_id, cc.column_name, constraint_type, min(constraint_name) AS name
      FROM constraint_columns cc JOIN constraints c ON cc.constraint_id = c.constraint_id
      GROUP BY ALL)
SELECT c.table_schema, c.table_name, c.column_name, data_type, is_nullable, column_default,
       ordinal_position, character_maximum_length, numeric_precision, numeric_scale,
       pk.name IS NOT NULL AS is_primary_key, coalesce(pk.name, '') AS pk_constraint_name,
       fk.name IS NOT NULL AS is_foreign_key, coalesce(fk.name, '') AS fk_constraint_name
FROM columns c JOIN tables t ON c.table_id = t.table_id AND NOT t.is_system_table
LEFT JOIN k pk ON pk.table_id = c.table_id AND pk.column_name = c.column_name
          AND pk.constraint_type = 'p'
LEFT JOIN k fk ON fk.table_id = c.table_id AND fk.column_name = c.column_name
          AND fk.constraint_type = 'f'""",
)
def metadata_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = M.column_report(
        fx.CAT_COLUMNS.frame(spark, sf_dir),
        fx.CAT_TABLES.frame(spark, sf_dir),
        fx.CAT_CONSTRAINTS.frame(spark, sf_dir),
        fx.CAT_CONSTRAINT_COLUMNS.frame(spark, sf_dir),
    )
    return M.in_catalog_order(report)
