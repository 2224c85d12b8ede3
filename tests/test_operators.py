"""Small operators that no registered query shows on its own."""

from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from reconlake.functions.columns import non_empty, select_all, zero_if_null
from reconlake.operators import metadata as M


def test_work_list_is_largest_first(spark):
    tables = spark.createDataFrame(
        [("s", "a"), ("s", "b"), ("s", "c")], "schema_name string, table_name string"
    )
    estimates = spark.createDataFrame(
        [("s", "b", 7), ("s", "c", 9)],
        "schema_name string, table_name string, estimated_row_count long",
    )
    listed = M.largest_first(tables, estimates).collect()
    assert [(r.table_name, r.estimated_row_count) for r in listed] == [("c", 9), ("b", 7), ("a", 0)]
    assert rows(M.only_listed(tables, estimates).select("table_name")) == [("b",), ("c",)]


def test_storage_takes_super_projections_only(spark):
    containers = spark.createDataFrame(
        [("s", 1, 10, 1), ("s", 1, 5, 0), ("s", 2, 20, 0), ("s", 3, 99, 0)],
        "schema_name string, projection_id int, total_row_count long, deleted_row_count long",
    )
    projections = spark.createDataFrame(
        [(1, "t", True), (2, "t", True), (3, "t", False)],
        "projection_id int, anchor_table_name string, is_super_projection boolean",
    )
    storage = M.storage_of(containers, projections)
    assert rows(M.row_estimates(storage)) == [("s", "t", 20)]


def test_several_constraints_do_not_multiply_rows(spark):
    tables = spark.createDataFrame(
        [(1, "s", "t", False, False, "me", False)],
        "table_id int, table_schema string, table_name string, is_temp_table boolean, "
        "is_flextable boolean, owner_name string, is_system_table boolean",
    )
    constraints = spark.createDataFrame(
        [(1, 1, "p", "pk"), (2, 1, "f", "fk1"), (3, 1, "f", "fk2")],
        "constraint_id int, table_id int, constraint_type string, constraint_name string",
    )
    storage = spark.createDataFrame(
        [("s", "t", 1048576, 5), ("s", "t", 1048576, 6)],
        "anchor_table_schema string, anchor_table_name string, used_bytes long, row_count long",
    )
    projections = spark.createDataFrame(
        [(1, 2, False, "b"), (1, 1, True, "a")],
        "anchor_table_id int, projection_id int, is_segmented boolean, segment_expression string",
    )
    views = spark.createDataFrame([], "table_id int, view_definition string")
    report = M.table_report(tables, views, storage, projections, constraints)
    (r,) = M.in_catalog_order(report).collect()
    assert (r.size_mb, r.row_count, r.segment_expression) == (2.0, 11, "a")
    assert r.has_primary_key and r.has_foreign_keys and r.view_definition == ""


def test_column_helpers(spark):
    df = spark.createDataFrame(
        [(1, [1], None), (2, [], 5), (3, None, None)], "`a.b` int, x array<int>, n long"
    )
    assert select_all(df).columns == ["a.b", "x", "n"]
    assert [r[0] for r in df.select(non_empty(F.col("x"))).collect()] == [True, False, False]
    assert [r.n for r in zero_if_null(df, "n").collect()] == [0, 5, 0]
