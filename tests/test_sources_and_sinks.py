"""Files, control sheets, script folders, tables."""

from __future__ import annotations

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from reconlake.operators import discovery as D
from reconlake.operators import schema_guard as G
from reconlake.plans import exports, loads
from reconlake.queries import fixtures as fx
from reconlake.session import scratch_path, scratch_root
from reconlake.sinks import tables as sink
from reconlake.sources import catalog, files


def test_parquet_folders(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    sink.write_parquet(spark.range(3), a)
    sink.write_fanned_out(spark.range(5), b, 4)
    assert files.parquet(spark, a, b).count() == 8
    assert len([f for f in os.listdir(b) if f.endswith(".snappy.parquet")]) == 4
    (tmp_path / "a" / "broken.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        files.parquet(spark, a, schema="id bigint").agg({"id": "sum"}).collect()
    kept = files.parquet(spark, a, tolerant=True, schema="id bigint")
    assert kept.agg({"id": "sum"}).first()[0] == 3


def test_empty_table_keeps_its_schema(spark, tmp_path):
    out = exports.export_by_offset(spark.range(0).withColumn("x", F.lit("a")), str(tmp_path / "e"))
    back = spark.read.parquet(str(tmp_path / "e"))
    assert {"id", "x"} <= set(back.columns) and back.isEmpty()
    assert out.check.first().status == "VALIDATION_SUCCESS"


def test_control_sheets(spark, tmp_path):
    (tmp_path / "copy.csv").write_text("table_name\ns.a\n\n\"\"\ns.b\n")
    assert rows(files.copy_list(spark, str(tmp_path / "copy.csv"))) == [("s.a",), ("s.b",)]
    (tmp_path / "dates.csv").write_text(
        'schema_name,table_name,date_columns\ns,a,"[""created"",""d""]"\ns,b,[]\ns,c,\n'
    )
    sheet = files.control_sheet(spark, str(tmp_path / "dates.csv"), files.DATE_COLUMN_LIST)
    found = D.listed_date_column(sheet).select("table_name", "date_column")
    assert rows(found) == [("a", "created"), ("b", None), ("c", None)]


def test_script_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.sql").write_text("SELECT 1;\nSELECT 2")
    (tmp_path / "sub" / "b.sql").write_text("SELECT 3")
    (tmp_path / "c.txt").write_text("SELECT 4")
    got = files.sql_scripts(spark, str(tmp_path))
    names = {os.path.basename(r.file_path): r.text for r in got.collect()}
    assert names == {"a.sql": "SELECT 1;\nSELECT 2", "b.sql": "SELECT 3"}


def test_table_lifecycle(spark, schema):
    t = f"{schema}.t"
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    sink.create_empty(df, t)
    assert spark.table(t).isEmpty() and catalog.exists(spark, t)
    assert sink.append_counted(df.select("v", "k"), t) == 1  # other column order
    sink.append(df, t)
    assert rows(spark.table(t)) == [(1, "a"), (1, "a")]
    assert sink.overwrite_counted(df, t) == 1
    with pytest.raises(ValueError):
        sink.append(df.drop("v"), t)
    with pytest.raises(Exception):
        sink.create_only(df, t)
    sink.append_results([df, df.select("v", "k")], f"{schema}.results")
    assert spark.table(f"{schema}.results").count() == 2
    with sink.temp_view(df, "named") as name:
        assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 1
    assert not spark.catalog.tableExists("named")


def test_schema_guard_blocks_a_load(spark, schema):
    t = f"{schema}.t"
    loads.guarded_load(spark.createDataFrame([(1, "a")], "k int, v string"), t)
    out = loads.guarded_load(spark.createDataFrame([(1, 2.0)], "K int, w double"), t)
    assert out.status == "COPY_FAILURE"
    assert out.error == "Column 2: source w (double), target v (string)"
    assert rows(spark.table(t)) == [(1, "a")]
    wider = spark.createDataFrame([(1, "a", 3)], "k int, v string, x int")
    assert "Column 3" in loads.guarded_load(wider, t).error


def test_live_schemas(spark, sf_dir):
    tables = {f"dwh.{n}": fx.table(spark, sf_dir, n) for n in fx.TABLES}
    sheet = D.column_sheet(spark, tables)
    dated = {r.table_name: r.date_columns for r in D.tables_with_dates(sheet).collect()}
    assert dated == {n: [c] for n, c in fx.DATE_COLUMNS.items()}
    assert {r.table_name for r in D.tables_without_dates(sheet).collect()} == set(fx.TABLES) - set(dated)
    without, log = D.inspection_log(spark, {**tables, "dwh.gone": "no such table"})
    assert {r.table_name for r in without.collect()} == set(fx.TABLES) - set(dated)
    assert log.filter("status = 'failed'").first().error == "no such table"
    assert G.frame_differences(spark, tables["dwh.orders"], tables["dwh.orders"]).isEmpty()


def test_nested_columns_in_the_guard(spark, sf_dir):
    df = fx.table(spark, sf_dir, "embeddings")
    other = df.withColumn("embedding", F.col("embedding").cast("array<double>"))
    r = G.frame_differences(spark, df, other).first()
    assert (r.source_type, r.target_type) == ("array<float>", "array<double>")


def test_open_pairs(spark, schema):
    spark.range(2).write.saveAsTable(f"{schema}.a")
    read = catalog.catalog_reader(spark, schema)
    a, gone = catalog.open_pairs(["a", "gone"], read, read, {"a": None})
    assert a.source is not None and a.source_error is None
    assert gone.source is None and "gone" in gone.source_error


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_root(spark).endswith("/scratch")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_pending_tables_without_a_log(spark, schema):
    tasks = spark.createDataFrame([("a",)], "table_name string")
    assert loads.pending_tables(spark, tasks, f"{schema}.none").count() == 1
