"""Script folder to gated run and target check, over two schemas that stand for catalogs."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest

from reconlake.operators import discovery as D
from reconlake.operators import lineage as L
from reconlake.operators import rollups
from reconlake.plans import gate
from reconlake.sources import catalog, files

DAYS = [(i, dt.date(2025, 1, 1 + i % 5)) for i in range(50)]


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    tag = uuid.uuid4().hex
    old, new = f"old_{tag}", f"new_{tag}"
    for s in (old, new):
        spark.sql(f"CREATE SCHEMA {s}")

    def put(schema, name, data, columns):
        spark.createDataFrame(data, columns).write.saveAsTable(f"{schema}.{name}")

    dated, plain = "k int, created date", "k int"
    put(old, "s__same", DAYS, dated), put(new, "s__same", DAYS, dated)
    put(old, "s__short", DAYS, dated), put(new, "s__short", DAYS[:-1], dated)
    put(old, "s__late", DAYS, dated), put(new, "s__late", [(1, dt.date(2020, 1, 1))], dated)
    put(old, "s__plain", [(1,)], plain), put(new, "s__plain", [(1,)], plain)
    put(old, "s__plain2", [(1,)], plain), put(new, "s__plain2", [(1,), (2,)], plain)
    put(old, "m__out", [(1,)], plain), put(new, "m__out", [(1,)], plain)

    def reader(schema):
        return lambda name: spark.table(f"{schema}.{name.replace('.', '__')}")

    names = ["s.same", "s.short", "s.late", "s.plain", "s.plain2", "m.out"]
    sheet = D.column_sheet(spark, {n: reader(old)(n) for n in names})
    folder = tmp_path_factory.mktemp("scripts")
    (folder / "sub").mkdir()
    scripts = {
        "good.sql": "SELECT 1; SELECT 2 -- FROM s.same JOIN s.plain",
        "sub/plain.sql": "SELECT 3; broken statement; -- INSERT INTO m.out SELECT * FROM s.plain",
        "short.sql": "SELECT 1 -- FROM s.short",
        "late.sql": "SELECT 1 -- FROM s.late",
        "mixed.sql": "SELECT 1 -- FROM s.same JOIN s.plain2",
        "none.sql": "SELECT 1 -- UPDATE m.out",
        "gone.sql": "SELECT 1 -- FROM s.gone",
    }
    for name, body in scripts.items():
        (folder / name).write_text(body)
    return files.sql_scripts(spark, str(folder)), sheet, reader(old), reader(new)


@pytest.fixture(scope="module")
def decisions(spark, world):
    scripts, sheet, old, new = world
    return gate.check_scripts(spark, scripts, sheet, old, new, "2025-01-01")


def short(df):
    return {r.file_path.rsplit("/", 1)[-1]: r for r in df.collect()}


def test_reasons(decisions):
    assert {n: r.reason for n, r in short(decisions).items()} == {
        "good.sql": "ready",
        "plain.sql": "ready",
        "short.sql": "counts differ",
        "late.sql": "no target data since 2025-01-01",
        "mixed.sql": "counts differ",
        "none.sql": "no source table in script",
        "gone.sql": "table not found",
    }


def test_run_and_target_check(spark, world, decisions):
    scripts, _, old, new = world
    results = gate.run_scripts(spark, scripts, decisions)
    assert results.select("file_path").distinct().count() == 2
    status = {n: r.execution_status for n, r in short(L.execution_status(results)).items()}
    assert status == {"good.sql": "Success", "plain.sql": "Failed"}
    failed = results.filter("status = 'Failed'").first()
    assert failed.query == "broken statement" and failed.error_message
    checked = gate.check_targets(spark, L.script_lineage(scripts), old, new)
    assert {r.execution_status for r in checked.collect()} == {"Passed"}
    totals = rollups.pass_fail_totals(rollups.target_summary(checked)).first()
    assert tuple(totals) == (2, 0)


def test_no_readable_table(spark, world):
    _, sheet, _, _ = world
    scripts = spark.createDataFrame([("a.sql", "FROM x.y")], "file_path string, text string")
    read = catalog.catalog_reader(spark, "nowhere")
    out = gate.check_scripts(spark, scripts, sheet, read, read, "2025-01-01")
    assert out.first().reason == "table not found"
