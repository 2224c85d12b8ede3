"""Real failures: corrupt files, connections that cannot be made, values that do not fit."""

from __future__ import annotations

import glob
import os

import pytest
from conftest import plan_of

from reconlake.operators import audit
from reconlake.operators import counts as C
from reconlake.operators import repair as R
from reconlake.operators import row_hashes as H
from reconlake.operators.incremental import incremental_rows
from reconlake.plans import gate, loads, reports
from reconlake.queries import fixtures as fx
from reconlake.queries import soundness
from reconlake.session import discard, scratch_path
from reconlake.sources import catalog, files


@pytest.fixture
def half_corrupt(spark, tmp_path):
    """A folder of four Parquet files with 1,000 rows, one of them garbage."""
    path = str(tmp_path / "t")
    spark.range(1000).repartition(4).write.parquet(path)
    broken = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))[0]
    with open(f"{path}/{broken}", "wb") as f:
        f.write(b"not a parquet file at all")
    # a leftover checksum would be noticed before the file is read
    check = f"{path}/.{broken}.crc"
    if os.path.exists(check):
        os.truncate(check, 0)
    return path, broken


def broken_frame(spark, path):
    return spark.read.schema("id bigint").parquet(path)


def test_a_report_goes_on_after_a_corrupt_file(spark, schema, half_corrupt):
    good = spark.range(5)
    pairs = [C.TablePair("a", good, good), C.TablePair("bad", broken_frame(spark, half_corrupt[0]), good), C.TablePair("z", good, good)]

    def report(part):
        # a full read of the ids, so that the footer alone is not enough
        kept = [C.TablePair(p.table_name, p.source and p.source.where("id >= 0"), p.target, None, p.source_error) for p in part]
        return C.reconcile_totals(spark, kept)

    reports.write_report(pairs, report, f"{schema}.totals")
    got = {r.table_name: (r.source_count, r.source_error != "") for r in spark.table(f"{schema}.totals").collect()}
    assert got == {"a": (5, False), "bad": (None, True), "z": (5, False)}


def test_a_copy_goes_on_after_a_corrupt_file(spark, schema, half_corrupt):
    spark.sql(f"CREATE TABLE {schema}.bad (id bigint) USING parquet LOCATION '{half_corrupt[0]}'")
    spark.range(3).write.saveAsTable(f"{schema}.good")
    log = loads.copy_tables(spark, ["bad", "good"], lambda n: f"{schema}.{n}", lambda n: f"{schema}.copy_{n}")
    assert [tuple(r) for r in log.orderBy("table_name").select("table_name", "status").collect()] == [("bad", "FAILED"), ("good", "SUCCESS")]


def test_audit_ends_whatever_happens(spark, schema, half_corrupt):
    log = f"{schema}.log"

    def corrupt():
        broken_frame(spark, half_corrupt[0]).where("id >= 0").write.format("noop").mode("overwrite").save()

    def interrupted():
        raise KeyboardInterrupt("stop")

    assert loads.audited(spark, log, "a", corrupt).status == audit.ERROR
    with pytest.raises(KeyboardInterrupt):
        loads.audited(spark, log, "b", interrupted)
    latest = {r.table_name: r.status for r in audit.latest_status(spark.table(log)).collect()}
    assert latest == {"a": audit.ERROR, "b": audit.ERROR}


def test_scripts_are_run_to_their_end(spark, half_corrupt):
    text = "SELECT 1/id FROM range(1); SELECT id FROM range(2)"
    scripts = spark.createDataFrame([("f.sql", text)], "file_path string, text string")
    ready = spark.createDataFrame([("f.sql", True)], "file_path string, ready boolean")
    got = gate.run_scripts(spark, scripts, ready).orderBy("position").collect()
    assert [r.status for r in got] == ["Failed", "Success"]


def test_a_connection_that_fails_is_an_error_text(spark):
    read = lambda name: spark.read.jdbc("jdbc:nothing://nowhere", name)
    assert isinstance(catalog.open_or_error(read, "t"), str)


def test_a_tolerant_read_names_what_it_skipped(spark, schema, half_corrupt):
    path, broken = half_corrupt
    skipped = files.skipped_files(spark, path, schema="id bigint").collect()
    assert [os.path.basename(r.file_path) for r in skipped] == [broken]
    df = files.parquet(spark, path, tolerant=True, schema="id bigint")
    result = loads.full_load(df, f"{schema}.t", source_rows=1000)
    assert result.status == "VALIDATION_FAILED" and result.target_rows < 1000


def test_a_file_with_damaged_pages_is_named(spark):
    """Footer and magic numbers are good; the pages in between are not."""
    path = scratch_path(spark, "pages")
    rows = spark.range(0, 20000, 1, 4).selectExpr("id", "concat('some text ', id) AS t")
    rows.write.option("compression", "snappy").parquet(path)
    named = sorted(glob.glob(f"{path.removeprefix('file://')}/*.parquet"))
    with open(named[1], "r+b") as damaged:
        damaged.seek(4)
        damaged.write(os.urandom(3000))
    schema = "id bigint, t string"
    skipped = files.skipped_files(spark, path, schema=schema).collect()
    assert [(os.path.basename(r.file_path), r.lost_rows) for r in skipped] == [(os.path.basename(named[1]), 5000)]
    ledger = files.file_ledger(spark, path, schema=schema).collect()
    assert sum(r.footer_rows for r in ledger) == 20000 and sum(r.decoded_rows for r in ledger) == 15000


def test_a_date_that_stays_unread_fails_a_load(spark, schema):
    df = spark.createDataFrame([(1, 1700000000), (2, 1700000001), (3, 1700000000123), (4, 20240101)], "k int, at bigint")
    result = loads.guarded_load(df, f"{schema}.t", {"at": "timestamp"})
    assert (result.status, result.misfits) == ("VALIDATION_FAILED", {"at": 4})


def test_buckets_have_a_bound(spark):
    df = spark.range(3)
    with pytest.raises(ValueError, match="power of two"):
        H.differing_rows(df, df, buckets=1 << 21)


def test_misfits_fail_a_load(spark, schema):
    df = spark.createDataFrame([(1, 1700000000), (2, 1700000001), (3, 1700000000123)], "k int, at bigint")
    result = loads.guarded_load(df, f"{schema}.t", {"at": "timestamp"})
    assert (result.status, result.misfits, result.target_rows) == ("VALIDATION_FAILED", {"at": 1}, 3)
    assert "1 values of at" in result.error
    with pytest.raises(ValueError, match="do not fit"):
        R.repair(df, {"at": "timestamp"}, strict=True)


def test_day_numbers_beyond_all_dates_are_null(spark):
    df = spark.createDataFrame([(1,), (20000,), (9_000_000_000_000,)], "d bigint")
    assert [r.d is None for r in R.repair(df, {"d": "date"}).collect()] == [False, False, True]


@pytest.mark.parametrize(
    ("kind", "value", "year"),
    [
        ("string", "2024-02-29 10:11:12", 2024), ("string", "20240229101112", 2024), ("string", "20240229", 2024),
        ("string", "1709201472", 2024), ("string", "1709201472000", 2024), ("string", "29/02/2024", None),
        ("bigint", 20240229101112, 2024), ("bigint", 20240229, 2024), ("bigint", 1709201472, 2024), ("bigint", 19782, 2024),
        ("bigint", -5, None),
    ],
)
def test_mixed_forms(spark, kind, value, year):
    got = R.repair_mixed(spark.createDataFrame([(value,)], f"d {kind}"), {"d": "timestamp"}).first().d
    assert (got and got.year) == year


def test_a_table_without_known_dates_does_not_vanish(spark):
    some = spark.createDataFrame([("x",), (None,), ("y",)], "d string")
    pairs = [C.TablePair("t", some, some.limit(1), "d")]
    (row,) = C.reconcile_months(spark, pairs).collect()
    assert (row.target_table_name, row.dpYear, row.validation_status) == ("t", None, "not_data_found")
    (undated,) = C.undated_rows(spark, pairs).collect()
    assert (undated.source_undated, undated.target_undated, undated.is_matching) == (3, 1, False)


def test_ranges_of_nothing(spark):
    assert C.date_ranges([], {}).collect() == []
    (row,) = C.date_ranges([C.TablePair("t", None, None)], {"t": ["d"]}).collect()
    assert (row.table_name, row.is_matching) == ("t", False)


def test_discard_stays_below_the_scratch_folder(spark, tmp_path):
    path = scratch_path(spark, "x")
    spark.range(1).write.parquet(path)
    discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        discard(spark, str(tmp_path))




def test_an_incremental_load_moves_only_keys_of_the_old_side(spark):
    wide = [f"id AS c{i}" for i in range(6)]
    new, old = spark.range(50).selectExpr("id", *wide), spark.range(10, 60).selectExpr("id", *wide)
    missing = incremental_rows(new, old)
    exchanged = [line for line in plan_of(missing).splitlines() if "Exchange" in line]
    assert sorted(r.id for r in missing.collect()) == list(range(10))
    assert len(exchanged) <= 3
    maps = spark.sql("SELECT map('a', 1, 'b', 2) AS m UNION ALL SELECT map('c', 3)")
    other = spark.sql("SELECT map('b', 2, 'a', 1) AS m")
    assert [r.m for r in incremental_rows(maps, other).collect()] == [{"c": 3}]
    nulls = spark.createDataFrame([(1, None), (None, 1)], "a int, b int")
    assert [tuple(r) for r in incremental_rows(nulls, nulls.limit(1)).collect()] == [(None, 1)]
    longer = spark.createDataFrame([(1,)], "a bigint")
    assert incremental_rows(spark.createDataFrame([(1,), (2,)], "a int"), longer).schema.simpleString() == "struct<a:int>"


def test_files_of_the_ledger_grow_in_number_not_in_size(spark, sf_dir, monkeypatch):
    small = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"}
    asked, found = [], files.file_ledger
    monkeypatch.setattr(files, "file_ledger", lambda spark, path: asked.append(path) or found(spark, path))
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        row = soundness.source_file_ledger(spark, sf_dir).first()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    total = fx.table(spark, sf_dir, "lineitem").count()
    assert tuple(row) == (total, total, 0)
    sizes = [r["footer_rows"] for r in found(spark, *asked).collect()]
    assert len(sizes) > 7 and max(sizes) < total / 7
