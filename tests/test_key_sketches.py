"""Sketches of the keys of data files: files that cannot hold a delta's rows are not opened."""

from __future__ import annotations

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from reconlake.operators import key_sketches as ks
from reconlake.operators.incremental import incremental_rows, rows_not_in
from reconlake.plans import loads
from reconlake.session import scratch_path
from conftest import rows

_SHAPE = "id long, day date, price double, tags map<string,int>, note string"


def _orders(spark, first, last):
    return spark.range(first, last).selectExpr(
        "id",
        "IF(id % 500 = 7, NULL, date_add(DATE '2024-01-01', CAST(id DIV 40 AS int))) AS day",
        "IF(id % 9 = 0, NULL, id / 4) AS price",
        "map('a', CAST(id AS int)) AS tags",
        "concat('note ', id) AS note",
    )


def _loaded(spark, schema):
    """Ten files, each of some weeks, and their sketches."""
    table = f"{schema}.t"
    _orders(spark, 0, 8000).repartitionByRange(10, "id").write.saveAsTable(table)
    sketches = scratch_path(spark, "sketches")
    ks.write_sketches(spark.table(table), sketches, "day")
    return table, sketches


def _path_of(spark, table, id_):
    row = spark.table(table).where(F.col("id") == id_).select("_metadata.file_path").first()
    return row[0].replace("file:", "").replace("///", "/")


def _damage(path):
    """Garbage of the same length under the same time, so that the file is still the version that was sketched."""
    at = os.stat(path)
    with open(path, "r+b") as f:
        f.write(b"\0" * at.st_size)
    os.utime(path, ns=(at.st_atime_ns, at.st_mtime_ns))
    for crc in glob.glob(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")):
        os.utime(crc)


def test_no_file_with_a_row_of_the_delta_is_passed_over(spark, schema):
    table, sketches = _loaded(spark, schema)
    versions = spark.table(table).select("id", ks.file_version().alias("file"))
    for ids in ([5], [7, 4000], [0, 1, 7999], [507]):
        delta = spark.table(table).where(F.col("id").isin(ids))
        held = {r.file for r in versions.where(F.col("id").isin(ids)).collect()}
        passed = set(ks.files_without(delta, sketches))
        assert not held & passed
        assert len(passed) >= 7


def test_files_that_are_passed_over_are_not_opened(spark, schema):
    table, sketches = _loaded(spark, schema)
    _damage(_path_of(spark, table, 100))
    delta = _orders(spark, 7900, 8100).where("day IS NOT NULL")
    found = rows_not_in(delta, ks.may_hold(spark.table(table), delta, sketches))
    assert rows(found.select("id")) == rows(_orders(spark, 8000, 8100).where("day IS NOT NULL").select("id"))
    with pytest.raises(Exception):
        spark.table(table).selectExpr("sum(price)").collect()


def test_a_changed_or_new_file_is_read(spark, schema):
    table, sketches = _loaded(spark, schema)
    os.utime(_path_of(spark, table, 100), (1_000_000_000, 1_000_000_000))
    _orders(spark, 20000, 20010).coalesce(1).write.mode("append").saveAsTable(table)
    spark.catalog.refreshTable(table)
    delta = _orders(spark, 0, 1)
    left = {r.id for r in ks.may_hold(spark.table(table), delta, sketches).select("id").collect()}
    assert {0, 100, 20000} <= left
    before = spark.read.parquet(f"{sketches}/files").count()
    ks.add_sketches(spark.table(table), sketches)
    assert spark.read.parquet(f"{sketches}/files").count() == before + 2


def test_without_sketches_or_with_other_columns_everything_is_read(spark, schema):
    table, sketches = _loaded(spark, schema)
    everything = spark.table(table).count()
    delta = _orders(spark, 0, 1)
    assert ks.may_hold(spark.table(table), delta, f"{sketches}-gone").count() == everything
    assert ks.files_without(delta.withColumn("id", F.col("id").cast("int")), sketches) == []
    with pytest.raises(ValueError):
        ks.add_sketches(spark.table(table).drop("note"), sketches)


def test_indexed_load_equals_the_plain_one(spark, schema):
    plain, indexed = f"{schema}.a", f"{schema}.b"
    for name in (plain, indexed):
        _orders(spark, 0, 4000).repartitionByRange(6, "id").write.saveAsTable(name)
    new = _orders(spark, 3900, 4200).unionByName(_orders(spark, 4100, 4110))
    sketches = scratch_path(spark, "sketches")
    one = loads.incremental_load(new, plain, "day", "2024-02-01")
    two = loads.indexed_load(new, indexed, sketches, "day", "2024-02-01")
    assert two.status == one.status and two.target_rows == one.target_rows > 0
    assert rows(spark.table(plain)) == rows(spark.table(indexed))
    assert loads.indexed_load(new, indexed, sketches, "day", "2024-02-01").target_rows == 0
    assert loads.indexed_load(new, f"{schema}.gone", sketches, "day", "2024-02-01").status == "ERROR"


def test_rows_are_compared_by_value(spark):
    a = spark.createDataFrame(
        [(1, None, 0.0, {"x": 1}, "a"), (1, None, -0.0, {"x": 1}, "a"), (2, None, 1.0, None, None)], _SHAPE
    )
    b = spark.createDataFrame([(1, None, 0.0, {"x": 1}, "a")], _SHAPE)
    assert rows(rows_not_in(a, b).select("id")) == [(2,)]
    assert rows(rows_not_in(a, b)) == rows(incremental_rows(a, b))
    assert rows_not_in(a, b.limit(0)).count() == 3
    assert rows_not_in(a.limit(0), b).count() == 0


def test_an_empty_table_has_sketches(spark, schema):
    table = f"{schema}.e{uuid.uuid4().hex[:6]}"
    _orders(spark, 0, 0).write.saveAsTable(table)
    new = _orders(spark, 0, 50)
    result = loads.indexed_load(new, table, scratch_path(spark, "sketches"), "day", "2023-01-01")
    assert result.target_rows == new.where("day IS NOT NULL").count()
