"""JDBC reads from an embedded in-memory database; no server and no port."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows

from reconlake.functions import status
from reconlake.functions.dates import date_fields
from reconlake.operators import counts as C
from reconlake.plans import exports
from reconlake.queries import fixtures as fx
from reconlake.sources import jdbc

URL = "jdbc:derby:memory:recon;create=true"
DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@pytest.fixture(scope="module")
def orders(spark, sf_dir):
    df = fx.table(spark, sf_dir, "orders")
    writer = df.withColumn("o_orderdate", df.o_orderdate.cast("timestamp"))
    writer.write.jdbc(URL, "orders", mode="overwrite", properties={**DRIVER, "createTableColumnTypes": "o_orderstatus varchar(8), o_orderpriority varchar(32)"})
    prices = spark.sql("SELECT CAST(1.5 AS decimal(12,4)) AS d, 7 AS n")
    prices.write.jdbc(URL, "prices", mode="overwrite", properties=DRIVER)
    return df


def test_table_and_subquery(spark, orders):
    assert jdbc.table(spark, URL, "orders", **DRIVER).count() == orders.count()
    sub = jdbc.table(spark, URL, '(SELECT "o_orderkey" FROM orders WHERE "o_orderkey" < 10) t', **DRIVER)
    assert sub.columns == ["o_orderkey"] and sub.count() == orders.filter("o_orderkey < 10").count()


def test_query_runs_in_the_database(spark, orders):
    assert jdbc.row_count(spark, URL, "orders", **DRIVER).first()[0] == orders.count()
    bounds = jdbc.time_bounds(spark, URL, "orders", '"o_orderdate"', **DRIVER).first()
    assert bounds[0] < bounds[1]


def test_days_counted_in_the_database(spark, orders):
    """The remote side sends one row per day; the copy lost two days' worth of rows."""
    since = "1997-01-01 00:00:00"
    remote = jdbc.period_counts(
        spark, URL, "orders", '"o_orderdate"', since, part="{part}({column})", **DRIVER
    )
    keys = ["dpYear", "dpMonth", "dpDay"]
    copy = orders.filter("o_orderdate NOT BETWEEN '1998-03-01' AND '1998-03-02'")
    local = C.one_sided_days(copy, "o_orderdate", "1997-01-01", "target_count")
    merged = C.with_status(C.merge_counts(remote, local, keys))
    expected = C.with_status(C.day_counts(orders, copy, "o_orderdate", "1997-01-01"))
    assert rows(merged) == rows(expected)
    months = jdbc.period_counts(
        spark, URL, "orders", '"o_orderdate"', None, ("YEAR", "MONTH"), "{part}({column})", **DRIVER
    )
    expected = C.month_counts(orders, orders, "o_orderdate").drop("target_count")
    assert rows(months) == rows(expected)


def test_totals_counted_in_the_database(spark, orders):
    n = orders.count()
    remote = jdbc.row_count(spark, URL, "orders", **DRIVER).toDF("n").selectExpr(
        "'a' AS t", "CAST(n AS bigint) AS source_count"
    )
    local = spark.createDataFrame([("a", n), ("b", 1)], "t string, target_count long")
    merged = C.merge_counts(remote, local, ["t"], missing=None)
    labelled = merged.withColumn("s", status.total_label(merged.source_count, merged.target_count))
    assert rows(labelled) == [("a", n, n, "SUCCESS"), ("b", None, 1, "SOURCE_QUERY_FAIL")]


@pytest.mark.parametrize("reads", [1, 3])
def test_export_by_time_from_the_database(spark, orders, tmp_path, reads):
    out = exports.export_remote_by_time(
        spark, URL, "orders", "o_orderdate", str(tmp_path / "x"), 365, reads,
        column='"o_orderdate"', literal="TIMESTAMP('{}')", **DRIVER,
    )
    assert out.check.first().status == "VALIDATION_SUCCESS"
    local = exports.export_by_time(orders, str(tmp_path / "y"), "o_orderdate", 365)
    assert rows(out.manifest.drop("path")) == rows(local.manifest.drop("path"))


def test_partitioned_read(spark, orders):
    df = jdbc.partitioned(spark, URL, "orders", "o_orderkey", 0, 1500, 4, **DRIVER)
    assert df.rdd.getNumPartitions() == 4 and df.count() == orders.count()


def test_time_chunks_as_predicates(spark, orders):
    cut = dt.datetime(1998, 1, 1)
    ranges = [(dt.datetime(1990, 1, 1), cut), (cut, dt.datetime(2010, 1, 1))]
    assert jdbc.time_predicates("d", ranges[:1])[0].endswith("d < TIMESTAMP '1998-01-01 00:00:00'")
    found = jdbc.time_predicates('"o_orderdate"', ranges, literal="TIMESTAMP('{}')")
    df = jdbc.by_predicates(spark, URL, "orders", found, **DRIVER)
    assert df.rdd.getNumPartitions() == 3 and df.count() == orders.count()


def test_pages_cover_the_table(spark, orders):
    n = orders.count()
    ansi = "OFFSET {offset} ROWS FETCH NEXT {size} ROWS ONLY"
    pages = [
        jdbc.page(spark, URL, "orders", ['"o_orderkey"'], o, 700, ansi, **DRIVER)
        for o in range(0, n, 700)
    ]
    assert [p.count() for p in pages] == [min(700, n - o) for o in range(0, n, 700)]
    assert C.stack(pages).select("o_orderkey").distinct().count() == n


def test_probe_and_type_driven_projections(spark, orders):
    schema = jdbc.probe(spark, URL, "prices", **DRIVER)
    assert [f.name for f in schema] == ["d", "n"]
    df = jdbc.projected(spark, URL, "prices", jdbc.projection_from(schema), **DRIVER)
    assert dict(df.dtypes)["d"] == "double" and df.first().d == 1.5
    listed = jdbc.projection_for([("a b", "NUMERIC(12,4)"), ("i", "interval day"), ('q"x', "int")])
    assert listed == (
        'CAST("a b" AS NUMERIC(38,18)) AS "a b", CAST("i" AS VARCHAR) AS "i", "q""x"'
    )
    assert date_fields(jdbc.table(spark, URL, "orders", **DRIVER)) == ["o_orderdate"]


def test_remote_column_catalog(spark, orders):
    view = (
        "(SELECT c.COLUMNNAME AS column_name, CAST(c.COLUMNDATATYPE AS VARCHAR(64)) AS data_type, "
        "c.COLUMNNUMBER AS ordinal_position, s.SCHEMANAME AS table_schema, t.TABLENAME AS table_name "
        "FROM SYS.SYSCOLUMNS c JOIN SYS.SYSTABLES t ON c.REFERENCEID = t.TABLEID "
        "JOIN SYS.SYSSCHEMAS s ON t.SCHEMAID = s.SCHEMAID) v"
    )
    df = jdbc.remote_columns(spark, URL, "APP", "ORDERS", view, **DRIVER)
    assert [r[0] for r in df.orderBy("ORDINAL_POSITION").collect()] == orders.columns
