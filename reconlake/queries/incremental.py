"""Incremental rows and loads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.operators.incremental import incremental_rows
from reconlake.plans import loads
from reconlake.queries import fixtures as fx
from reconlake.queries import query
from reconlake.session import scratch_path
from reconlake.sinks import tables as sink

CUTOFF = "1996-03-01"
_COLUMNS = list(fx.ORDERS_SRC.columns)


def _missing(equals: str, since: str | None = None, distinct: bool = False) -> str:
    match = " AND ".join(f"n.{c} {equals} e.{c}" for c in _COLUMNS)
    kept = f" WHERE o_orderdate > TIMESTAMP '{since} 00:00:00'" if since else ""
    return (
        f"SELECT {'DISTINCT ' if distinct else ''}n.* FROM (SELECT * FROM orders_tgt{kept}) n "
        f"WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM orders_src{kept}) e WHERE {match})"
    )


def _sql(*args, **kwargs) -> str:
    return f"{fx.PAIR} {_missing(*args, **kwargs)}"


_SAME = "IS NOT DISTINCT FROM"


@query("incr_rows_safe", _sql(_SAME))
def incr_rows_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = fx.orders_pair(spark, sf_dir)
    return incremental_rows(target, source)


@query("incr_rows_compat", _sql("="))
def incr_rows_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = fx.orders_pair(spark, sf_dir)
    return incremental_rows(target, source, null_safe=False)


@query("incr_rows_since", _sql(_SAME, CUTOFF))
def incr_rows_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = fx.orders_pair(spark, sf_dir)
    return incremental_rows(target, source, "o_orderdate", CUTOFF)


@query("incr_rows_deduped", _sql(_SAME, CUTOFF, True))
def incr_rows_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = fx.orders_pair(spark, sf_dir)
    return incremental_rows(target, source, "o_orderdate", CUTOFF, dedupe=True)


_ALL_COPIES = "SELECT l_returnflag, l_linestatus, l_shipdate FROM lineitem"


@query(
    "incr_rows_repeated",
    f"SELECT n.* FROM ({_ALL_COPIES}) n WHERE NOT EXISTS (SELECT 1 FROM ({_ALL_COPIES} "
    "WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00') e WHERE n.l_returnflag = e.l_returnflag "
    "AND n.l_linestatus = e.l_linestatus AND n.l_shipdate = e.l_shipdate)",
)
def incr_rows_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that occur many times, all copies kept."""
    rows = fx.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_shipdate")
    return incremental_rows(rows, rows.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("date")))


def _own_schema(spark: SparkSession) -> str:
    """A new schema whose tables lie in the scratch folder."""
    name = f"recon_{uuid.uuid4().hex}"
    sink.ensure_schema(spark, name, location=scratch_path(spark, "tables"))
    return name


@query(
    "load_incremental",
    f"{fx.PAIR} SELECT * FROM orders_src UNION ALL ({_missing(_SAME, CUTOFF)})",
)
def load_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after the second copy was loaded into the first."""
    source, target = fx.orders_pair(spark, sf_dir)
    table = f"{_own_schema(spark)}.orders"
    loads.full_load(source, table)
    loads.incremental_load(target, table, "o_orderdate", CUTOFF)
    return spark.table(table)


@query(
    "load_incremental_indexed",
    f"{fx.PAIR} SELECT * FROM orders_src UNION ALL ({_missing(_SAME, CUTOFF)})",
)
def load_incremental_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by sketches of each file's keys; loaded twice, and the second time nothing is new."""
    source, target = fx.orders_pair(spark, sf_dir)
    table = f"{_own_schema(spark)}.orders"
    loads.full_load(source.repartitionByRange("o_orderdate"), table)
    sketches = scratch_path(spark, "sketches")
    for _ in range(2):
        loads.indexed_load(target, table, sketches, "o_orderdate", CUTOFF)
    return spark.table(table)


@query("load_full", "SELECT * FROM lineitem")
def load_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{_own_schema(spark)}.lineitem"
    loads.full_load(fx.table(spark, sf_dir, "lineitem"), table)
    return spark.table(table)


@query(
    "load_guarded",
    """SELECT event_id, ts - INTERVAL 330 MINUTE AS ts, user_id, event_type,
              CAST(ts AS date) AS day_number FROM events""",
)
def load_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded twice: the second time the schema is checked and the rows are replaced."""
    events = fx.table(spark, sf_dir, "events")
    raw = events.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        F.date_diff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")).alias("day_number"),
    )
    table = f"{_own_schema(spark)}.events"
    for _ in range(2):
        loads.guarded_load(raw, table, {"day_number": "date"})
    return spark.table(table)


@query(
    "load_copy_log",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, 'SUCCESS' AS status, count(*) AS source_count, "
        f"count(*) AS target_count FROM {n}"
        for n in ("nation", "customer", "orders")
    )
    + " UNION ALL SELECT 'gone', 'FAILED', NULL, NULL",
)
def load_copy_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log of copying three tables from one schema to another, and one that is missing."""
    source, target = _own_schema(spark), _own_schema(spark)
    names = ["nation", "customer", "orders"]
    for n in names:
        sink.create_only(fx.table(spark, sf_dir, n), f"{source}.{n}")
    log = loads.copy_tables(
        spark, [*names, "gone"], lambda n: f"{source}.{n}", lambda n: f"{target}.{n}"
    )
    return log.select("table_name", "status", "source_count", "target_count")
