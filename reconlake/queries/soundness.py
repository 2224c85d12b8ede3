"""Defects that a kind fixture hides: tables that cannot be compared, values and rows that get lost."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.operators import counts as C
from reconlake.operators import discovery as D
from reconlake.operators import lineage as L
from reconlake.operators import repair as R
from reconlake.operators import row_hashes as H
from reconlake.plans import gate
from reconlake.plans.loads import guarded_load, verify_counts
from reconlake.queries import fixtures as fx
from reconlake.queries import query
from reconlake.session import scratch_path
from reconlake.sources import files

SINCE = "1900-01-01"
_LONG_AGO = "o_orderdate - INTERVAL 200 YEAR"
_UNDATED = "CASE WHEN o_orderkey % 7 = 0 THEN CAST(NULL AS date) ELSE CAST(o_orderdate AS date) END"


def _order_copy(date: str, where: str | None = None) -> fx.Derived:
    return fx.Derived("orders", {"k": "o_orderkey", "created": f"CAST({date} AS date)"}, where)


# Table, source, target. Each is whole but for the rows that a defect loses.
_TABLES: dict[str, tuple[fx.Derived, fx.Derived | None]] = {
    "s.good": (_order_copy("o_orderdate"), _order_copy("o_orderdate")),
    "s.plain": (fx.Derived("customer"), fx.Derived("customer")),
    "s.no_column": (_order_copy("o_orderdate"), fx.Derived("orders", {"k": "o_orderkey"})),
    "s.old_target": (_order_copy("o_orderdate"), _order_copy(_LONG_AGO)),
    "s.old_both": (_order_copy(_LONG_AGO), _order_copy(_LONG_AGO)),
    "s.null_dates": (_order_copy("CAST(NULL AS date)"), _order_copy("CAST(NULL AS date)")),
    "s.lost_undated": (_order_copy(_UNDATED), _order_copy(_UNDATED, "o_orderkey % 7 <> 0")),
    "s.lost_days": (_order_copy("o_orderdate"), _order_copy("o_orderdate", "o_orderkey % 97 <> 0")),
    "s.gone": (_order_copy("o_orderdate"), None),
}
_NAMES = list(_TABLES)
# One script per document: each reads a good table and, in turn, one of all tables.
_TURN = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_NAMES))
_SCRIPTS = fx.Derived(
    "documents",
    {
        "file_path": "concat('job_', CAST(doc_id AS string), '.sql')",
        "text": f"concat('SELECT * FROM s.good JOIN ', CASE doc_id % {len(_NAMES)} {_TURN} END)",
    },
)


def _readers(spark: SparkSession, sf_dir: str):
    def reader(side: int):
        def read(name: str) -> DataFrame:
            derived = _TABLES[name][side]
            return spark.table(f"missing.{name[2:]}") if derived is None else derived.frame(spark, sf_dir)

        return read

    return reader(0), reader(1)


def _sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.column_sheet(spark, {n: s.frame(spark, sf_dir) for n, (s, _) in _TABLES.items()})


_DATED = [n for n, (s, t) in _TABLES.items() if n not in ("s.plain", "s.gone", "s.no_column")]


def _dated_row(name: str) -> str:
    source, target = (d.sql() for d in _TABLES[name])

    def days(side: str) -> str:
        return f"SELECT created AS d, count(*) AS n FROM ({side}) WHERE created >= DATE '{SINCE}' GROUP BY 1"

    undated = " <> ".join(f"(SELECT count(*) FROM ({x}) WHERE created IS NULL)" for x in (source, target))
    return f"""SELECT '{name}' AS table_name, count(a.n) AS sd, count(b.n) AS td,
  count(a.n) FILTER (b.n IS NOT NULL) AS cd,
  count(*) FILTER (a.n IS DISTINCT FROM b.n) + CAST({undated} AS integer) AS bad
FROM ({days(source)}) a FULL JOIN ({days(target)}) b USING (d)"""


_REASONS = f"""WITH seen AS ({" UNION ALL ".join(map(_dated_row, _DATED))}),
v AS (SELECT table_name, true AS has_date,
  CASE WHEN sd = 0 THEN 'no source data since {SINCE}' WHEN td = 0 THEN 'no target data since {SINCE}'
       WHEN cd = 0 THEN 'no common day in source and target' WHEN bad > 0 THEN 'counts differ'
       ELSE 'ready' END AS reason FROM seen
UNION ALL SELECT 's.plain', false, 'ready'
UNION ALL SELECT 's.gone', true, 'table not compared' UNION ALL SELECT 's.no_column', true, 'table not compared')"""


@query("gate_table_reasons", _REASONS + " SELECT table_name, has_date, reason FROM v")
def gate_table_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted: a missing table, a missing column, no rows since the start, NULL dates, lost rows."""
    lineage = L.script_lineage(_SCRIPTS.frame(spark, sf_dir))
    verdicts = gate.corpus_verdicts(spark, lineage, _sheet(spark, sf_dir), *_readers(spark, sf_dir), SINCE)
    return gate.table_reasons(verdicts, SINCE)


@query(
    "gate_check_scripts",
    _REASONS
    + f""",
jobs AS ({_SCRIPTS.sql()}), used AS (
  SELECT file_path, 's.good' AS table_name FROM jobs
  UNION SELECT file_path, split_part(text, 'JOIN ', 2) FROM jobs)
SELECT file_path, count(*) AS total_tables, count(*) FILTER (has_date) AS dated_tables,
  bool_and(reason = 'ready') AS ready, coalesce(max(reason) FILTER (reason <> 'ready'), 'ready') AS reason
FROM used JOIN v USING (table_name) GROUP BY 1""",
)
def gate_check_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate itself: each bad table stands together with a good one in a script."""
    scripts = _SCRIPTS.frame(spark, sf_dir)
    return gate.check_scripts(spark, scripts, _sheet(spark, sf_dir), *_readers(spark, sf_dir), SINCE)


def _undated_sql(name: str) -> str:
    source, target = (f"(SELECT count(*) FROM ({d.sql()}) WHERE created IS NULL)" for d in _TABLES[name])
    return (
        f"SELECT '{name}' AS table_name, 'created' AS date_column, {source} AS source_undated, "
        f"{target} AS target_undated, {source} = {target} AS is_matching"
    )


@query("recon_undated", " UNION ALL ".join(map(_undated_sql, _DATED)))
def recon_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = [
        C.TablePair(n, *[d.frame(spark, sf_dir) for d in _TABLES[n]], date_column="created") for n in _DATED
    ]
    return C.undated_rows(spark, pairs)


@query(
    "recon_date_range_gaps",
    """SELECT 'orders' AS table_name, 'o_orderdate' AS date_column, min(o_orderdate) AS source_min_date,
  max(o_orderdate) AS source_max_date, CAST(NULL AS timestamp) AS target_min_date,
  CAST(NULL AS timestamp) AS target_max_date, false AS is_matching FROM orders
UNION ALL SELECT 'events', 'ts', NULL, NULL, min(ts), max(ts), false FROM events""",
)
def recon_date_range_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted: a target without the column, and a source that cannot be read."""
    orders, events = fx.table(spark, sf_dir, "orders"), fx.table(spark, sf_dir, "events")
    pairs = [C.TablePair("orders", orders, orders.drop("o_orderdate")), C.TablePair("events", None, events)]
    return C.date_ranges(pairs, {"orders": ["o_orderdate"], "events": ["ts"]})


_SECONDS = "CAST(epoch(ts) AS bigint)"
_FORM = """CASE event_id % 50 WHEN 0 THEN {s} * 1000 WHEN 1 THEN 20240229 WHEN 2 THEN -{s} * 1000
  WHEN 3 THEN 99999999999999 ELSE {s} END"""


def _misfit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = "unix_seconds(CAST(ts AS timestamp))"
    return fx.table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"{_FORM.format(s=seconds)} AS happened",
        "CASE WHEN event_id % 40 = 0 THEN '01/02/2024' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS noted",
    )


@query(
    "repair_misfits",
    """SELECT event_id,
  CASE WHEN event_id % 50 > 3 THEN date_trunc('second', ts) END AS happened,
  CASE WHEN event_id % 40 <> 0 THEN date_trunc('second', ts) END AS noted FROM events""",
)
def repair_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted: 13, 8 and 14 digits and negative numbers among seconds; another form among texts."""
    out = R.repair(_misfit_rows(spark, sf_dir), {"happened": "timestamp", "noted": "timestamp"})
    return out.select("event_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("happened", "noted")])


@query(
    "load_guarded_result",
    """SELECT 'VALIDATION_FAILED' AS status, count(*) AS source_rows, count(*) AS target_rows,
  count(*) FILTER (event_id % 50 <= 3) AS happened_misfits, count(*) FILTER (event_id % 40 = 0) AS noted_misfits
FROM events""",
)
def load_guarded_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"guarded_{scratch_path(spark, 'x').rsplit('-', 1)[1]}"
    declared = {"happened": "timestamp", "noted": "timestamp"}
    r = guarded_load(_misfit_rows(spark, sf_dir), table, declared)
    row = (r.status, r.source_rows, r.target_rows, r.misfits.get("happened", 0), r.misfits.get("noted", 0))
    spark.sql(f"DROP TABLE {table}")
    return spark.createDataFrame(
        [row],
        "status string, source_rows bigint, target_rows bigint, happened_misfits bigint, noted_misfits bigint",
    )


@query(
    "count_status_all",
    """WITH a AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1),
b AS (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey % 5 <> 0 GROUP BY 1)
SELECT l_suppkey, a.n AS source_count, coalesce(b.n, 0) AS target_count,
  CASE WHEN a.n = b.n THEN 'VALIDATION_SUCCESS' ELSE 'VALIDATION_FAILED' END AS status
FROM a LEFT JOIN b USING (l_suppkey)""",
)
def count_status_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted: every fifth supplier is lost entirely, and is reported."""
    lines = fx.table(spark, sf_dir, "lineitem").select("l_suppkey")
    counts = C.side_counts(lines, lines.where("l_suppkey % 5 <> 0"))
    good, bad = verify_counts("", 1, 1).status, verify_counts("", 1, 0).status
    same = F.col("source_count") == F.col("target_count")
    return counts.withColumn("status", F.when(same, good).otherwise(bad))


# The rows since the start are compared as a whole; tables without a date column in all.
def _hashed_row(name: str) -> str:
    source, target = (f"SELECT * FROM ({d.sql()}) WHERE created >= DATE '{SINCE}'" for d in _TABLES[name])
    return f"""SELECT '{name}' AS name, (SELECT count(*) FROM ({source})) AS sd, (SELECT count(*) FROM ({target})) AS td,
  (SELECT count(*) FROM (({source} EXCEPT ALL {target}) UNION ALL ({target} EXCEPT ALL {source}))) AS n"""


_HASHED = f"""WITH v AS (
SELECT 's.plain' AS table_name, false AS has_date, 'ready' AS reason
UNION ALL SELECT 's.gone', true, 'table not compared' UNION ALL SELECT 's.no_column', true, 'table not compared'
UNION ALL SELECT name, true, CASE WHEN sd = 0 THEN 'no source data since {SINCE}'
  WHEN td = 0 THEN 'no target data since {SINCE}' WHEN n > 0 THEN 'rows differ' ELSE 'ready' END
FROM ({" UNION ALL ".join(map(_hashed_row, _DATED))}))"""


@query(
    "gate_hash_decisions",
    _HASHED
    + f""",
jobs AS ({_SCRIPTS.sql()}), used AS (
  SELECT file_path, 's.good' AS table_name FROM jobs
  UNION SELECT file_path, split_part(text, 'JOIN ', 2) FROM jobs)
SELECT file_path, count(*) AS total_tables, count(*) FILTER (has_date) AS dated_tables,
  bool_and(reason = 'ready') AS ready, coalesce(max(reason) FILTER (reason <> 'ready'), 'ready') AS reason
FROM used JOIN v USING (table_name) GROUP BY 1""",
)
def gate_hash_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate by row hash, over the same tables and scripts."""
    scripts, sheet = _SCRIPTS.frame(spark, sf_dir), _sheet(spark, sf_dir)
    return gate.check_scripts(spark, scripts, sheet, *_readers(spark, sf_dir), SINCE, how="hash")


_WRITERS = fx.Derived(
    "documents",
    {
        "file_path": "concat('job_', CAST(doc_id AS string), '.sql')",
        "text": "concat('INSERT INTO ', CASE doc_id % 3 WHEN 0 THEN 's.plain' WHEN 1 THEN 's.changed' "
        "ELSE 's.lost_days' END, ' SELECT 1')",
    },
)
_CHANGED = fx.Derived(
    "customer",
    {"c_custkey": "c_custkey", "c_acctbal": "CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 1 ELSE c_acctbal END"},
)
_BALANCES = fx.Derived("customer", {"c_custkey": "c_custkey", "c_acctbal": "c_acctbal"})


@query(
    "target_hash_check",
    f"""WITH w AS ({_WRITERS.sql()}), t AS (
SELECT 'plain' AS table_name, count(*) AS s, count(*) AS t, true AS ok FROM customer
UNION ALL SELECT 'changed', count(*), count(*), count(*) FILTER (c_custkey % 10 = 0) = 0 FROM customer
UNION ALL SELECT 'lost_days', count(*), count(*) FILTER (o_orderkey % 97 <> 0), count(*) FILTER (o_orderkey % 97 = 0) = 0
FROM orders)
SELECT file_path AS sql_file, 's' AS schema_name, table_name, s AS source_count, t AS target_count,
  CASE WHEN ok THEN 'Target rows match' ELSE 'Not Validated' END AS validation_status,
  CASE WHEN ok THEN 'Passed' ELSE 'Failed' END AS execution_status
FROM w JOIN t ON w.text LIKE 'INSERT INTO s.' || t.table_name || ' %'""",
)
def target_hash_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted: changed balances of the same number of rows, and lost rows."""
    tables = {"s.plain": _TABLES["s.plain"], "s.changed": (_BALANCES, _CHANGED), "s.lost_days": _TABLES["s.lost_days"]}

    def reader(side: int):
        return lambda name: tables[name][side].frame(spark, sf_dir)

    lineage = L.script_lineage(_WRITERS.frame(spark, sf_dir))
    return gate.check_targets(spark, lineage, reader(0), reader(1), how="hash")


@query(
    "recon_hash_type_drift",
    """SELECT count(*) AS source_hash_count, count(*) AS target_hash_count, count(*) AS matched_hash_count,
  0 AS source_only, 0 AS target_only, 0 AS uneven_copies, 0 AS rows_lost, 0 AS rows_added,
  'Match' AS validation_status, 'Match' AS multiset_status
FROM (SELECT DISTINCT o_orderkey, CAST(o_totalprice AS decimal(12,2)), o_orderdate FROM orders)""",
)
def recon_hash_type_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal values in the types that a repair leaves behind, and maps with another order of entries."""
    orders = fx.table(spark, sf_dir, "orders")
    key, price, day = "o_orderkey", "CAST(o_totalprice AS decimal(12,2))", "CAST(o_orderdate AS date)"
    source = orders.selectExpr(f"{key} AS k", f"{price} AS p", f"{day} AS d", "map('a', 1, 'b', 2) AS m")
    target = orders.selectExpr(
        f"CAST({key} AS decimal(20,0)) AS k", f"CAST({price} AS decimal(38,18)) AS p",
        f"CAST({day} AS timestamp_ntz) AS d", "map('b', 2, 'a', 1) AS m",
    )
    return H.compare_rows(source, target)


def _unread_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted: a third of the values in each of three forms, so that none has the majority."""
    seconds = "CAST(unix_seconds(CAST(ts AS timestamp)) AS bigint)"
    at = (
        f"CASE event_id % 3 WHEN 0 THEN {seconds} WHEN 1 THEN {seconds} * 1000 "
        "ELSE CAST(date_format(ts, 'yyyyMMdd') AS bigint) END AS happened"
    )
    return fx.table(spark, sf_dir, "events").selectExpr("event_id", at)


@query(
    "load_unread_dates",
    """SELECT 'VALIDATION_FAILED' AS status, count(*) AS source_rows, count(*) AS target_rows,
  count(ts) AS unread FROM events""",
)
def load_unread_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared date that no form fits is loaded as it is, and the load says so."""
    table = f"unread_{scratch_path(spark, 'x').rsplit('-', 1)[1]}"
    r = guarded_load(_unread_rows(spark, sf_dir), table, {"happened": "timestamp"})
    spark.sql(f"DROP TABLE {table}")
    row = (r.status, r.source_rows, r.target_rows, r.misfits.get("happened", 0))
    return spark.createDataFrame([row], "status string, source_rows bigint, target_rows bigint, unread bigint")


@query(
    "recon_hash_bucketed_drift",
    """SELECT count(*) FILTER (o_orderkey % 100 = 0) AS lost, 0 AS added FROM orders""",
)
def recon_hash_bucketed_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket by bucket, in two types that hold the same values; planted: every hundredth order is lost."""
    orders = fx.table(spark, sf_dir, "orders")
    price = "CAST(o_totalprice AS decimal(12,2))"
    source = orders.selectExpr("o_orderkey AS k", f"{price} AS p")
    target = orders.where("o_orderkey % 100 <> 0").selectExpr("CAST(o_orderkey AS decimal(20,0)) AS k", f"CAST({price} AS decimal(38,18)) AS p")
    found = H.differing_rows(source, target, buckets=1024)
    lost = F.greatest(F.col("source_count") - F.col("target_count"), F.lit(0))
    added = F.greatest(F.col("target_count") - F.col("source_count"), F.lit(0))
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in ((lost, "lost"), (added, "added"))]
    return found.agg(*total)


@query(
    "source_file_ledger",
    "SELECT count(*) AS footer_rows, count(*) AS decoded_rows, 0 AS short_files FROM lineitem",
)
def source_file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by footer and rows decoded, over the files of an export."""
    path = scratch_path(spark, "ledger")
    rows = fx.table(spark, sf_dir, "lineitem")
    # several files, more with the splits of the scan, so that none grows with the table; a split is far larger in a shuffle
    rows.repartition(max(7, 4 * rows.rdd.getNumPartitions())).write.parquet(path)
    found = files.file_ledger(spark, path)
    short = F.coalesce(F.col("decoded_rows") < F.col("footer_rows"), F.lit(True))
    return found.agg(
        F.sum("footer_rows").alias("footer_rows"), F.sum("decoded_rows").alias("decoded_rows"), F.count_if(short).alias("short_files")
    )
