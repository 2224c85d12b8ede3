"""Count, hash and range reconciliation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.functions import dates, status
from reconlake.operators import counts as C
from reconlake.operators import digest_tree
from reconlake.operators import row_hashes as H
from reconlake.operators.rollups import failed_tables
from reconlake.plans.reports import write_report
from reconlake.queries import ORACLES, query
from reconlake.queries import fixtures as fx
from reconlake.session import scratch_path
from reconlake.sinks import tables as sink

START = "1996-06-01"

_DAY_SIDES = """
s AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, count(*) AS n
      FROM orders_src WHERE o_orderdate IS NOT NULL{since} GROUP BY ALL),
t AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, count(*) AS n
      FROM orders_tgt WHERE o_orderdate IS NOT NULL{since} GROUP BY ALL)"""
_DAY_SQL = (
    fx.PAIR
    + ","
    + _DAY_SIDES
    + """
SELECT CAST(coalesce(s.y, t.y) AS int) AS dpYear, CAST(coalesce(s.m, t.m) AS int) AS dpMonth,
       CAST(coalesce(s.d, t.d) AS int) AS dpDay, coalesce(s.n, 0) AS source_count,
       coalesce(t.n, 0) AS target_count,
       CASE WHEN coalesce(s.n, 0) = coalesce(t.n, 0) THEN 'SUCCESS' ELSE 'FAILURE' END
         AS validation_status
FROM s FULL JOIN t ON s.y = t.y AND s.m = t.m AND s.d = t.d"""
)


@query("recon_day", _DAY_SQL.format(since=""))
def recon_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = fx.orders_pair(spark, sf_dir)
    return C.with_status(C.day_counts(source, target, "o_orderdate"))


@query("recon_day_counted_apart", _DAY_SQL.format(since=f" AND o_orderdate >= DATE '{START}'"))
def recon_day_counted_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each side is counted for itself, as when one is counted in its own database."""
    source, target = fx.orders_pair(spark, sf_dir)
    merged = C.merge_counts(
        C.one_sided_days(source, "o_orderdate", START, "source_count"),
        C.one_sided_days(target, "o_orderdate", START, "target_count"),
        ["dpYear", "dpMonth", "dpDay"],
    )
    return C.with_status(merged)


@query("recon_day_since", _DAY_SQL.format(since=f" AND o_orderdate >= DATE '{START}'"))
def recon_day_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = fx.orders_pair(spark, sf_dir)
    return C.with_status(C.day_counts(source, target, "o_orderdate", START))


@query(
    "recon_month",
    fx.PAIR
    + """,
s AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n
      FROM orders_src GROUP BY ALL),
t AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n
      FROM orders_tgt GROUP BY ALL)
SELECT CAST(coalesce(s.y, t.y) AS int) AS dpYear, CAST(coalesce(s.m, t.m) AS int) AS dpMonth,
       coalesce(s.n, 0) AS source_count, coalesce(t.n, 0) AS target_count,
       CASE WHEN coalesce(s.n, 0) = coalesce(t.n, 0) THEN 'SUCCESS' ELSE 'FAILURE' END
         AS validation_status
FROM s FULL JOIN t ON s.y = t.y AND s.m = t.m""",
)
def recon_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = fx.orders_pair(spark, sf_dir)
    return C.with_status(C.month_counts(source, target, "o_orderdate"))


@query(
    "recon_day_by_group",
    fx.ctes(t=fx.altered("lineitem"))
    + """,
a AS (SELECT l_returnflag AS f, CAST(l_shipdate AS date) AS d, count(*) AS n FROM lineitem
      GROUP BY ALL),
b AS (SELECT l_returnflag AS f, CAST(l_shipdate AS date) AS d, count(*) AS n FROM t GROUP BY ALL)
SELECT coalesce(a.f, b.f) AS l_returnflag, CAST(year(coalesce(a.d, b.d)) AS int) AS dpYear,
       CAST(month(coalesce(a.d, b.d)) AS int) AS dpMonth,
       CAST(day(coalesce(a.d, b.d)) AS int) AS dpDay,
       coalesce(a.n, 0) AS source_count, coalesce(b.n, 0) AS target_count,
       CASE WHEN coalesce(a.n, 0) = coalesce(b.n, 0) THEN 'SUCCESS' ELSE 'FAILURE' END
         AS validation_status
FROM a FULL JOIN b ON a.f = b.f AND a.d = b.d""",
)
def recon_day_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = fx.table(spark, sf_dir, "lineitem")
    target = fx.altered("lineitem").frame(spark, sf_dir)
    return C.with_status(C.day_counts(source, target, "l_shipdate", by=["l_returnflag"]))


_THREE_WAY = (
    fx.PAIR
    + ","
    + _DAY_SIDES.format(since="")
    + """
SELECT CAST(coalesce(s.y, t.y) AS int) AS dpYear, CAST(coalesce(s.m, t.m) AS int) AS dpMonth,
       CAST(coalesce(s.d, t.d) AS int) AS dpDay, s.n AS source_count, t.n AS target_count,
       CASE WHEN s.n IS NULL OR t.n IS NULL THEN 'Not Applicable' WHEN s.n = t.n THEN 'Success'
            ELSE 'Failure' END AS validation_status,
       'Success' AS date_column_validation
FROM s {how} JOIN t ON s.y = t.y AND s.m = t.m AND s.d = t.d"""
)


def _three_way(spark: SparkSession, sf_dir: str, common_days_only: bool) -> DataFrame:
    source, target = fx.orders_pair(spark, sf_dir)
    used = F.lit("o_orderdate")
    return C.three_way(C.day_counts(source, target, "o_orderdate"), used, used, common_days_only)


@query("recon_day_three_way", _THREE_WAY.format(how="FULL"))
def recon_day_three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _three_way(spark, sf_dir, common_days_only=False)


@query("recon_day_source_days", _THREE_WAY.format(how="LEFT"))
def recon_day_source_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _three_way(spark, sf_dir, common_days_only=True)


def _pairs(spark: SparkSession, sf_dir: str) -> list[C.TablePair]:
    """Every given table against its altered copy, and two that cannot be read on one side."""
    pairs = [
        C.TablePair(
            f"dwh.{n}",
            fx.table(spark, sf_dir, n),
            fx.altered(n).frame(spark, sf_dir),
            fx.DATE_COLUMNS.get(n),
        )
        for n in fx.TABLES
    ]
    orders = fx.table(spark, sf_dir, "orders")
    pairs.append(C.TablePair("dwh.gone", None, orders, "o_orderdate", "no such table"))
    pairs.append(C.TablePair("dwh.left", orders, None, "o_orderdate", None, "not there"))
    return pairs


def _total_rows() -> str:
    rows = [
        f"SELECT 'dwh' AS source_schema, '{n}' AS table_name, 'old.dwh.{n}' AS source_table, "
        f"'new.dwh.{n}' AS catalog_table, (SELECT count(*) FROM {n}) AS source_count, "
        f"(SELECT count(*) FROM ({fx.altered(n).sql()})) AS catalog_count, "
        "'' AS source_error, '' AS catalog_error"
        for n in fx.TABLES
    ]
    rows.append(
        "SELECT 'dwh', 'gone', 'old.dwh.gone', 'new.dwh.gone', NULL, (SELECT count(*) FROM orders),"
        " 'no such table', ''"
    )
    rows.append(
        "SELECT 'dwh', 'left', 'old.dwh.left', 'new.dwh.left', (SELECT count(*) FROM orders), NULL,"
        " '', 'not there'"
    )
    return f"""WITH r AS ({' UNION ALL '.join(rows)})
SELECT *, CASE WHEN source_count IS NULL THEN 'SOURCE_QUERY_FAIL'
               WHEN catalog_count IS NULL THEN 'CATALOG_QUERY_FAIL'
               WHEN source_count = catalog_count THEN 'SUCCESS' ELSE 'FAIL' END AS status FROM r"""


@query("recon_total", _total_rows())
def recon_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.reconcile_totals(spark, _pairs(spark, sf_dir), "old", "new")


@query(
    "recon_failed_tables",
    f"SELECT table_name, status FROM ({_total_rows()}) WHERE status IN ('FAIL', 'CATALOG_QUERY_FAIL')",
)
def recon_failed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = C.reconcile_totals(spark, _pairs(spark, sf_dir), "old", "new")
    return failed_tables(totals).select("table_name", "status")


def _period_rows(day: bool, start: str | None) -> str:
    day_key = "CAST(day({c}) AS int)" if day else "0"
    parts = []
    for n, c in fx.DATE_COLUMNS.items():
        since = f" AND {c} >= DATE '{start}'" if start else ""
        keys = f"CAST(year({c}) AS int) AS y, CAST(month({c}) AS int) AS m, {day_key.format(c=c)} AS d"
        side = "SELECT " + keys + ", count(*) AS n FROM ({rel}) WHERE " + c + " IS NOT NULL" + since
        a = side.format(rel=f"SELECT * FROM {n}") + " GROUP BY ALL"
        b = side.format(rel=fx.altered(n).sql()) + " GROUP BY ALL"
        parts.append(
            f"SELECT 'dwh.{n}' AS target_table_name, coalesce(a.y, b.y) AS dpYear, "
            f"coalesce(a.m, b.m) AS dpMonth, coalesce(a.d, b.d) AS dpDay, "
            f"coalesce(a.n, 0) AS source_count, coalesce(b.n, 0) AS target_count, "
            f"'{c}' AS date_column_used "
            f"FROM ({a}) a FULL JOIN ({b}) b ON a.y = b.y AND a.m = b.m AND a.d = b.d"
        )
    label = (
        "CASE WHEN source_count = target_count THEN 'SUCCESS' ELSE 'FAILURE' END AS validation_status"
    )
    return f"SELECT *, {label} FROM ({' UNION ALL '.join(parts)})"


_UNREADABLE = [
    ("dwh.gone", "ERROR: source query - no such table"),
    ("dwh.left", "ERROR: target missing/access - not there"),
]


def _note(name: str, text: str, column: str, day: bool) -> str:
    d = "NULL AS dpDay, " if day else ""
    return (
        f"SELECT '{name}' AS target_table_name, NULL AS dpYear, NULL AS dpMonth, {d}"
        f"NULL AS source_count, NULL AS target_count, {column} AS date_column_used, "
        f"'{text}' AS validation_status"
    )


# events lie before this date in none of the copies, so orders and lineitem have no rows since
RECENT = "2010-01-01"


@query(
    "recon_days_many_tables",
    " UNION ALL BY NAME ".join(
        [_period_rows(True, RECENT)]
        + [
            _note(f"dwh.{n}", f"not_data_found_since_{RECENT}", f"'{fx.DATE_COLUMNS[n]}'", True)
            for n in ("orders", "lineitem")
        ]
        + [
            _note(f"dwh.{n}", "SKIPPED: No Date Column", "NULL", True)
            for n in fx.TABLES
            if n not in fx.DATE_COLUMNS
        ]
        + [_note(n, text, "'o_orderdate'", True) for n, text in _UNREADABLE]
    ),
)
def recon_days_many_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.reconcile_days(spark, _pairs(spark, sf_dir), RECENT)


@query(
    "recon_months_many_tables",
    " UNION ALL BY NAME ".join(
        [f"SELECT * EXCLUDE (dpDay) FROM ({_period_rows(False, None)})"]
        + [
            f"SELECT 'dwh.{n}' AS target_table_name, NULL AS dpYear, NULL AS dpMonth, "
            "a.n AS source_count, b.n AS target_count, NULL AS date_column_used, "
            "CASE WHEN a.n = b.n THEN 'SUCCESS' ELSE 'FAILURE' END AS validation_status "
            f"FROM (SELECT count(*) AS n FROM {n}) a, "
            f"(SELECT count(*) AS n FROM ({fx.altered(n).sql()})) b"
            for n in fx.TABLES
            if n not in fx.DATE_COLUMNS
        ]
        + [_note(n, text, "'o_orderdate'", False) for n, text in _UNREADABLE]
    ),
)
def recon_months_many_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.reconcile_months(spark, _pairs(spark, sf_dir))


@query("recon_report_batches", ORACLES["recon_months_many_tables"])
def recon_report_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report appended to a table in batches of five tables, and read back."""
    name = f"recon_{uuid.uuid4().hex}"
    sink.ensure_schema(spark, name, location=scratch_path(spark, "tables"))
    pairs = _pairs(spark, sf_dir)
    write_report(pairs, lambda part: C.reconcile_months(spark, part), f"{name}.months", 5)
    return spark.table(f"{name}.months")


_SAFE = (
    "sha256(concat_ws('|', "
    + ", ".join(
        f"CASE WHEN {c} IS NULL THEN 'N' ELSE "
        f"concat(CAST(length(CAST({c} AS varchar)) AS varchar), ':', CAST({c} AS varchar)) END"
        for c in fx.ORDERS_SRC.columns
    )
    + "))"
)
_COMPAT = "sha256(concat_ws('{sep}', " + ", ".join(
    f"CAST({c} AS varchar)" for c in fx.ORDERS_SRC.columns
) + "))"


def _hash_sql(expression: str) -> str:
    return (
        fx.PAIR
        + f""",
s AS (SELECT {expression} AS h, count(*) AS n FROM orders_src GROUP BY 1),
t AS (SELECT {expression} AS h, count(*) AS n FROM orders_tgt GROUP BY 1),
j AS (SELECT s.n AS a, t.n AS b FROM s FULL JOIN t ON s.h = t.h)
SELECT count(a) AS source_hash_count, count(b) AS target_hash_count,
       count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS matched_hash_count,
       count(*) FILTER (b IS NULL) AS source_only, count(*) FILTER (a IS NULL) AS target_only,
       count(*) FILTER (a <> b) AS uneven_copies,
       CAST(sum(greatest(coalesce(a, 0) - coalesce(b, 0), 0)) AS bigint) AS rows_lost,
       CAST(sum(greatest(coalesce(b, 0) - coalesce(a, 0), 0)) AS bigint) AS rows_added,
       CASE WHEN count(a) = count(*) AND count(b) = count(*) THEN 'Match' ELSE 'Not Match' END
         AS validation_status,
       CASE WHEN count(*) FILTER (a IS NOT DISTINCT FROM b) = count(*) THEN 'Match'
            ELSE 'Not Match' END AS multiset_status
FROM j"""
    )


@query("recon_hash_safe", _hash_sql(_SAFE))
def recon_hash_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.compare_rows(*fx.orders_pair(spark, sf_dir), mode="safe")


@query("recon_hash_compat", _hash_sql(_COMPAT.format(sep="||")))
def recon_hash_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.compare_rows(*fx.orders_pair(spark, sf_dir), mode="compat")


@query("recon_rows_exact", _hash_sql(_SAFE))
def recon_rows_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same comparison grouped by the rows themselves."""
    return H.summarize(H.row_profile(*fx.orders_pair(spark, sf_dir)))


_DIFFERENCES = (
    fx.PAIR
    + f""",
s AS (SELECT {_SAFE} AS h, count(*) AS n FROM orders_src GROUP BY 1),
t AS (SELECT {_SAFE} AS h, count(*) AS n FROM orders_tgt GROUP BY 1)
SELECT coalesce(s.h, t.h) AS row_hash, coalesce(s.n, 0) AS source_count,
       coalesce(t.n, 0) AS target_count
FROM s FULL JOIN t ON s.h = t.h WHERE s.n IS DISTINCT FROM t.n"""
)


@query("recon_hash_differences", _DIFFERENCES)
def recon_hash_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.differing_rows(*fx.orders_pair(spark, sf_dir))


@query("recon_hash_differences_bucketed", _DIFFERENCES)
def recon_hash_differences_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only rows of buckets whose digests differ are shuffled."""
    return H.differing_rows(*fx.orders_pair(spark, sf_dir), buckets=65536)


def _hash_tables_sql() -> str:
    parts = []
    for n in fx.TABLES:
        a = f"SELECT x, count(*) AS n FROM {n} x GROUP BY x"
        b = f"SELECT x, count(*) AS n FROM ({fx.altered(n).sql()}) x GROUP BY x"
        parts.append(
            f"SELECT '{n}' AS table_name, a.n AS a, b.n AS b FROM ({a}) a FULL JOIN ({b}) b "
            "ON a.x = b.x"
        )
    return f"""SELECT table_name, count(a) AS source_hash_count, count(b) AS target_hash_count,
       count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS matched_hash_count,
       count(*) FILTER (b IS NULL) AS source_only, count(*) FILTER (a IS NULL) AS target_only,
       count(*) FILTER (a <> b) AS uneven_copies,
       CAST(sum(greatest(coalesce(a, 0) - coalesce(b, 0), 0)) AS bigint) AS rows_lost,
       CAST(sum(greatest(coalesce(b, 0) - coalesce(a, 0), 0)) AS bigint) AS rows_added,
       CASE WHEN count(a) = count(*) AND count(b) = count(*) THEN 'Match' ELSE 'Not Match' END
         AS validation_status,
       CASE WHEN count(*) FILTER (a IS NOT DISTINCT FROM b) = count(*) THEN 'Match'
            ELSE 'Not Match' END AS multiset_status,
       CAST(NULL AS varchar) AS error_message
FROM ({' UNION ALL '.join(parts)}) GROUP BY table_name"""


@query("recon_hash_many_tables", _hash_tables_sql())
def recon_hash_many_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.reconcile_hashes(
        [
            C.TablePair(n, fx.table(spark, sf_dir, n), fx.altered(n).frame(spark, sf_dir))
            for n in fx.TABLES
        ]
    )


_SYMDIFF = (
    fx.PAIR
    + """,
s AS (SELECT {h} AS h FROM orders_src{where}), t AS (SELECT {h} AS h FROM orders_tgt{where})
SELECT (SELECT count(*) FROM (SELECT h FROM s EXCEPT SELECT h FROM t))
     + (SELECT count(*) FROM (SELECT h FROM t EXCEPT SELECT h FROM s)) AS mismatched_rows"""
)
AS_OF = "2001-07-01 00:00:00"


@query("recon_symdiff", _SYMDIFF.format(h=_COMPAT.format(sep=","), where=""))
def recon_symdiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.symmetric_difference(*fx.orders_pair(spark, sf_dir))


@query(
    "recon_symdiff_last_days",
    _SYMDIFF.format(
        h=_COMPAT.format(sep=","),
        where=f" WHERE o_orderdate BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY"
        f" AND TIMESTAMP '{AS_OF}'",
    ),
)
def recon_symdiff_last_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = fx.orders_pair(spark, sf_dir)
    return H.symmetric_difference(
        dates.last_days(source, "o_orderdate", AS_OF), dates.last_days(target, "o_orderdate", AS_OF)
    )


def _range_row(name: str, c: str, source: str, target: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, '{c}' AS date_column, "
        f"(SELECT min({c}) FROM ({source})) AS source_min_date, "
        f"(SELECT max({c}) FROM ({source})) AS source_max_date, "
        f"(SELECT min({c}) FROM ({target})) AS target_min_date, "
        f"(SELECT max({c}) FROM ({target})) AS target_max_date"
    )


_RANGES = " UNION ALL ".join(
    [_range_row("orders", "o_orderdate", fx.ORDERS_SRC.sql(), fx.ORDERS_TGT.sql())]
    + [
        _range_row(n, fx.DATE_COLUMNS[n], f"SELECT * FROM {n}", fx.altered(n).sql())
        for n in ("lineitem", "events")
    ]
)


@query(
    "recon_date_range",
    "SELECT *, source_min_date IS NOT DISTINCT FROM target_min_date AND "
    f"source_max_date IS NOT DISTINCT FROM target_max_date AS is_matching FROM ({_RANGES})",
)
def recon_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = [C.TablePair("orders", *fx.orders_pair(spark, sf_dir))] + [
        C.TablePair(n, fx.table(spark, sf_dir, n), fx.altered(n).frame(spark, sf_dir))
        for n in ("lineitem", "events")
    ]
    columns = {p.table_name: dates.date_fields(p.source) for p in pairs}
    return C.date_ranges(pairs, columns)


@query(
    "count_status",
    fx.ctes(t=fx.altered("lineitem"))
    + """
SELECT a.l_suppkey, a.n AS source_count, b.n AS target_count,
       CASE WHEN a.n = b.n THEN 'VALIDATION_SUCCESS' ELSE 'VALIDATION_FAILED' END AS status
FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) a
JOIN (SELECT l_suppkey, count(*) AS n FROM t GROUP BY 1) b USING (l_suppkey)""",
)
def count_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post-load check of two counts, for every supplier that both copies have."""
    counts = C.side_counts(
        fx.table(spark, sf_dir, "lineitem").select("l_suppkey"),
        fx.altered("lineitem").frame(spark, sf_dir).select("l_suppkey"),
    ).filter("source_count > 0 AND target_count > 0")
    label = status.equal_label(
        F.col("source_count"),
        F.col("target_count"),
        status.VALIDATION_SUCCESS,
        status.VALIDATION_FAILED,
    )
    return counts.withColumn("status", label)


_TREE_COLUMNS = ", ".join(fx.ORDERS_SRC.columns)


@query(
    "recon_digest_tree",
    fx.ctes(s=fx.ORDERS_SRC, t=fx.ORDERS_TGT)
    + f""", u AS (SELECT *, 1 AS a, 0 AS b FROM s UNION ALL SELECT *, 0, 1 FROM t),
g AS (SELECT {_TREE_COLUMNS}, sum(a) AS a, sum(b) AS b FROM u GROUP BY ALL HAVING sum(a) <> sum(b))
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS differing_rows,
       sum(greatest(a - b, 0))::BIGINT AS rows_lost, sum(greatest(b - a, 0))::BIGINT AS rows_added
FROM g GROUP BY 1""",
)
def recon_digest_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest trees kept beside two copies of a table, compared day by day and bucket by bucket."""
    paths = []
    for df in fx.orders_pair(spark, sf_dir):
        paths.append(scratch_path(spark, "digest-tree"))
        digest_tree.write_tree(df, paths[-1], "o_orderdate", buckets=64)
    return digest_tree.changed_days(digest_tree.compare_trees(spark, *paths))
