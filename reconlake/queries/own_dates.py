"""Date columns found on each side, and targets compared day by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.operators import lineage as L
from reconlake.operators.own_dates import reconcile_own_days
from reconlake.plans import gate
from reconlake.queries import fixtures as fx
from reconlake.queries import query
from reconlake.sources.catalog import open_pairs

SINCE = "1995-01-01"
_DAY = "CAST(o_orderdate AS date)"
_PAID = "CAST(o_orderdate + INTERVAL 2 DAY AS date)"
_UNDATED = f"CASE WHEN o_orderkey % 7 = 0 THEN CAST(NULL AS date) ELSE {_DAY} END"
_EARLY = "CAST(o_orderdate - INTERVAL 100 YEAR AS date)"


def _orders(where: str | None = None, **columns: str) -> fx.Derived:
    return fx.Derived("orders", {"k": "o_orderkey", **columns}, where)


# Table, source, target, and the date column that each side is counted by.
_TABLES = {
    "s.same": (_orders(created=_DAY, paid=_PAID), _orders(created=_DAY, paid=_PAID), "created", "created"),
    "s.lost": (_orders(created=_DAY), _orders("o_orderkey % 97 <> 0", created=_DAY), "created", "created"),
    "s.moved": (_orders(created=_DAY, paid=_PAID), _orders(paid=_PAID, created=_DAY), "created", "paid"),
    "s.renamed": (_orders(created=_DAY), _orders(opened=_DAY), "created", "opened"),
    "s.undated": (_orders(created=_UNDATED), _orders(created=_UNDATED), "created", "created"),
    "s.late": (_orders(created=_DAY), _orders(created=_EARLY), "created", "created"),
    "s.early": (_orders(created=_EARLY), _orders(created=_EARLY), "created", "created"),
    "s.one": (_orders(created=_DAY), _orders(), "created", None),
    "s.plain": (fx.Derived("customer"), fx.Derived("customer"), None, None),
    "s.gone": (_orders(created=_DAY), None, "created", None),
}


def _readers(spark: SparkSession, sf_dir: str):
    def reader(side: int):
        def read(name: str) -> DataFrame:
            derived = _TABLES[name][side]
            return spark.table(f"missing.{name[2:]}") if derived is None else derived.frame(spark, sf_dir)

        return read

    return reader(0), reader(1)


def _counted(name: str, side: int, column: str | None) -> str:
    if column is None:
        return "SELECT CAST(NULL AS date) AS d, CAST(NULL AS bigint) AS n WHERE false"
    table = _TABLES[name][side].sql()
    return f"SELECT {column} AS d, count(*) AS n FROM ({table}) WHERE {column} >= DATE '{SINCE}' GROUP BY 1"


def _note(name: str, side: int, rows: str) -> str:
    if _TABLES[name][side] is None:
        return "'ERROR: missing/access'"
    if _TABLES[name][2 + side] is None:
        return "'SKIPPED: No Date Column'"
    return f"CASE WHEN EXISTS (SELECT 1 FROM {rows}) THEN 'SUCCESS' ELSE 'no_data_since_{SINCE}' END"


def _name(column: str | None) -> str:
    return f"'{column}'" if column else "CAST(NULL AS varchar)"


def _table_sql(name: str) -> str:
    _, _, ours, theirs = _TABLES[name]
    label = "Success" if ours == theirs else "Failure"
    return f"""SELECT * FROM (WITH a AS ({_counted(name, 0, ours)}), b AS ({_counted(name, 1, theirs)}),
c AS (SELECT coalesce(a.d, b.d) AS d, a.n AS an, b.n AS bn FROM a FULL JOIN b ON a.d = b.d)
SELECT '{name}' AS table_name, CAST(year(d) AS int) AS dpYear, CAST(month(d) AS int) AS dpMonth,
  CAST(day(d) AS int) AS dpDay, an AS source_count, bn AS target_count,
  CASE WHEN an IS NULL OR bn IS NULL THEN 'Not Applicable' WHEN an = bn THEN 'Success' ELSE 'Failure' END
    AS validation_status,
  {_name(ours)} AS source_date_column, {_name(theirs)} AS target_date_column, '{label}' AS date_column_validation,
  {_note(name, 0, "a")} AS source_fetch, {_note(name, 1, "b")} AS target_fetch
FROM (SELECT 1) LEFT JOIN c ON true)"""


_DAYS = " UNION ALL ".join(map(_table_sql, _TABLES))


@query("recon_own_days", _DAYS)
def recon_own_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted: lost rows, other or renamed date columns, NULL dates, no rows since the start, missing sides."""
    days = reconcile_own_days(spark, open_pairs(_TABLES, *_readers(spark, sf_dir)), SINCE)
    # the engine's own message is left out
    return days.withColumn("target_fetch", F.regexp_replace("target_fetch", "(?s) - .*", ""))


_TURN = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_TABLES))
_WRITERS = fx.Derived(
    "documents",
    {
        "file_path": "concat('job_', CAST(doc_id AS string), '.sql')",
        "text": f"concat('INSERT INTO ', CASE doc_id % {len(_TABLES)} {_TURN} END, ' SELECT 1')",
    },
)


@query(
    "target_days_check",
    f"""WITH w AS ({_WRITERS.sql()}), days AS ({_DAYS}),
t AS (SELECT table_name, CAST(sum(source_count) AS bigint) AS s, CAST(sum(target_count) AS bigint) AS t,
  count(dpDay) AS days, count(dpDay) FILTER (source_count IS DISTINCT FROM target_count) AS bad,
  source_date_column IS NOT DISTINCT FROM target_date_column AS one_column
FROM days GROUP BY table_name, source_date_column, target_date_column)
SELECT file_path AS sql_file, 's' AS schema_name, substr(table_name, 3) AS table_name, s AS source_count,
  t AS target_count, days, bad AS differing_days,
  CASE WHEN days > 0 AND bad = 0 AND one_column THEN 'Target days match' ELSE 'Not Validated' END AS validation_status,
  CASE WHEN days > 0 AND bad = 0 AND one_column THEN 'Passed' ELSE 'Failed' END AS execution_status
FROM w JOIN t ON w.text LIKE 'INSERT INTO ' || t.table_name || ' %'""",
)
def target_days_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineage = L.script_lineage(_WRITERS.frame(spark, sf_dir))
    return gate.check_target_days(spark, lineage, *_readers(spark, sf_dir), SINCE)
