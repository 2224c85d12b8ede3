"""Script lineage, the gate, and per-script roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.functions import status
from reconlake.functions.text import BLANK, SOURCE_KEYWORDS, STRIPPED, TARGET_KEYWORDS, WORD
from reconlake.operators import counts as C
from reconlake.operators import levels as order
from reconlake.operators import lineage as L
from reconlake.operators import rollups
from reconlake.plans import gate
from reconlake.queries import fixtures as fx
from reconlake.queries import query

_SCRIPTS = fx.ctes(scripts=fx.SCRIPTS, jobs=fx.JOBS)


def _names_sql(keywords: str, exists: bool = False) -> str:
    """Distinct sorted names: whole matches, then the last blank-separated word of each."""
    opt = f"(?:IF{BLANK}+(?:NOT{BLANK}+)?EXISTS{BLANK}+)?" if exists else ""
    find = f"(?i)(?:{keywords}){BLANK}+{opt}({WORD}+\\.{WORD}+)"
    return f"list_sort(list_distinct(regexp_extract_all(text, '{find}', 1)))"


def _lineage_sql(relation: str, exists: bool = False) -> str:
    return (
        f"SELECT file_path, {_names_sql(SOURCE_KEYWORDS, exists)} AS s, "
        f"{_names_sql(TARGET_KEYWORDS, exists)} AS t FROM {relation}"
    )


_JOINED = (
    "SELECT file_path, array_to_string(s, ',') AS source_table_names, "
    "array_to_string(t, ',') AS target_table_names FROM"
)


def _joined(lineage: DataFrame) -> DataFrame:
    return lineage.select(
        "file_path",
        F.concat_ws(",", "source_table_names").alias("source_table_names"),
        F.concat_ws(",", "target_table_names").alias("target_table_names"),
    )


@query("script_lineage", f"{_SCRIPTS} {_JOINED} ({_lineage_sql('scripts')})")
def script_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(L.script_lineage(fx.SCRIPTS.frame(spark, sf_dir)))


@query("script_lineage_exists", f"{_SCRIPTS} {_JOINED} ({_lineage_sql('scripts', True)})")
def script_lineage_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with IF [NOT] EXISTS allowed before the name."""
    return _joined(L.script_lineage(fx.SCRIPTS.frame(spark, sf_dir), allow_exists=True))


@query(
    "script_corpus_tables",
    f"""{_SCRIPTS}, l AS ({_lineage_sql('scripts')})
SELECT DISTINCT 'source' AS role, unnest(s) AS table_name FROM l UNION ALL
SELECT DISTINCT 'target', unnest(t) FROM l""",
)
def script_corpus_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.corpus_tables(L.script_lineage(fx.SCRIPTS.frame(spark, sf_dir)))


@query(
    "script_table_columns",
    f"""{fx.ctes(scripts=fx.SCRIPTS, sheet=fx.SCRIPT_TABLES)},
l AS (SELECT file_path, unnest(s) AS n FROM ({_lineage_sql('scripts')})),
c AS (SELECT schema_name, table_name, count(*) AS columns FROM sheet GROUP BY ALL)
SELECT file_path, split_part(n, '.', 1) AS schema_name, split_part(n, '.', 2) AS table_name,
       columns
FROM l LEFT JOIN c ON c.schema_name || '.' || c.table_name = n""",
)
def script_table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Script tables with the sheet's entry; tables that the sheet lacks stay, with NULL."""
    tables = L.script_tables(L.script_lineage(fx.SCRIPTS.frame(spark, sf_dir)))
    sheet = (
        fx.SCRIPT_TABLES.frame(spark, sf_dir)
        .groupBy("schema_name", "table_name")
        .agg(F.count(F.lit(1)).alias("columns"))
    )
    return L.with_columns(tables, sheet).select("file_path", "schema_name", "table_name", "columns")


_CHARS = " || ".join(f"chr({ord(c)})" for c in STRIPPED)


@query(
    "script_statements",
    f"""{_SCRIPTS}, cut AS (SELECT file_path, list_filter(list_transform(
  string_split(text, ';'), lambda x: trim(x, {_CHARS})), lambda x: x <> '') AS q FROM scripts)
SELECT file_path, string_split(file_path, '/')[-1] AS file_name, unnest(q) AS query,
       CAST(generate_subscripts(q, 1) - 1 AS int) AS position FROM cut""",
)
def script_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.statements(fx.SCRIPTS.frame(spark, sf_dir))


@query(
    "script_status",
    """WITH r AS (SELECT 'jobs/' || user_id || '.sql' AS file_path,
  CASE WHEN event_type = 'error' AND value > 30 THEN 'Failed' ELSE 'Success' END AS status
  FROM events)
SELECT file_path, string_agg(DISTINCT status, ',' ORDER BY status) AS statuses,
       CASE WHEN bool_or(status = 'Failed') THEN 'Failed' ELSE 'Success' END AS execution_status
FROM r GROUP BY file_path""",
)
def script_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event stands for one statement that was run."""
    results = fx.table(spark, sf_dir, "events").select(
        F.concat(F.lit("jobs/"), F.col("user_id").cast("string"), F.lit(".sql")).alias("file_path"),
        F.when((F.col("event_type") == "error") & (F.col("value") > 30), "Failed")
        .otherwise("Success")
        .alias("status"),
    )
    out = L.execution_status(results)
    return out.withColumn("statuses", F.concat_ws(",", "statuses"))


_VERDICTS = f"""
a AS (SELECT table_name, CAST(d AS date) AS d, count(*) AS n FROM o_src
      WHERE d >= DATE '{fx.JOBS_SINCE}' GROUP BY ALL),
b AS (SELECT table_name, CAST(d AS date) AS d, count(*) AS n FROM o_tgt
      WHERE d >= DATE '{fx.JOBS_SINCE}' GROUP BY ALL),
days AS (SELECT coalesce(a.table_name, b.table_name) AS table_name, count(a.n) AS sd,
                count(b.n) AS td, count(*) FILTER (a.n > 0 AND b.n > 0) AS cd,
                count(*) FILTER (a.n IS DISTINCT FROM b.n) AS bad
         FROM a FULL JOIN b ON a.table_name = b.table_name AND a.d = b.d GROUP BY 1),
x AS (SELECT table_name, count(*) AS n FROM c_src GROUP BY 1),
y AS (SELECT table_name, count(*) AS n FROM c_tgt GROUP BY 1),
v AS (SELECT table_name, true AS dated, sd, td, cd, bad FROM days UNION ALL
      SELECT coalesce(x.table_name, y.table_name), false, 0, 0, 0,
             CASE WHEN x.n IS NOT DISTINCT FROM y.n THEN 0 ELSE 1 END
      FROM x FULL JOIN y ON x.table_name = y.table_name),
l AS (SELECT file_path, unnest(s) AS table_name FROM ({_lineage_sql('jobs')}))"""
_GATE = (
    fx.ctes(
        jobs=fx.JOBS,
        o_src=fx.JOB_ORDERS_SRC,
        o_tgt=fx.JOB_ORDERS_TGT,
        c_src=fx.JOB_CUSTOMERS_SRC,
        c_tgt=fx.JOB_CUSTOMERS_TGT,
    )
    + ","
    + _VERDICTS
)


def _job_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every table the jobs read: order tables by day, customer tables in total."""
    days = C.day_counts(
        fx.JOB_ORDERS_SRC.frame(spark, sf_dir),
        fx.JOB_ORDERS_TGT.frame(spark, sf_dir),
        "d",
        fx.JOBS_SINCE,
        by=["table_name"],
    )
    totals = C.side_counts(
        fx.JOB_CUSTOMERS_SRC.frame(spark, sf_dir), fx.JOB_CUSTOMERS_TGT.frame(spark, sf_dir)
    )
    return gate.day_verdicts(days).unionByName(gate.total_verdicts(totals))


def _gate_sql(no_date_rule: str) -> str:
    return (
        _GATE
        + f""",
g AS (SELECT j.file_path, count(l.table_name) AS total_tables,
             count(*) FILTER (l.table_name IS NOT NULL AND v.dated IS NULL) AS unknown,
             count(*) FILTER (v.dated) AS dated_tables, coalesce(sum(sd), 0) AS sd,
             coalesce(sum(td), 0) AS td, coalesce(sum(cd), 0) AS cd, coalesce(sum(bad), 0) AS bad
      FROM jobs j LEFT JOIN l ON l.file_path = j.file_path LEFT JOIN v ON v.table_name = l.table_name
      GROUP BY 1),
r AS (SELECT file_path, total_tables, dated_tables,
  CASE WHEN total_tables = 0 THEN 'no source table in script'
       WHEN unknown > 0 THEN 'table not found' {no_date_rule}
       WHEN dated_tables > 0 AND sd = 0 THEN 'no source data since {fx.JOBS_SINCE}'
       WHEN dated_tables > 0 AND td = 0 THEN 'no target data since {fx.JOBS_SINCE}'
       WHEN dated_tables > 0 AND cd = 0 THEN 'no common day in source and target'
       WHEN bad > 0 THEN 'counts differ' ELSE 'ready' END AS reason FROM g)
SELECT *, reason = 'ready' AS ready FROM r"""
    )


@query("gate_decisions", _gate_sql(""))
def gate_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineage = L.script_lineage(fx.JOBS.frame(spark, sf_dir))
    return gate.decide(lineage, _job_verdicts(spark, sf_dir), fx.JOBS_SINCE)


@query("gate_dates_required", _gate_sql("WHEN dated_tables = 0 THEN 'no date column'"))
def gate_dates_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scripts that read dateless tables only are rejected."""
    lineage = L.script_lineage(fx.JOBS.frame(spark, sf_dir))
    return gate.decide(lineage, _job_verdicts(spark, sf_dir), fx.JOBS_SINCE, True)


def _script_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineage = L.script_lineage(fx.JOBS.frame(spark, sf_dir))
    used = lineage.select(
        F.col("file_path").alias("sql_file"), F.explode("source_table_names").alias("table_name")
    )
    same = (F.col("bad_days") + F.col("bad_totals")) == 0
    return used.join(_job_verdicts(spark, sf_dir), "table_name", "left").withColumn(
        "validation_status", F.when(same, status.MATCH).otherwise(status.NOT_MATCH)
    )


_RESULTS = (
    _GATE
    + """,
r AS (SELECT l.file_path AS sql_file, l.table_name, coalesce(v.bad = 0, false) AS ok
      FROM l LEFT JOIN v ON v.table_name = l.table_name)"""
)


@query(
    "recon_rollup",
    _RESULTS
    + """
SELECT sql_file, bool_and(ok) AS all_passed, count(*) FILTER (ok) AS pass_count,
       count(*) FILTER (NOT ok) AS fail_count, count(*) AS total_tables FROM r GROUP BY 1""",
)
def recon_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _script_results(spark, sf_dir)
    return rollups.script_summary(results, F.col("validation_status") == status.MATCH)


@query(
    "recon_script_verdict",
    _RESULTS
    + """
SELECT sql_file, count(*) AS total_count, count(*) FILTER (NOT ok) AS not_match_count,
       CASE WHEN bool_and(ok) THEN 'Pass' ELSE 'Fail' END AS file_status FROM r GROUP BY 1""",
)
def recon_script_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.script_verdict(_script_results(spark, sf_dir))


_TARGETS = (
    fx.ctes(jobs=fx.JOBS, m_src=fx.JOB_MART_SRC, m_tgt=fx.JOB_MART_TGT)
    + f""",
l AS (SELECT file_path, unnest(t) AS n FROM ({_lineage_sql('jobs')})),
x AS (SELECT table_name, count(*) AS n FROM m_src GROUP BY 1),
y AS (SELECT table_name, count(*) AS n FROM m_tgt GROUP BY 1),
r AS (SELECT file_path AS sql_file, split_part(l.n, '.', 1) AS schema_name,
             split_part(l.n, '.', 2) AS table_name, x.n AS source_count, y.n AS target_count,
             coalesce(x.n = y.n, false) AS ok
      FROM l LEFT JOIN x ON x.table_name = l.n LEFT JOIN y ON y.table_name = l.n),
f AS (SELECT sql_file, CASE WHEN bool_and(ok) THEN 'Passed' ELSE 'Failed' END AS status
      FROM r GROUP BY 1)"""
)


def _target_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = L.script_tables(L.script_lineage(fx.JOBS.frame(spark, sf_dir)), "target")
    counts = C.side_counts(
        fx.JOB_MART_SRC.frame(spark, sf_dir), fx.JOB_MART_TGT.frame(spark, sf_dir)
    ).withColumnsRenamed({"table_name": "full_name"})
    name = F.concat_ws(".", "schema_name", "table_name")
    known = counts.withColumns(
        {c: F.nullif(F.col(c), F.lit(0)) for c in ("source_count", "target_count")}
    )
    joined = used.join(known, name == F.col("full_name"), "left")
    return rollups.count_check(
        joined.drop("full_name").withColumnRenamed("file_path", "sql_file"), "Target"
    )


@query(
    "target_check",
    _TARGETS
    + """
SELECT sql_file, schema_name, table_name, source_count, target_count,
       CASE WHEN ok THEN 'Target count match' ELSE 'Not Validated' END AS validation_status,
       CASE WHEN ok THEN 'Passed' ELSE 'Failed' END AS execution_status FROM r""",
)
def target_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _target_results(spark, sf_dir)


@query("target_summary", _TARGETS + "SELECT * FROM f")
def target_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.target_summary(_target_results(spark, sf_dir))


@query(
    "target_totals",
    _TARGETS
    + """SELECT count(*) FILTER (status = 'Passed') AS passed_files,
       count(*) FILTER (status = 'Failed') AS failed_files FROM f""",
)
def target_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.pass_fail_totals(rollups.target_summary(_target_results(spark, sf_dir)))


def _written_by(offset: str) -> str:
    return f"'w.t' || ({offset})"


# A script per customer. Of each eight in a row: a chain, a diamond, a cycle of two, one behind it, and one
# that reads what it writes.
_CHAINED = fx.Derived(
    "customer",
    {
        "file_path": "'jobs/' || c_custkey || '.sql'",
        "text": f"'INSERT INTO ' || {_written_by('c_custkey')} || ' SELECT * FROM ' || CASE c_custkey % 8 "
        "WHEN 0 THEN 'base.sales' "
        f"WHEN 1 THEN {_written_by('c_custkey - 1')} WHEN 2 THEN {_written_by('c_custkey - 2')} "
        f"WHEN 3 THEN {_written_by('c_custkey - 2')} || ' JOIN ' || {_written_by('c_custkey - 1')} "
        f"WHEN 4 THEN {_written_by('c_custkey + 1')} WHEN 5 THEN {_written_by('c_custkey - 1')} "
        f"WHEN 6 THEN {_written_by('c_custkey - 1')} ELSE {_written_by('c_custkey')} END",
    },
)


@query(
    "gate_run_levels",
    f"""WITH RECURSIVE scripts AS ({_CHAINED.sql()}), l AS ({_lineage_sql('scripts')}),
r AS (SELECT file_path, unnest(s) AS n FROM l), w AS (SELECT file_path, unnest(t) AS n FROM l),
edges AS (SELECT DISTINCT w.file_path AS a, r.file_path AS b FROM w JOIN r USING (n)
          WHERE w.file_path <> r.file_path),
reach AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
cyclic AS (SELECT DISTINCT a AS file_path FROM reach WHERE a = b),
behind AS (SELECT DISTINCT b AS file_path FROM reach WHERE a IN (SELECT file_path FROM cyclic)
           AND b NOT IN (SELECT file_path FROM cyclic)),
fine AS (SELECT file_path FROM scripts WHERE file_path NOT IN (SELECT file_path FROM cyclic)
         AND file_path NOT IN (SELECT file_path FROM behind)),
paths AS (SELECT file_path, 0 AS n FROM fine UNION
          SELECT edges.b, paths.n + 1 FROM paths JOIN edges ON edges.a = paths.file_path
          WHERE edges.b IN (SELECT file_path FROM fine))
SELECT file_path, CAST(max(n) AS int) AS level, 'ordered' AS state FROM paths GROUP BY file_path
UNION ALL SELECT file_path, NULL, 'cycle' FROM cyclic
UNION ALL SELECT file_path, NULL, 'behind a cycle' FROM behind""",
)
def gate_run_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In which order scripts can run that read what others write."""
    return order.run_levels(L.script_lineage(_CHAINED.frame(spark, sf_dir)))
