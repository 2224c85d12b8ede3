"""Date columns and schema checks over column sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.functions import dates
from reconlake.operators import alignment
from reconlake.operators import discovery as D
from reconlake.operators import schema_guard as G
from reconlake.queries import fixtures as fx
from reconlake.queries import query
from reconlake.session import scratch_path
from reconlake.sources import files

_IS_DATE = (
    "(data_type IN ('date', 'timestamp', 'timestamp_ntz') OR "
    "column_name IN ('date', 'created', 'updated', 'createdAt', 'updatedAt'))"
)
_SHEET = fx.ctes(sheet=fx.SHEET)
_LISTED = (
    "SELECT schema_name, table_name, list(column_name ORDER BY ordinal_position, column_name) "
    f"AS date_columns FROM sheet WHERE {_IS_DATE} GROUP BY ALL"
)


def _sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.SHEET.frame(spark, sf_dir)


@query(
    "date_columns",
    f"{_SHEET} SELECT schema_name, table_name, array_to_string(date_columns, ',') AS date_columns "
    f"FROM ({_LISTED})",
)
def date_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = D.tables_with_dates(_sheet(spark, sf_dir))
    return listed.withColumn("date_columns", F.concat_ws(",", "date_columns"))


@query(
    "no_date_columns",
    f"{_SHEET} SELECT DISTINCT schema_name, table_name FROM sheet ANTI JOIN "
    f"(SELECT * FROM sheet WHERE {_IS_DATE}) d USING (schema_name, table_name)",
)
def no_date_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.tables_without_dates(_sheet(spark, sf_dir))


@query(
    "no_date_columns_by_type_text",
    f"{_SHEET} SELECT DISTINCT schema_name, table_name FROM sheet ANTI JOIN "
    "(SELECT * FROM sheet WHERE lower(data_type) LIKE '%date%') d USING (schema_name, table_name)",
)
def no_date_columns_by_type_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.tables_without_dates(_sheet(spark, sf_dir), dates.mentions_date(F.col("data_type")))


@query(
    "first_date_column",
    f"""{_SHEET} SELECT schema_name, table_name, column_name AS date_column FROM sheet
WHERE data_type IN ('date', 'timestamp', 'timestamptz')
QUALIFY row_number() OVER (PARTITION BY schema_name, table_name
                           ORDER BY ordinal_position, column_name) = 1""",
)
def first_date_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.first_date_column(_sheet(spark, sf_dir))


@query(
    "listed_date_column",
    f"{_SHEET} SELECT schema_name, table_name, date_columns[1] AS date_column FROM ({_LISTED})",
)
def listed_date_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of date columns goes through a CSV control sheet as JSON text and comes back."""
    listed = D.tables_with_dates(_sheet(spark, sf_dir))
    path = scratch_path(spark, "sheet")
    listed.withColumn("date_columns", F.to_json("date_columns")).write.option("escape", '"').csv(
        path, header=True
    )
    back = files.control_sheet(spark, path, files.DATE_COLUMN_LIST)
    return D.listed_date_column(back).drop("date_columns")


@query(
    "typed_columns",
    f"""{fx.ctes(sheet=fx.SHEET, wanted=fx.WANTED)}
SELECT * FROM sheet WHERE data_type IN ('date', 'timestamp') AND EXISTS (SELECT 1 FROM wanted w
WHERE lower(w.schema_name) = lower(sheet.schema_name)
  AND lower(w.table_name) = lower(sheet.table_name))""",
)
def typed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.typed_columns(_sheet(spark, sf_dir), fx.WANTED.frame(spark, sf_dir))


_BOTH = fx.ctes(sheet=fx.SHEET, other=fx.OTHER_SHEET) + """,
a AS (SELECT schema_name, table_name, ordinal_position, max(lower(column_name)) AS c,
             max(lower(data_type)) AS t FROM sheet GROUP BY ALL),
b AS (SELECT schema_name, table_name, ordinal_position, max(lower(column_name)) AS c,
             max(lower(data_type)) AS t FROM other GROUP BY ALL),
diff AS (SELECT schema_name, table_name, ordinal_position, a.c AS source_column,
                a.t AS source_type, b.c AS target_column, b.t AS target_type
         FROM a FULL JOIN b USING (schema_name, table_name, ordinal_position)
         WHERE a.c IS DISTINCT FROM b.c OR a.t IS DISTINCT FROM b.t)
"""


@query("schema_diff", _BOTH + "SELECT * FROM diff")
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.schema_differences(_sheet(spark, sf_dir), fx.OTHER_SHEET.frame(spark, sf_dir))


@query(
    "schema_verdict",
    _BOTH
    + """,
x AS (SELECT schema_name, table_name, count(*) AS n FROM sheet GROUP BY ALL),
y AS (SELECT schema_name, table_name, count(*) AS n FROM other GROUP BY ALL),
d AS (SELECT schema_name, table_name, count(*) AS n FROM diff GROUP BY ALL)
SELECT schema_name, table_name, coalesce(x.n, 0) AS source_columns,
       coalesce(y.n, 0) AS target_columns, coalesce(d.n, 0) AS mismatches,
       CASE WHEN coalesce(x.n, 0) <> coalesce(y.n, 0) THEN 'Column count mismatch'
            WHEN coalesce(d.n, 0) > 0 THEN 'Schema mismatch' ELSE 'Match' END AS verdict
FROM x FULL JOIN y USING (schema_name, table_name) LEFT JOIN d USING (schema_name, table_name)""",
)
def schema_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.schema_verdicts(_sheet(spark, sf_dir), fx.OTHER_SHEET.frame(spark, sf_dir))


# A table per user with a column per event; the other copy lost, moved, renamed, retyped and got columns.
_WIDE = {
    "schema_name": "'s'",
    "table_name": "'t_' || user_id",
    "column_name": "'c_' || event_id",
    "data_type": "event_type",
    "ordinal_position": "CAST(4 * event_id AS int)",
}
_WIDE_SHEET = fx.Derived("events", _WIDE)
_OTHER_WIDE = fx.Stacked(
    (
        fx.Derived(
            "events",
            {
                **_WIDE,
                "column_name": "CASE WHEN event_id % 13 = 5 THEN 'D_' ELSE 'C_' END || event_id",
                "data_type": "CASE WHEN event_id % 7 = 1 THEN 'text' ELSE event_type END",
                "ordinal_position": "CAST(CASE WHEN event_id % 11 = 0 THEN 4 * event_id + 3001 ELSE 4 * event_id END AS int)",
            },
            "event_id % 17 <> 3",
        ),
        fx.Derived(
            "events",
            {**_WIDE, "column_name": "'new_' || event_id", "ordinal_position": "CAST(4 * event_id + 2 AS int)"},
            "event_id % 19 = 4",
        ),
    )
)
_ALIGNED = f"""WITH RECURSIVE a AS (SELECT table_name AS tn, lower(column_name) AS c, data_type AS ty,
  ordinal_position AS p FROM ({_WIDE_SHEET.sql()})),
b AS (SELECT table_name AS tn, lower(column_name) AS c, data_type AS ty, ordinal_position AS p
  FROM ({_OTHER_WIDE.sql()})),
m AS (SELECT tn, c, a.p AS s, b.p AS t, a.ty AS sty, b.ty AS tty FROM a JOIN b USING (tn, c)),
-- lengths of the rising runs that start with a pair, and of those the longest
runs AS (SELECT tn, s, t, 1 AS n FROM m UNION
  SELECT m.tn, m.s, m.t, r.n + 1 FROM runs r JOIN m ON m.tn = r.tn AND m.s < r.s AND m.t < r.t),
best AS (SELECT tn, s, t, max(n) AS n FROM runs GROUP BY ALL),
-- the first pair that leads to the longest run, then the first behind it that still does
chain AS (SELECT tn, arg_min(t, s) AS t, min(s) AS s, any_value(n) AS n FROM best
    WHERE (tn, n) IN (SELECT tn, max(n) FROM best GROUP BY tn) GROUP BY tn
  UNION ALL
  SELECT tn, t, s, n FROM (SELECT q.tn, q.t, q.s, q.n,
      row_number() OVER (PARTITION BY q.tn ORDER BY q.s) AS k
    FROM chain JOIN best q ON q.tn = chain.tn AND q.n = chain.n - 1 AND q.s > chain.s AND q.t > chain.t)
  WHERE k = 1),
x AS (SELECT a.*, (SELECT count(*) FROM chain WHERE chain.tn = a.tn AND chain.s < a.p) AS gap
  FROM a WHERE (tn, c) NOT IN (SELECT tn, c FROM m)),
y AS (SELECT b.*, (SELECT count(*) FROM chain WHERE chain.tn = b.tn AND chain.t < b.p) AS gap
  FROM b WHERE (tn, c) NOT IN (SELECT tn, c FROM m)),
xk AS (SELECT *, row_number() OVER (PARTITION BY tn, gap, ty ORDER BY p) AS k FROM x),
yk AS (SELECT *, row_number() OVER (PARTITION BY tn, gap, ty ORDER BY p) AS k FROM y)
SELECT 's' AS schema_name, m.tn AS table_name, m.s AS source_position, m.c AS source_column,
  m.sty AS source_type, m.t AS target_position, m.c AS target_column, m.tty AS target_type,
  CASE WHEN chain.s IS NULL THEN 'moved' WHEN m.sty = m.tty THEN 'same' ELSE 'retyped' END AS change
FROM m LEFT JOIN chain ON chain.tn = m.tn AND chain.s = m.s
UNION ALL SELECT 's', coalesce(xk.tn, yk.tn), xk.p, xk.c, xk.ty, yk.p, yk.c, yk.ty,
  CASE WHEN xk.p IS NULL THEN 'inserted' WHEN yk.p IS NULL THEN 'dropped' ELSE 'renamed' END
FROM xk FULL JOIN yk ON xk.tn = yk.tn AND xk.gap = yk.gap AND xk.ty = yk.ty AND xk.k = yk.k"""


@query("schema_alignment", _ALIGNED)
def schema_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What happened to each column of many tables, all aligned in one plan."""
    return alignment.align_schemas(_WIDE_SHEET.frame(spark, sf_dir), _OTHER_WIDE.frame(spark, sf_dir))
