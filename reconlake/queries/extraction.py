"""Chunk plans and chunked exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.operators import chunks
from reconlake.plans import exports
from reconlake.queries import fixtures as fx
from reconlake.queries import query
from reconlake.session import scratch_path

ROWS = 10_000
DAYS = 7
_ORDER = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_shipdate"
)

_SIZES = f"""SELECT i AS chunk_id, i * {ROWS} AS "offset", least({ROWS}, n - i * {ROWS}) AS rows
FROM (SELECT count(*) AS n FROM lineitem), LATERAL
     (SELECT unnest(range(0, (n + {ROWS} - 1) // {ROWS})) AS i)"""


@query("chunk_offset_plan", _SIZES)
def chunk_offset_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.offset_plan(spark, fx.table(spark, sf_dir, "lineitem").count(), ROWS)


@query(
    "chunk_offset_manifest",
    f"""SELECT chunk_id, count(*) AS rows, min(l_orderkey) AS min_key, max(l_orderkey) AS max_key
FROM (SELECT l_orderkey, (row_number() OVER (ORDER BY {_ORDER}) - 1) // {ROWS} AS chunk_id
      FROM lineitem) GROUP BY chunk_id""",
)
def chunk_offset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export in key order, then the key range of each chunk as written."""
    rows = fx.table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "chunks")
    exports.export_by_offset(rows, path, ROWS, _ORDER.split(", "))
    return chunks.manifest(spark.read.parquet(path), "l_orderkey").withColumn(
        "chunk_id", F.col("chunk_id").cast("bigint")
    )


@query("chunk_scan_sizes", f"SELECT chunk_id, rows FROM ({_SIZES})")
def chunk_scan_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export in scan order: exact chunk sizes without a shuffle."""
    rows = fx.table(spark, sf_dir, "lineitem")
    export = exports.export_by_offset(rows, scratch_path(spark, "chunks"), ROWS)
    return export.manifest.drop("path")


@query(
    "chunk_export_check",
    """SELECT count(*) AS source_rows, count(*) AS chunk_rows, count(*) AS reread_rows,
       'VALIDATION_SUCCESS' AS status FROM lineitem""",
)
def chunk_export_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export with decimals turned into doubles; source, chunks and re-read must agree."""
    rows = fx.table(spark, sf_dir, "lineitem").withColumn(
        "l_extendedprice", F.col("l_extendedprice").cast("decimal(20,4)")
    )
    return exports.export_by_offset_repaired(rows, scratch_path(spark, "chunks"), ROWS).check


@query("chunk_export_content", "SELECT * FROM events")
def chunk_export_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chunks of a time export read back together."""
    path = scratch_path(spark, "chunks")
    exports.export_by_time(fx.table(spark, sf_dir, "events"), path, "ts", DAYS)
    return spark.read.parquet(path).drop(chunks.CHUNK)


_PLAN = f"""WITH b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events),
p AS (SELECT i AS chunk_id, lo, hi, lo + to_days(CAST(i * {DAYS} AS int)) AS start_ts,
             least(lo + to_days(CAST((i + 1) * {DAYS} AS int)), hi + INTERVAL 1 DAY) AS end_ts
      FROM b, LATERAL (SELECT unnest(range(0, date_diff('microsecond', lo, hi)
                                              // ({DAYS} * 86400000000) + 1)) AS i))"""


@query(
    "chunk_time_manifest",
    _PLAN
    + """
SELECT chunk_id, start_ts, end_ts, (SELECT count(*) FROM events WHERE ts >= start_ts
       AND ts < end_ts) AS rows FROM p""",
)
def chunk_time_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.time_manifest(fx.table(spark, sf_dir, "events"), "ts", DAYS)


_GAPPED = fx.Derived(
    "events",
    {
        "event_id": "event_id",
        "ts": "CASE WHEN event_type = 'error' THEN NULL "
        "WHEN event_type = 'view' THEN ts + INTERVAL 60 DAY ELSE ts END",
    },
)


@query(
    "chunk_time_export",
    fx.ctes(e=_GAPPED)
    + f""",
b AS (SELECT min(ts) AS lo FROM e)
SELECT CAST(coalesce(date_diff('microsecond', lo, ts) // ({DAYS} * 86400000000), -1) AS bigint)
         AS chunk_id, count(*) AS rows
FROM e, b GROUP BY 1""",
)
def chunk_time_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export of rows with missing times and a gap; every row lands in some chunk."""
    rows = _GAPPED.frame(spark, sf_dir)
    export = exports.export_by_time(rows, scratch_path(spark, "chunks"), "ts", DAYS)
    return export.manifest.drop("path")


# a fifth of the events within two hours, some without a time
_BUSY = fx.Derived(
    "events",
    {
        "event_id": "event_id",
        "ts": "CASE WHEN event_type = 'view' THEN TIMESTAMP '2024-01-15 08:00:00' + (event_id % 7200) * INTERVAL 1 SECOND "
        "WHEN event_type = 'error' AND event_id % 3 = 0 THEN NULL ELSE ts END",
    },
)
_EVEN = {"lineitem": ("l_shipdate", 2_000), "events": ("ts", 250)}


def _even_sql(name: str, table: str, ts: str, wanted: int) -> str:
    """Day, hour, minute, second and instant: each level counts the rows inside of the dense cells of the one above."""
    widths = (86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000, 1)
    levels, leaves = [], []
    for i, w in enumerate(widths):
        inside = "" if i == 0 else f" WHERE u - u % {widths[i - 1]} IN (SELECT b FROM {name}_{i - 1} WHERE n > {wanted})"
        levels.append(f"{name}_{i} AS (SELECT u - u % {w} AS b, count(*) AS n FROM {name}_m{inside} GROUP BY 1)")
        leaves.append(f"SELECT b, {w} AS w, n FROM {name}_{i}" + ("" if i == 4 else f" WHERE n <= {wanted}"))
    return (
        f"{name}_m AS (SELECT epoch_us({ts}::TIMESTAMP) AS u FROM {table} WHERE {ts} IS NOT NULL), {', '.join(levels)}, "
        f"{name}_c AS (SELECT *, sum(n) OVER (ORDER BY b) - n AS before FROM ({' UNION ALL '.join(leaves)})), "
        f"{name}_p AS (SELECT '{name}' AS table_name, (before // {wanted})::BIGINT AS chunk_id, make_timestamp(min(b)) AS start_ts, "
        f"make_timestamp(max(b + w)) AS end_ts, sum(n)::BIGINT AS rows FROM {name}_c GROUP BY 2 "
        f"UNION ALL SELECT '{name}', -1, NULL, NULL, count(*) FROM {table} WHERE {ts} IS NULL HAVING count(*) > 0)"
    )


@query(
    "chunk_even_manifest",
    fx.ctes(busy=_BUSY)
    + ", "
    + ", ".join(_even_sql(n, "busy" if n == "events" else n, *of) for n, of in _EVEN.items())
    + " SELECT * FROM lineitem_p UNION ALL SELECT * FROM events_p",
)
def chunk_even_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports in time ranges of about equal rows: the planned ranges and the rows that were written to each."""
    found = []
    for name, (ts, wanted) in _EVEN.items():
        rows = _BUSY.frame(spark, sf_dir) if name == "events" else fx.table(spark, sf_dir, name)
        export = exports.export_by_time_even(rows, scratch_path(spark, "even"), ts, wanted)
        counted = export.manifest.select(F.col("chunk_id").cast("bigint").alias("chunk_id"), "rows")
        found.append(counted.join(export.plan.drop("rows"), "chunk_id", "left").select(F.lit(name).alias("table_name"), "*"))
    return found[0].unionByName(found[1])


_PAGED = {"lineitem": ("l_orderkey", 1_000), "customer": ("c_name", 400), "orders": ("o_orderdate", 700)}


def _paged_sql(name: str, key: str, size: int) -> str:
    return f"""SELECT '{name}' AS table_name, row_number() OVER (ORDER BY upto) - 1 AS chunk_id,
       lag(k) OVER (ORDER BY upto)::VARCHAR AS after_key, k::VARCHAR AS upto_key,
       (upto - coalesce(lag(upto) OVER (ORDER BY upto), 0))::BIGINT AS rows
FROM (SELECT k, n, sum(n) OVER (ORDER BY k) AS upto, sum(n) OVER () AS total
      FROM (SELECT {key} AS k, count(*) AS n FROM {name} GROUP BY 1))
WHERE upto // {size} > (upto - n) // {size} OR upto = total"""


@query("chunk_keyset_manifest", " UNION ALL ".join(_paged_sql(n, *of) for n, of in _PAGED.items()))
def chunk_keyset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports by ranges of a number, a text and a date, keys repeated: the limits and the rows written between them."""
    found = []
    for name, (key, size) in _PAGED.items():
        rows = fx.table(spark, sf_dir, name)
        export = exports.export_by_key(rows, scratch_path(spark, "keys"), key, size)
        counted = export.manifest.select(F.col("chunk_id").cast("bigint").alias("chunk_id"), "rows")
        limits = [F.col(c).cast("string").alias(c) for c in ("after_key", "upto_key")]
        joined = counted.join(export.plan.drop("rows"), "chunk_id", "left")
        found.append(joined.select(F.lit(name).alias("table_name"), "chunk_id", *limits, "rows"))
    return found[0].unionByName(found[1]).unionByName(found[2])
