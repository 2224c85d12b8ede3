"""JDBC reads: whole tables, pushed-down queries, partitioned and chunked reads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Options = Mapping[str, str]


def _reader(spark: SparkSession, url: str, options: Options):
    return spark.read.format("jdbc").option("url", url).options(**options)


def table(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """A table, or ``(subquery) AS alias``."""
    return _reader(spark, url, options).option("dbtable", name).load()


def query(spark: SparkSession, url: str, sql: str, **options: str) -> DataFrame:
    """A query that runs in the database; aggregates come back with one row per group."""
    return _reader(spark, url, options).option("query", sql).load()


def partitioned(
    spark: SparkSession,
    url: str,
    name: str,
    column: str,
    lower: object,
    upper: object,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A table read by several tasks, split on ranges of a numeric, date or timestamp column."""
    return (
        _reader(spark, url, options)
        .option("dbtable", name)
        .option("partitionColumn", column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(partitions))
        .load()
    )


def by_predicates(
    spark: SparkSession, url: str, name: str, predicates: Sequence[str], **options: str
) -> DataFrame:
    """A table read by one task per predicate; the predicates must cover it without overlap."""
    return spark.read.jdbc(url, name, predicates=list(predicates), properties=dict(options))


def time_predicates(
    column: str,
    ranges: Sequence[tuple[object, object]],
    nulls: bool = True,
    literal: str = "TIMESTAMP '{}'",
) -> list[str]:
    """Half-open ranges as predicates, with one more for rows without a timestamp; an end of None is open."""
    out = [
        f"{column} >= {literal.format(a)}" + ("" if b is None else f" AND {column} < {literal.format(b)}")
        for a, b in ranges
    ]
    return out + [f"{column} IS NULL"] if nulls else out


def page(
    spark: SparkSession,
    url: str,
    name: str,
    order_by: Sequence[str],
    offset: int,
    size: int,
    paging: str = "LIMIT {size} OFFSET {offset}",
    **options: str,
) -> DataFrame:
    """Rows ``offset .. offset + size`` in a fixed order.

    The order must be total: without it two pages may share rows or miss some.
    """
    cut = paging.format(size=size, offset=offset)
    sql = f"SELECT * FROM {name} ORDER BY {', '.join(order_by)} {cut}"
    return table(spark, url, f"({sql}) chunk", **options)


def probe(spark: SparkSession, url: str, name: str, **options: str) -> T.StructType:
    """Schema of a remote table; no row is fetched."""
    return table(spark, url, f"(SELECT * FROM {name} WHERE 1 = 0) probe", **options).schema


def row_count(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    return query(spark, url, f"SELECT COUNT(*) AS row_count FROM {name}", **options)


def period_counts(
    spark: SparkSession,
    url: str,
    name: str,
    date_column: str,
    start_date: str | None = None,
    parts: Sequence[str] = ("YEAR", "MONTH", "DAY"),
    part: str = "EXTRACT({part} FROM {column})",
    **options: str,
) -> DataFrame:
    """Rows per day, or per month, of a remote table, aggregated in the database.

    Columns are dpYear, dpMonth, dpDay as far as asked for, and source_count.
    """
    where = f"{date_column} IS NOT NULL"
    if start_date:
        where += f" AND {date_column} >= '{start_date}'"
    keys = [part.format(part=p, column=date_column) for p in parts]
    listed = ", ".join(f"{k} AS dp{p.title()}" for k, p in zip(keys, parts))
    found = query(
        spark,
        url,
        f"SELECT {listed}, COUNT(*) AS source_count FROM {name} WHERE {where} "
        f"GROUP BY {', '.join(keys)}",
        **options,
    )
    names = [f"dp{p.title()}" for p in parts]
    # databases differ in the case and the type of what they return
    return found.toDF(*names, "source_count").selectExpr(
        *[f"CAST({n} AS int) AS {n}" for n in names], "CAST(source_count AS bigint) AS source_count"
    )


def time_bounds(spark: SparkSession, url: str, name: str, column: str, **options: str) -> DataFrame:
    """First and last timestamp and number of rows, computed in the database."""
    sql = f"SELECT MIN({column}) AS a, MAX({column}) AS b, COUNT(*) AS n FROM {name}"
    found = query(spark, url, sql, **options).toDF("a", "b", "n")
    # wall clock, so that the time zone of the driver's Python does not shift it
    return found.selectExpr(
        "CAST(a AS timestamp_ntz) AS min_ts", "CAST(b AS timestamp_ntz) AS max_ts", "n AS rows"
    )


def remote_columns(
    spark: SparkSession, url: str, schema: str, name: str, catalog_table: str, **options: str
) -> DataFrame:
    """column_name, data_type and ordinal_position from the remote column catalog."""
    return query(
        spark, url,
        "SELECT column_name, data_type, ordinal_position FROM "
        f"{catalog_table} WHERE table_schema = '{schema}' AND table_name = '{name}'",
        **options,
    )


def _double_quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def projection_for(columns: Sequence[tuple[str, str]]) -> str:
    """Select list by declared remote type: decimals as NUMERIC(38,18), intervals as VARCHAR."""
    out = []
    for name, kind in columns:
        q = _double_quoted(name)
        low = kind.lower()
        if low.startswith(("decimal", "numeric")):
            out.append(f"CAST({q} AS NUMERIC(38,18)) AS {q}")
        elif low.startswith("interval"):
            out.append(f"CAST({q} AS VARCHAR) AS {q}")
        else:
            out.append(q)
    return ", ".join(out)


def projection_from(schema: T.StructType) -> str:
    """Select list by probed Spark type: decimals as DOUBLE PRECISION."""
    out = []
    for f in schema.fields:
        q = _double_quoted(f.name)
        if isinstance(f.dataType, T.DecimalType):
            q = f"CAST({q} AS DOUBLE PRECISION) AS {q}"
        out.append(q)
    return ", ".join(out)


def projected(spark: SparkSession, url: str, name: str, select_list: str, **options: str) -> DataFrame:
    return table(spark, url, f"(SELECT {select_list} FROM {name}) projected", **options)
