"""Which tables have a date column, and which one to use.

Input is a column sheet: schema_name, table_name, column_name, data_type, ordinal_position.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reconlake.functions import dates
from reconlake.functions.columns import same_text

SHEET = T.StructType(
    [
        T.StructField("schema_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("ordinal_position", T.IntegerType()),
    ]
)
TABLE = ["schema_name", "table_name"]


def split_table_name(name: str) -> tuple[str | None, str]:
    parts = name.split(".")
    return (parts[-2] if len(parts) > 1 else None), parts[-1]


def column_sheet(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Column sheet of the given frames, one row per column; reads no data."""
    rows = [
        (*split_table_name(name), f.name, f.dataType.simpleString(), i)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, SHEET)


def _is_date(rule: Column | None) -> Column:
    if rule is not None:
        return rule
    return dates.is_date_column(F.col("column_name"), F.col("data_type"))


def date_profile(sheet: DataFrame, rule: Column | None = None) -> DataFrame:
    """Per table: has_date and date_columns, in column order. One grouping of the sheet."""
    is_date = _is_date(rule)
    listed = F.array_sort(
        F.collect_list(F.when(is_date, F.struct("ordinal_position", "column_name")))
    )
    return sheet.groupBy(*TABLE).agg(
        F.bool_or(is_date).alias("has_date"),
        F.transform(listed, lambda e: e["column_name"]).alias("date_columns"),
    )


def tables_with_dates(sheet: DataFrame, rule: Column | None = None) -> DataFrame:
    return date_profile(sheet.filter(_is_date(rule)), rule).drop("has_date")


def tables_without_dates(sheet: DataFrame, rule: Column | None = None) -> DataFrame:
    """Tables none of whose columns is a date column; a flag per table instead of an anti-join."""
    flagged = sheet.groupBy(*TABLE).agg(F.bool_or(_is_date(rule)).alias("has_date"))
    return flagged.filter(~F.col("has_date")).select(*TABLE)


def first_date_column(
    sheet: DataFrame, types: tuple[str, ...] = dates.REMOTE_DATE_TYPES
) -> DataFrame:
    """The date-typed column with the lowest position of each table."""
    typed = sheet.filter(F.col("data_type").isin(*types))
    return typed.groupBy(*TABLE).agg(
        F.min(F.struct("ordinal_position", "column_name"))["column_name"].alias("date_column")
    )


def listed_date_column(tables: DataFrame, column: str = "date_columns") -> DataFrame:
    """First name of a JSON array text such as ``["created","updated"]``; NULL if there is none."""
    parsed = F.from_json(column, T.ArrayType(T.StringType()))
    return tables.withColumn(column, parsed).withColumn(
        "date_column", F.try_element_at(F.col(column), F.lit(1))
    )


def typed_columns(
    sheet: DataFrame, tables: DataFrame, types: tuple[str, ...] = ("timestamp", "date")
) -> DataFrame:
    """Columns of the listed tables that are declared with one of the types.

    Schema and table names match without case.
    """
    s, t = sheet.alias("s"), tables.select(*TABLE).alias("t")
    same = [same_text(F.col(f"s.{c}"), F.col(f"t.{c}")) for c in TABLE]
    return s.filter(F.col("s.data_type").isin(*types)).join(t, same, "left_semi")


def inspection_log(
    spark: SparkSession, opened: Mapping[str, DataFrame | str]
) -> tuple[DataFrame, DataFrame]:
    """Dateless tables and a success/failed log, from live schemas.

    ``opened`` maps a table name to its frame, or to the error text when it could not be read;
    a failure is a log row and does not stop the others.
    """
    frames = {n: d for n, d in opened.items() if not isinstance(d, str)}
    rows = [
        (*split_table_name(n), "failed" if isinstance(d, str) else "success", d if isinstance(d, str) else None)
        for n, d in opened.items()
    ]
    log = spark.createDataFrame(
        rows, "table_schema string, table_name string, status string, error string"
    )
    dateless = [split_table_name(n) for n, d in frames.items() if not dates.date_fields(d)]
    without = spark.createDataFrame(dateless, "table_schema string, table_name string")
    return without, log
