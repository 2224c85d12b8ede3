"""Parquet folders, CSV control sheets and SQL script folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reconlake.functions.columns import col
from reconlake.operators.discovery import SHEET

LOAD_SHEET = "schema_name string, table_name string, s3_path string"
TABLE_LIST = "schema_name string, table_name string"
COPY_LIST = "table_name string"
DATE_COLUMN_LIST = "schema_name string, table_name string, date_columns string"


def parquet(
    spark: SparkSession,
    *paths: str,
    tolerant: bool = False,
    schema: str | T.StructType | None = None,
) -> DataFrame:
    """One or many Parquet folders as one relation.

    ``tolerant`` skips files that are corrupt or vanish, which loses their rows silently:
    :func:`skipped_files` names them, and a load needs a source count from elsewhere. Give it a
    schema, since the file whose footer would be asked for one may be a corrupt one.
    """
    reader = spark.read
    if tolerant:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*paths)


def _plain_path(path: Column) -> Column:
    return F.regexp_replace(path, "^[a-z]+:/+", "/")


def file_ledger(
    spark: SparkSession, *paths: str, schema: str | T.StructType | None = None
) -> DataFrame:
    """Per Parquet file below the paths: file_path, rows by its footer, and rows that a tolerant read decodes.

    Every column is decoded, so a file with a good footer and damaged pages has fewer rows than its
    footer says. ``footer_rows`` is NULL if the footer cannot be read, or says that there are none.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(list(paths))
        .select(F.col("path").alias("file_path"), _plain_path(F.col("path")).alias("name"))
    )
    read = parquet(spark, *paths, tolerant=True, schema=schema)
    name = _plain_path(F.col("_metadata.file_path")).alias("name")
    # without a column, rows are counted from the footers; with a hash over all columns, each page is read
    footers = read.select(name).groupBy("name").agg(F.count(F.lit(1)).alias("footer_rows"))
    hashable = [
        F.to_json(F.struct(col(f.name))) if isinstance(f.dataType, T.MapType) else col(f.name)
        for f in read.schema.fields
    ]
    decoded = read.select(name, F.xxhash64(*hashable).alias("row")).groupBy("name").agg(
        # a plain count of the hash, which is never NULL, would be answered without reading a page
        F.when(F.bit_xor("row").isNotNull(), F.count(F.lit(1))).alias("decoded_rows")
    )
    return (
        listed.join(footers, "name", "left")
        .join(decoded, "name", "left")
        .select("file_path", "footer_rows", F.coalesce("decoded_rows", F.lit(0).cast("bigint")).alias("decoded_rows"))
    )


def skipped_files(
    spark: SparkSession, *paths: str, schema: str | T.StructType | None = None
) -> DataFrame:
    """The Parquet files below the paths of which a tolerant read misses rows: file_path, rows it lacks.

    ``lost_rows`` is NULL if the footer does not tell. A file that really has no rows is listed too.
    """
    short = F.col("footer_rows").isNull() | (F.col("decoded_rows") < F.col("footer_rows"))
    return (
        file_ledger(spark, *paths, schema=schema)
        .where(short)
        .select("file_path", (F.col("footer_rows") - F.col("decoded_rows")).alias("lost_rows"))
    )


def control_sheet(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV with a header and an explicit schema; read by Spark, without inference."""
    return spark.read.schema(schema).option("escape", '"').csv(path, header=True)


def column_sheet_csv(spark: SparkSession, path: str) -> DataFrame:
    return control_sheet(spark, path, SHEET)


def copy_list(spark: SparkSession, path: str) -> DataFrame:
    """Names to copy; rows without a name are dropped."""
    return control_sheet(spark, path, COPY_LIST).dropna(subset=["table_name"])


def sql_scripts(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``*.sql`` file below the folder as one whole document: file_path, text."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.sql")
        .text(folder, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text"))
    )
