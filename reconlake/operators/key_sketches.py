"""Sketches of the rows of each data file, kept beside a table.

A sketch says per file and month of its rows: first and last day, and a Bloom filter of their keys, cut in
blocks of 32,768 bits. A delta meets the blocks by month and block number, so files of other months are never
looked at, and only files that may hold one of its rows are read. A file without a sketch, or changed
since, is always read.

Worth it for tables whose files hold few months each; where every file holds all of them, every key meets a
block of every file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.functions import dates
from reconlake.functions.columns import col
from reconlake.functions.hashing import quick_key

UNDATED = "undated"
#: Keys that a block is meant for; each sets one bit in either of its two bitmaps of 32,768 bits.
KEYS_A_BLOCK = 2048
_BITS = 32768
_KEYS = ["__row_key_1", "__row_key_2"]
_SHAPE = "columns string, date_column string, blocks int"


def file_version() -> Column:
    """Path and modification time of the file a row was read from; filters on it choose files."""
    return F.concat_ws(
        "|", F.col("_metadata.file_path"), F.unix_micros("_metadata.file_modification_time").cast("string")
    )


def _columns(df: DataFrame) -> str:
    return ", ".join(f"{f.name.lower()} {f.dataType.simpleString()}" for f in df.schema.fields)


def _bit(key: Column, shift: int) -> Column:
    return F.shiftrightunsigned(key, shift).bitwiseAND(F.lit(_BITS - 1))


def _keyed(df: DataFrame, date_column: str, blocks: int) -> list[Column]:
    """Month, day, block and the two bits of each row (Spark's hash takes -0.0 for the 0.0 that it equals)."""
    first, second = quick_key(df.schema.fields, _KEYS)
    day = F.date_format(dates.as_temporal(df, date_column), "yyyy-MM-dd")
    return [
        F.coalesce(F.substring(day, 1, 4), F.lit(UNDATED)).alias("year"),
        F.coalesce(F.substring(day, 1, 7), F.lit(UNDATED)).alias("month"),
        day.alias("day"),
        F.pmod(first, F.lit(blocks)).cast("int").alias("block"),
        _bit(second, 8).alias("bit_1"),
        _bit(second, 32).alias("bit_2"),
    ]


def _write(table: DataFrame, path: str, date_column: str, blocks: int) -> None:
    rows = table.select(file_version().alias("file"), *_keyed(table, date_column, blocks))
    blocks_of = rows.groupBy("file", "year", "month", "block").agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.bitmap_construct_agg("bit_1").alias("bits_1"),
        F.bitmap_construct_agg("bit_2").alias("bits_2"),
    )
    # a folder per year, which the delta's years choose from; a big year is split over tasks
    blocks_of.hint("rebalance", "year").write.mode("append").partitionBy("year").parquet(f"{path}/blocks")
    # files are named when all their blocks are there: those of a run that broke off are read, and sketched again
    spark = table.sparkSession
    done = _blocks(spark, path).select("file").distinct()
    done.join(_files(spark, path), "file", "left_anti").coalesce(1).write.mode("append").parquet(f"{path}/files")


def write_sketches(table: DataFrame, path: str, date_column: str) -> None:
    """Sketches of all files of a table, below a new path.

    Blocks are as many as the largest file's rows ask for: a power of two, the same for all files, since a
    block that no key meets takes no row. Rows are counted from footers, keys made in one pass.
    """
    sizes = table.groupBy(F.col("_metadata.file_path").alias("file")).count()
    most = sizes.agg(F.max("count").alias("n")).first()["n"] or 1
    blocks = 1 << max(0, -(-most // KEYS_A_BLOCK) - 1).bit_length()
    shape = (_columns(table), date_column.lower(), blocks)
    spark = table.sparkSession
    spark.createDataFrame([], "file string").write.mode("overwrite").parquet(f"{path}/files")
    # the shape is written last: without it a sketch that was not finished is not used
    _write(table, path, date_column, blocks)
    spark.createDataFrame([shape], _SHAPE).coalesce(1).write.mode("overwrite").parquet(f"{path}/shape")


def _shape(spark: SparkSession, path: str) -> tuple[str, str, int] | None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/shape/_SUCCESS")
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return None
    return tuple(spark.read.schema(_SHAPE).parquet(f"{path}/shape").first())


def exist(spark: SparkSession, path: str) -> bool:
    return _shape(spark, path) is not None


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file string").parquet(f"{path}/files")


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "file string, month string, block int, first_day string, last_day string, bits_1 binary, "
        "bits_2 binary, year string"
    ).parquet(f"{path}/blocks")


def add_sketches(table: DataFrame, path: str) -> None:
    """Sketches of the files that have none yet, or were changed; other files are not read."""
    shape = _shape(table.sparkSession, path)
    if shape is None or shape[0] != _columns(table):
        raise ValueError(f"no sketches of these columns at {path}")
    known = [r.file for r in _files(table.sparkSession, path).toLocalIterator()]
    _write(table.filter(~file_version().isin(known)) if known else table, path, shape[1], shape[2])


def _is_set(bits: str, bit: str) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(F.col(bit) / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    moved = F.call_function("shiftright", byte.cast("int"), (F.col(bit) % 8).cast("int"))
    return moved.bitwiseAND(F.lit(1)) == 1


def files_without(delta: DataFrame, path: str) -> list[str]:
    """Versions of files that hold none of the delta's rows: never one that holds any.

    Without sketches, or with sketches of other columns or types, the list is empty. It has at most one
    entry per file of the table, as Spark's own list of files does.
    """
    spark = delta.sparkSession
    shape = _shape(spark, path)
    if shape is None or shape[0] != _columns(delta):
        return []
    _, date_column, blocks = shape
    keys = delta.select(*_keyed(delta, date_column, blocks)).distinct()
    within = (F.col("month") == UNDATED) | F.col("day").between(F.col("first_day"), F.col("last_day"))
    hit = (
        _blocks(spark, path)
        .join(keys, ["year", "month", "block"])
        .filter(within & _is_set("bits_1", "bit_1") & _is_set("bits_2", "bit_2"))
        .select("file")
        .distinct()
    )
    missed = _files(spark, path).join(hit, "file", "left_anti")
    return [r.file for r in missed.toLocalIterator()]


def may_hold(table: DataFrame, delta: DataFrame, path: str) -> DataFrame:
    """The table's rows in files that may hold a row of the delta; other files are not opened."""
    passed = files_without(delta, path)
    rows = table.filter(~file_version().isin(passed)) if passed else table
    return rows.select(*[col(c) for c in table.columns])
