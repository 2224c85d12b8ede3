"""A tree of digests of a table's rows that is kept beside a copy and compared instead of the copy.

Levels are the table, its days, buckets of fingerprints, and fingerprints with their number of copies. A
node's digest is the sum over its children, so nodes merge in any order. Files lie in a folder per month (or
day, or year), and those of the days that changed are written anew without reading the others. Two
trees are compared from the top: only buckets of days that differ are looked at, and only leaves in the
folders of those days are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.functions import dates
from reconlake.functions.columns import col
from reconlake.functions.hashing import hash_key
from reconlake.operators.counts import stack

UNDATED = "undated"
_SUMS = [f"d{seed}_{shift}" for seed in (1, 2) for shift in (0, 22, 44)]
_LEAF = "day string, bucket int, row_hash binary, copies long, period string"
_NODE = "day string, bucket int, n long, " + ", ".join(f"{c} decimal(38,0)" for c in _SUMS) + ", period string"
#: Characters of yyyy-MM-dd that name the folder of a day.
FOLDERS = {"day": 10, "month": 7, "year": 4}
_FOUND = "day string, bucket int, row_hash string, source_count long, target_count long"


def _day(df: DataFrame, date_column: str) -> Column:
    return F.coalesce(F.date_format(dates.as_temporal(df, date_column), "yyyy-MM-dd"), F.lit(UNDATED))


def _period(day: str, folder: str) -> str:
    return day if day == UNDATED else day[: FOLDERS[folder]]


def _period_of(day: Column, folder: str) -> Column:
    return F.when(day == UNDATED, day).otherwise(F.substring(day, 1, FOLDERS[folder])).alias("period")


def _shape(df: DataFrame, date_column: str, buckets: int, mode: str, folder: str) -> str:
    columns = ", ".join(f"{f.name.lower()} {f.dataType.simpleString()}" for f in df.schema.fields)
    return f"{mode}; {buckets} buckets; by {date_column.lower()}; a folder per {folder}; {columns}"


def _digests() -> list[Column]:
    """Two 64-bit digests of a leaf, in pieces whose sums never overflow, times its copies."""
    out = []
    for seed in (1, 2):
        digest = F.xxhash64("row_hash", F.lit(seed))
        for shift in (0, 22, 44):
            piece = F.shiftrightunsigned(digest, shift).bitwiseAND(F.lit((1 << 22) - 1))
            out.append(F.sum((piece * F.col("copies")).cast("decimal(38,0)")).cast("decimal(38,0)").alias(f"d{seed}_{shift}"))
    return out


def write_tree(
    df: DataFrame, path: str, date_column: str, buckets: int = 4096, mode: str = "safe", folder: str = "month"
) -> None:
    """Writes the tree of a whole table below ``path``; the copy is read once."""
    if buckets < 1 or buckets & (buckets - 1):
        raise ValueError("the number of buckets must be a power of two")
    shape = _shape(df, date_column, buckets, mode, folder)
    df.sparkSession.createDataFrame([(shape,)], "shape string").coalesce(1).write.mode("overwrite").parquet(f"{path}/shape")
    _write(df, path, date_column, buckets, mode, folder, None)


def update_tree(
    df: DataFrame, path: str, date_column: str, days: Sequence[str], buckets: int = 4096, mode: str = "safe", folder: str = "month"
) -> None:
    """Writes the folders of the given days (yyyy-MM-dd, or ``undated``) anew from the table as it is now.

    Other folders stay, and filters on the days reach the scan of the table. A folder without rows is emptied.
    """
    kept = df.sparkSession.read.parquet(f"{path}/shape").first()["shape"]
    shape = _shape(df, date_column, buckets, mode, folder)
    if kept != shape:
        raise ValueError(f"the tree was written of another form: {kept}, not {shape}")
    if days:
        _write(df, path, date_column, buckets, mode, folder, sorted({_period(d, folder) for d in days}))


def _write(df: DataFrame, path: str, date_column: str, buckets: int, mode: str, folder: str, periods: list[str] | None) -> None:
    spark = df.sparkSession
    if periods is not None:
        c = dates.as_temporal(df, date_column)
        dated = [p for p in periods if p != UNDATED]
        wanted = c.isNull() if UNDATED in periods else F.lit(False)
        if dated:
            # bounds reach the scan whatever the column's type; 366 days are the longest folder
            first = F.lit((min(dated) + "-01-01")[:10]).cast("date")
            last = F.date_add(F.lit((max(dated) + "-01-01")[:10]).cast("date"), 366)
            named = F.substring(F.date_format(c, "yyyy-MM-dd"), 1, FOLDERS[folder])
            wanted = wanted | ((c >= first) & (c < last) & named.isin(*dated))
        df = df.where(wanted)
    hashed = df.select(_day(df, date_column).alias("day"), hash_key(df, None, mode).alias("row_hash"))
    bucket = F.xxhash64("row_hash").bitwiseAND(F.lit(buckets - 1)).cast("int")
    leaves = hashed.groupBy("day", "row_hash").agg(F.count(F.lit(1)).alias("copies"))
    leaves = leaves.select("day", bucket.alias("bucket"), "row_hash", "copies", _period_of(F.col("day"), folder))
    if periods is not None:
        # a row that counts nothing, so that the files of a folder without rows are replaced, too
        nothing = spark.createDataFrame([(p,) for p in periods], "period string")
        leaves = leaves.unionByName(
            nothing.select(
                F.col("period").alias("day"), F.lit(0).alias("bucket"), F.lit(b"").alias("row_hash"),
                F.lit(0).cast("long").alias("copies"), "period",
            )
        )
    by_period = leaves.hint("rebalance", "period").sortWithinPartitions("period", "day", "bucket")
    _replace(by_period, f"{path}/leaves", periods is not None)
    written = _leaves(spark, path, periods)
    nodes = written.groupBy("day", "bucket", "period").agg(F.sum("copies").alias("n"), *_digests())
    nodes = nodes.select("day", "bucket", "n", *_SUMS, "period").hint("rebalance", "period")
    _replace(nodes, f"{path}/nodes", periods is not None)


def _replace(df: DataFrame, path: str, some: bool) -> None:
    writer = df.write.mode("overwrite").partitionBy("period")
    writer.option("partitionOverwriteMode", "dynamic" if some else "static").parquet(path)


def _leaves(spark: SparkSession, path: str, periods: Sequence[str] | None) -> DataFrame:
    reader = spark.read.schema(_LEAF)
    if periods is None:
        return reader.parquet(f"{path}/leaves")
    folders = [f"{path}/leaves/period={p}" for p in sorted(set(periods))]
    return reader.option("basePath", f"{path}/leaves").parquet(*folders)


def _both(source: DataFrame, target: DataFrame, by: list[str]) -> DataFrame:
    """Groups whose rows or digests differ."""
    sums = ["n", *_SUMS]
    sides = [df.select(*by, *[(F.col(c) * sign).alias(c) for c in sums]) for df, sign in ((source, 1), (target, -1))]
    totals = stack(sides).groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums])
    return totals.where(" OR ".join(f"{c} <> 0" for c in sums)).select(*by)


def compare_trees(spark: SparkSession, source: str, target: str) -> DataFrame:
    """day, bucket, row_hash and both numbers of copies of every row whose numbers differ.

    The days that differ come to the driver, at most those of the calendar; leaves in folders without such a day
    are not opened. Trees of another form (columns, types, hash, buckets, folders) are not compared.
    """
    shapes = [spark.read.parquet(f"{p}/shape").first()["shape"] for p in (source, target)]
    if shapes[0] != shapes[1]:
        raise ValueError(f"the trees are of different forms: {shapes[0]}, and {shapes[1]}")
    nodes = [spark.read.schema(_NODE).parquet(f"{p}/nodes") for p in (source, target)]
    days = [r["day"] for r in _both(*nodes, ["day"]).collect()]
    if not days:
        return spark.createDataFrame([], _FOUND)
    folder = next(f for f in FOLDERS if f"a folder per {f};" in shapes[0])
    periods = sorted({_period(d, folder) for d in days})
    open_nodes = [n.where(F.col("period").isin(*periods) & F.col("day").isin(*days)) for n in nodes]
    buckets = _both(*open_nodes, ["day", "bucket"])
    counted = []
    for path, own, name in zip((source, target), open_nodes, ("source_count", "target_count")):
        there = [r["period"] for r in own.select("period").distinct().collect()]
        if there:
            rows = _leaves(spark, path, there).join(buckets, ["day", "bucket"], "left_semi").where("copies > 0")
            none = F.lit(0).cast("long")
            both = {n: F.col("copies") if n == name else none for n in ("source_count", "target_count")}
            counted.append(rows.select("day", "bucket", "row_hash", *[c.alias(n) for n, c in both.items()]))
    merged = stack(counted).groupBy("day", "bucket", "row_hash").agg(
        F.sum("source_count").alias("source_count"), F.sum("target_count").alias("target_count")
    )
    digits = F.lower(F.hex("row_hash")).alias("row_hash")
    return merged.where("source_count <> target_count").select("day", "bucket", digits, "source_count", "target_count")


def changed_days(found: DataFrame) -> DataFrame:
    """Per day: distinct rows whose copies differ, rows lost and rows added."""
    s, t = F.col("source_count"), F.col("target_count")
    return found.groupBy("day").agg(
        F.count(F.lit(1)).alias("differing_rows"),
        F.sum(F.greatest(s - t, F.lit(0))).alias("rows_lost"),
        F.sum(F.greatest(t - s, F.lit(0))).alias("rows_added"),
    )
