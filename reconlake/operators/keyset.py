"""Pages of a table by ranges of a key instead of by offset.

A page holds the keys above ``after_key`` up to ``upto_key``; no key is on two pages, and a page has the wanted
rows or, if its last key repeats, as many more. A range of keys is read through an index, where an offset
counts all rows before it. The limits are exact:

1. a quantile sketch of the key cuts the table into buckets, several per page;
2. one pass counts the rows per bucket, which says in which buckets a page ends;
3. the keys of those buckets alone are counted one by one, repeated keys next to the scan, and added up.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reconlake.functions import dates
from reconlake.functions.columns import col
from reconlake.operators.chunks import CHUNK, NO_TIME
from reconlake.session import scratch_path

#: Buckets per page, and in all; beyond that buckets grow with the table.
CUTS_PER_PAGE = 8
MOST_CUTS = 20_000


def _code(df: DataFrame, key: str) -> Column:
    """A number that never falls when the key rises; keys alike in it are told apart later."""
    kind, c = df.schema[key].dataType, col(key)
    if isinstance(kind, T.StringType):
        # text is in order of its bytes; seven of them fit
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return c.cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return dates.clock_micros(c)
    raise ValueError(f"{key} is {kind.simpleString()}: pages go by whole numbers, text, dates or timestamps")


def key_pages(df: DataFrame, key: str, size: int) -> DataFrame:
    """chunk_id, after_key (NULL on the first page), upto_key and rows of every page; rows without a key are on none."""
    if size < 1:
        raise ValueError("a page has at least one row")
    spark, at = df.sparkSession, scratch_path(df.sparkSession, "key-pages")
    keys = df.select(col(key).alias("k"), _code(df, key).alias("code")).where("k IS NOT NULL")
    total = keys.count()
    cuts = max(2, min(MOST_CUTS, CUTS_PER_PAGE * -(-total // size)))
    # one literal: a list would be sent to the JVM number by number
    shares = F.split(F.lit(",".join(str(i / cuts) for i in range(1, cuts))), ",").cast("array<double>")
    sketch = keys.agg(F.percentile_approx("code", shares, max(10_000, 4 * cuts))).first()[0] or []
    limits = np.unique(np.array(sketch, np.int64))

    @F.pandas_udf("long")
    def bucket(codes: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(limits, codes.to_numpy(np.int64), "left").astype(np.int64))

    placed = keys.withColumn("bucket", bucket("code")).select("k", "bucket")
    # at most one row per cut
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).write.parquet(f"{at}/buckets")
    buckets = spark.read.schema("bucket long, n long, before long").parquet(f"{at}/buckets")

    def ends_page(before: Column, upto: Column) -> Column:
        return (F.floor(upto / size) > F.floor(before / size)) | (upto == total)

    ending = buckets.where(ends_page(F.col("before"), F.col("before") + F.col("n"))).select("bucket", "before")
    few = placed.join(ending, "bucket").groupBy("bucket", "before", "k").agg(F.count(F.lit(1)).alias("n"))
    so_far = Window.partitionBy("bucket").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    summed = few.withColumn("upto", F.col("before") + F.sum("n").over(so_far))
    # one row per page
    pages = summed.where(ends_page(F.col("upto") - F.col("n"), F.col("upto"))).select("k", "upto")
    order = Window.orderBy("upto")
    found = pages.select(
        (F.row_number().over(order) - 1).cast("bigint").alias(CHUNK),
        F.lag("k").over(order).alias("after_key"),
        F.col("k").alias("upto_key"),
        (F.col("upto") - F.coalesce(F.lag("upto").over(order), F.lit(0))).alias("rows"),
    )
    # written, for whoever asks again would count the keys again
    found.write.parquet(f"{at}/pages")
    return spark.read.schema(found.schema).parquet(f"{at}/pages")


def with_key_page(df: DataFrame, key: str, limits: list) -> DataFrame:
    """chunk_id of every row from the pages' last keys, in order; rows without a key go to chunk -1."""
    if isinstance(df.schema[key].dataType, T.StringType):
        of, ends = col(key), [x.encode() for x in limits]

        @F.pandas_udf("long")
        def page(keys: pd.Series) -> pd.Series:
            return pd.Series([bisect_left(ends, k.encode()) for k in keys], dtype="int64")

    else:
        # all other keys are told apart by their number
        last = df.sparkSession.createDataFrame([(x,) for x in limits], T.StructType([df.schema[key]]))
        of, ends = _code(df, key), np.array([r[0] for r in last.select(_code(last, key)).collect()], np.int64)

        @F.pandas_udf("long")
        def page(keys: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(ends, keys.to_numpy(np.int64), "left").astype(np.int64))

    known = df.where(col(key).isNotNull()).withColumn(CHUNK, page(of))
    return known.unionByName(df.where(col(key).isNull()).withColumn(CHUNK, F.lit(NO_TIME).cast("bigint")))


def key_predicates(column: str, pages: list[tuple], without_key: bool = True) -> list[str]:
    """SQL conditions of the pages (after_key, upto_key), and one for rows without a key."""

    def literal(value) -> str:
        return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"

    made = []
    for after, upto in pages:
        lower = [] if after is None else [f"{column} > {literal(after)}"]
        made.append(" AND ".join([*lower, f"{column} <= {literal(upto)}"]))
    return [*made, f"{column} IS NULL"] if without_key else made
