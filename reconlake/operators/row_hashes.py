"""Row-level reconciliation by fingerprint.

Both sides are stacked and counted per fingerprint in one shuffle. Copies of a row collapse
before the exchange, so a row repeated a billion times costs one record per task. The
result has the distinct-row view (set difference) and the multiset view (lost or added copies).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.functions import dates, status
from reconlake.functions.columns import align_to, col, same_types
from reconlake.functions.hashing import hash_key
from reconlake.operators.counts import (
    TablePair,
    checked_columns,
    readable_pair,
    side_counts,
    stack,
)


#: The list of differing buckets is broadcast; so many take 16 MB.
MOST_BUCKETS = 1 << 20


def hash_profile(
    source: DataFrame,
    target: DataFrame,
    mode: str = "safe",
    separator: str = "||",
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows per fingerprint on both sides: ``by`` columns, row_hash (binary), two counts.

    Target columns are matched to the source by name, so column order does not matter; types that
    differ are widened on both sides. The ``by`` columns are part of the row.
    """
    keys = [col(b) for b in by]
    source, target = same_types(source, align_to(target, source.columns))
    return side_counts(
        *[df.select(*keys, _fingerprint(df, mode, separator)) for df in (source, target)]
    )


def row_profile(source: DataFrame, target: DataFrame) -> DataFrame:
    """The same per distinct row instead of per fingerprint: all columns and two counts.

    Nothing is hashed, which is faster for narrow rows; wide rows are moved in full.
    """
    return side_counts(source, align_to(target, source.columns))


def _fingerprint(df: DataFrame, mode: str, separator: str) -> Column:
    return hash_key(df, None, mode, separator).alias("row_hash")


def summarize(profile: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per ``by`` group with distinct and multiset differences and the status."""
    s, t = F.col("source_count"), F.col("target_count")
    out = profile.groupBy(*[col(b) for b in by]).agg(
        F.count_if(s > 0).alias("source_hash_count"),
        F.count_if(t > 0).alias("target_hash_count"),
        F.count_if((s > 0) & (t > 0)).alias("matched_hash_count"),
        F.count_if(t == 0).alias("source_only"),
        F.count_if(s == 0).alias("target_only"),
        F.count_if((s > 0) & (t > 0) & (s != t)).alias("uneven_copies"),
        F.coalesce(F.sum(F.greatest(s - t, F.lit(0))), F.lit(0)).alias("rows_lost"),
        F.coalesce(F.sum(F.greatest(t - s, F.lit(0))), F.lit(0)).alias("rows_added"),
    )
    matched = F.col("matched_hash_count")
    equal_sets = (matched == F.col("source_hash_count")) & (matched == F.col("target_hash_count"))
    return out.withColumns(
        {
            "validation_status": F.when(equal_sets, status.MATCH).otherwise(status.NOT_MATCH),
            "multiset_status": F.when(equal_sets & (F.col("uneven_copies") == 0), status.MATCH)
            .otherwise(status.NOT_MATCH),
        }
    )


def compare_rows(
    source: DataFrame,
    target: DataFrame,
    mode: str = "safe",
    separator: str = "||",
    by: Sequence[str] = (),
) -> DataFrame:
    return summarize(hash_profile(source, target, mode, separator, by), by)


def _comparable(p: TablePair, windowed: bool) -> TablePair:
    """Target columns in source order, in common types; a pair that cannot be compared says why."""
    if windowed:
        p = checked_columns(p)
    if p.source is None or p.target is None:
        return p
    try:
        source, target = same_types(p.source, align_to(p.target, p.source.columns))
        return replace(p, source=source, target=target)
    except ValueError as e:
        return replace(p, target_error=str(e), comparable=False)


def reconcile_hashes(
    pairs: Sequence[TablePair],
    start_date: str | None = None,
    mode: str = "safe",
    separator: str = "||",
) -> DataFrame:
    """Fingerprint comparison of many tables in one plan, one row per table.

    With ``start_date``, tables that have a date column are compared from that date on.
    A table that one side lacks is a row whose hash counts on that side are NULL.
    """
    pairs = [_comparable(p, bool(start_date)) for p in pairs]
    spark = SparkSession.active()
    readable = [p for p in pairs if readable_pair(p)]
    listed = spark.createDataFrame(
        [
            (
                p.table_name,
                "; ".join(e for e in (p.source_error, p.target_error) if e) or None,
                readable_pair(p),
            )
            for p in pairs
        ],
        "table_name string, error_message string, readable boolean",
    )

    def keyed(p: TablePair, df: DataFrame) -> DataFrame:
        if p.date_column and start_date:
            df = dates.since(df, p.date_column, start_date)
        return df.select(F.lit(p.table_name).alias("table_name"), _fingerprint(df, mode, separator))

    nothing = spark.createDataFrame([], "table_name string, row_hash binary")
    profile = side_counts(
        stack([nothing] + [keyed(p, p.source) for p in readable]),
        stack([nothing] + [keyed(p, p.target) for p in readable]),
    )
    summary = summarize(profile, ["table_name"])
    joined = listed.join(summary, "table_name", "left")
    # a readable table without a single row on either side has no group, and is equal
    fallback = F.when(F.col("readable"), status.MATCH).otherwise(status.NOT_MATCH)
    labels = ("validation_status", "multiset_status")
    return joined.select(
        "table_name",
        *[
            F.when(F.col("readable"), F.coalesce(c, F.lit(0))).alias(c)
            for c in summary.columns
            if c not in ("table_name", *labels)
        ],
        *[F.coalesce(c, fallback).alias(c) for c in labels],
        "error_message",
    )


def symmetric_difference(
    source: DataFrame,
    target: DataFrame,
    mode: str = "compat",
    separator: str = ",",
    by: Sequence[str] = (),
) -> DataFrame:
    """Number of distinct rows that only one side has."""
    profile = hash_profile(source, target, mode, separator, by)
    one_sided = (F.col("source_count") == 0) | (F.col("target_count") == 0)
    return profile.groupBy(*[col(b) for b in by]).agg(
        F.count_if(one_sided).alias("mismatched_rows")
    )


def _bucketed(df: DataFrame, mode: str, buckets: int) -> DataFrame:
    if buckets < 1 or buckets & (buckets - 1) or buckets > MOST_BUCKETS:
        raise ValueError(f"the number of buckets must be a power of two, {MOST_BUCKETS} at most")
    keyed = df.select(_fingerprint(df, mode, "||"))
    # a bit mask is never NULL, unlike a remainder: a join on it adds no null filter that
    # would hash every row again
    return keyed.withColumn("bucket", F.xxhash64("row_hash").bitwiseAND(F.lit(buckets - 1)))


def _digest_parts(sign: int) -> list[Column]:
    """Two 64-bit digests in pieces of 22 bits, small enough to be summed in a long."""
    out = []
    for seed in (1, 2):
        digest = F.xxhash64("row_hash", F.lit(seed))
        for shift in (0, 22, 44):
            piece = F.shiftrightunsigned(digest, shift).bitwiseAND(F.lit((1 << 22) - 1))
            out.append((piece * sign).alias(f"d{seed}_{shift}"))
    return out


def differing_buckets(
    source: DataFrame, target: DataFrame, mode: str = "safe", buckets: int = 65536
) -> DataFrame:
    """Buckets of fingerprints in which the two sides do not hold the same rows.

    A bucket is summed up by its row count and digests, so one record per task and bucket is
    shuffled instead of one per row.
    """
    source, target = same_types(source, align_to(target, source.columns))
    sides = [
        _bucketed(df, mode, buckets).select(
            "bucket", F.lit(sign).cast("bigint").alias("n"), *_digest_parts(sign)
        )
        for df, sign in ((source, 1), (target, -1))
    ]
    sums = [c for c in sides[0].columns if c != "bucket"]
    totals = stack(sides).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in sums])
    return totals.filter(" OR ".join(f"{c} <> 0" for c in sums)).select("bucket")


def differing_rows(
    source: DataFrame, target: DataFrame, mode: str = "safe", buckets: int | None = None
) -> DataFrame:
    """The fingerprints whose number of copies differs, with both counts.

    With ``buckets``, rows are first summed up per bucket, and only rows of buckets that differ
    are shuffled. That pays off for large copies that are nearly equal: both sides are read and
    hashed twice, but hardly anything is moved. The list of buckets is broadcast; it has at
    most ``buckets`` entries.
    """
    if buckets is None:
        profile = hash_profile(source, target, mode)
    else:
        source, target = same_types(source, align_to(target, source.columns))
        suspects = F.broadcast(differing_buckets(source, target, mode, buckets))
        profile = side_counts(
            *[
                _bucketed(df, mode, buckets).join(suspects, "bucket", "left_semi").select("row_hash")
                for df in (source, target)
            ]
        )
    return profile.filter(F.col("source_count") != F.col("target_count")).select(
        F.lower(F.hex("row_hash")).alias("row_hash"), "source_count", "target_count"
    )
