"""Date predicates and conversions that do not depend on ANSI mode."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reconlake.functions.columns import col

# The declared types and the bare column names that mark a date column.
DATE_TYPES = ("date", "timestamp", "timestamp_ntz")
DATE_NAMES = ("date", "created", "updated", "createdAt", "updatedAt")
# Candidate types when the first date column is looked up in a remote column catalog.
REMOTE_DATE_TYPES = ("date", "timestamp", "timestamptz")

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
TIME_PATTERN = r"^\d{2}:\d{2}:\d{2}$"
EPOCH_DAY_LIMIT = 500000


def is_date_column(name: Column, data_type: Column) -> Column:
    """Declared as a date-like type, or carrying one of the usual names. Never NULL."""
    return F.coalesce(data_type.isin(*DATE_TYPES) | name.isin(*DATE_NAMES), F.lit(False))


def mentions_date(data_type: Column) -> Column:
    """The looser rule for DESCRIBE output: the type text contains ``date``."""
    return F.coalesce(F.lower(data_type).contains("date"), F.lit(False))


def date_fields(df: DataFrame) -> list[str]:
    """Names of the date and timestamp columns of a frame, from its schema alone."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def as_temporal(df: DataFrame, name: str) -> Column:
    """The column as it is, or parsed when it is text (unparseable text becomes NULL)."""
    kinds = [f.dataType for f in df.schema.fields if f.name.lower() == name.lower()]
    if kinds and isinstance(kinds[0], T.StringType):
        return col(name).try_cast("timestamp_ntz")
    return col(name)


def since(df: DataFrame, name: str, start_date: str | dt.date | None) -> DataFrame:
    """Rows with a known date on or after ``start_date``.

    The column is compared bare, so that the filter reaches the scan.
    """
    c = as_temporal(df, name)
    kept = c.isNotNull()
    if start_date is not None:
        kept = kept & (c >= F.lit(str(start_date)).cast("date"))
    return df.filter(kept)


def after(df: DataFrame, name: str, cutoff: str | dt.date | dt.datetime) -> DataFrame:
    """Rows strictly after a cutoff."""
    return df.filter(as_temporal(df, name) > F.lit(str(cutoff)).cast("timestamp_ntz"))


def last_days(df: DataFrame, name: str, as_of: str | dt.datetime, days: int = 30) -> DataFrame:
    """Rows within the given number of days before ``as_of``, both ends included."""
    end = F.lit(str(as_of)).cast("timestamp_ntz")
    start = end - F.make_dt_interval(days=F.lit(days))
    return df.filter(as_temporal(df, name).between(start, end))


def digits_of(c: Column) -> Column:
    """Number of decimal digits of an integer, without its sign."""
    return F.length(F.regexp_replace(c.cast("string"), "^-", ""))


def whole_quotient(a: Column, b: Column) -> Column:
    """Integer division, rounding toward zero."""
    return F.call_function("div", a, b)


def from_epoch_seconds(c: Column) -> Column:
    return F.timestamp_seconds(c.cast("bigint"))


def from_epoch_millis(c: Column, keep_fraction: bool = False) -> Column:
    """Milliseconds since 1970; whole seconds unless the fraction is asked for."""
    if keep_fraction:
        return F.timestamp_millis(c.cast("bigint"))
    return F.timestamp_seconds(whole_quotient(c, F.lit(1000)))


def from_yyyymmdd(c: Column) -> Column:
    return F.to_date(F.try_to_timestamp(c.cast("string"), F.lit("yyyyMMdd")))


def from_epoch_days(c: Column) -> Column:
    """Days since 1970; NULL when the number is no day that a date can hold."""
    return F.date_from_unix_date(c.try_cast("int"))


def from_timestamp_text(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit(TIMESTAMP_FORMAT))


def from_time_text(c: Column, anchor: str = "1970-01-01") -> Column:
    """A time of day, placed on a fixed date."""
    return F.try_to_timestamp(F.concat(F.lit(anchor + " "), c), F.lit(TIMESTAMP_FORMAT))


def to_utc(df: DataFrame, zone: str = "Asia/Kolkata") -> DataFrame:
    """Every timestamp column read as wall clock of ``zone`` and moved to UTC, in one projection."""
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = F.to_utc_timestamp(c, zone)
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = F.convert_timezone(F.lit(zone), F.lit("UTC"), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def utc_clock(instant: Column) -> Column:
    """Wall clock in UTC of an instant, whatever the session time zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds, to the microsecond, between two zone-less timestamps.

    ``timestamp_diff`` would convert both through the session time zone, and be an hour off
    across a clock change.
    """
    return (end - start).cast("interval second").cast("decimal(18,6)")


def clock_micros(clock: Column) -> Column:
    """Microseconds of a zone-less timestamp since 1970-01-01, whatever the session time zone."""
    return (seconds_between(_epoch(), clock) * 1_000_000).cast("bigint")
