"""Date repair and time zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.functions import dates
from reconlake.operators import repair as R
from reconlake.queries import fixtures as fx
from reconlake.queries import query


def _seconds(micros: Column) -> Column:
    return dates.whole_quotient(micros, F.lit(1_000_000))


def encoded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times in the forms in which dates arrive from files; ``raw_s`` is not declared."""
    events = fx.table(spark, sf_dir, "events")
    micros = dates.clock_micros(F.col("ts"))
    day = F.col("ts").cast("date")
    return events.select(
        "event_id",
        _seconds(micros).alias("epoch_s"),
        dates.whole_quotient(micros, F.lit(1000)).alias("epoch_ms"),
        F.date_format(day, "yyyyMMdd").cast("int").alias("ymd"),
        F.date_diff(day, F.lit("1970-01-01").cast("date")).alias("epoch_day"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
        F.date_format("ts", "HH:mm:ss").alias("time_text"),
        F.lit(None).cast("int").alias("nothing"),
        _seconds(micros).alias("raw_s"),
    )


DECLARED = {
    "epoch_s": "timestamp",
    "epoch_ms": "timestamp",
    "ymd": "date",
    "epoch_day": "date",
    "ts_text": "timestamp",
    "time_text": "timestamp",
    "nothing": "date",
}
_INSTANTS = ("epoch_s", "epoch_ms")
_CLOCKS = ("ts_text", "time_text")
_EXPECTED = {
    "epoch_s": "date_trunc('second', ts)",
    "epoch_ms": "date_trunc('second', ts)",
    "ymd": "CAST(ts AS date)",
    "epoch_day": "CAST(ts AS date)",
    "ts_text": "date_trunc('second', ts)",
    "time_text": "TIMESTAMP '1970-01-01 00:00:00' + (date_trunc('second', ts) - date_trunc('day', ts))",
    "nothing": "CAST(NULL AS date)",
    "raw_s": "CAST(floor(epoch(ts)) AS bigint)",
}


def _zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall clock, so that the session time zone does not show."""
    out = []
    for name in df.columns:
        c = F.col(name)
        if name in _INSTANTS:
            c = dates.utc_clock(c)
        elif name in _CLOCKS:
            c = c.cast("timestamp_ntz")
        out.append(c.alias(name))
    return df.select(*out)


@query(
    "repair_dates",
    "SELECT event_id, " + ", ".join(f"{e} AS {n}" for n, e in _EXPECTED.items()) + " FROM events",
)
def repair_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All forms at once: one profile job, one projection."""
    return _zoneless(R.repair(encoded_events(spark, sf_dir), DECLARED))


def _single(name: str, column: str) -> None:
    @query(name, f"SELECT event_id, {_EXPECTED[column]} AS {column} FROM events")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        one = encoded_events(spark, sf_dir).select("event_id", column)
        return _zoneless(R.repair(one, {column: DECLARED[column]}))


for _name, _column in (
    ("repair_epoch_s", "epoch_s"),
    ("repair_epoch_ms", "epoch_ms"),
    ("repair_yyyymmdd", "ymd"),
    ("repair_epoch_day", "epoch_day"),
    ("repair_text_ts", "ts_text"),
    ("repair_text_time", "time_text"),
    ("repair_all_null", "nothing"),
):
    _single(_name, _column)


@query(
    "repair_mixed",
    """SELECT event_id, CASE event_type WHEN 'click' THEN date_trunc('second', ts)
  WHEN 'view' THEN date_trunc('second', ts)
  WHEN 'error' THEN CAST(CAST(ts AS date) AS timestamp) END AS happened FROM events""",
)
def repair_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text column with a different form in each row, some of them no date at all."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "view", F.date_format("ts", "yyyyMMddHHmmss"))
        .when(kind == "error", F.date_format("ts", "yyyyMMdd"))
        .otherwise("unknown")
    )
    mixed = fx.table(spark, sf_dir, "events").select("event_id", text.alias("happened"))
    out = R.repair_mixed(mixed, {"happened": "timestamp"})
    return out.withColumn("happened", F.col("happened").cast("timestamp_ntz"))


@query(
    "repair_numbers",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CAST(CAST(l_extendedprice AS decimal(12,2)) AS decimal(38,18)) AS varchar) AS price,
       CAST(CAST(l_discount AS decimal(5,2)) AS double) AS discount,
       'INTERVAL ''' || l_linenumber || ' 00:00:00'' DAY TO SECOND' AS waited FROM lineitem""",
)
def repair_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_discount").cast("decimal(5,2)").alias("discount"),
        F.make_dt_interval(F.col("l_linenumber")).alias("waited"),
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    wide = R.repair_numbers(rows.select(*keys, "price", "discount", "waited"), "decimal")
    return wide.select(
        *keys,
        F.col("price").cast("string").alias("price"),
        F.col("discount").cast("double").alias("discount"),
        "waited",
    )


@query(
    "to_utc",
    "SELECT event_id, ts - INTERVAL 330 MINUTE AS ts, user_id, event_type, value, props FROM events",
)
def to_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.to_utc(fx.table(spark, sf_dir, "events"), "Asia/Kolkata")
