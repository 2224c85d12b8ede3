"""Time chunks of about equal rows, from a histogram that is refined where it is dense.

Rows are counted per day; days with more rows than a chunk should have are counted per hour, such hours per
minute, and so on down to the single instant. What is left are cells of at most the wanted size,
in order. A cell belongs to the chunk in which its first row falls, so a chunk has fewer than twice the
wanted rows unless one instant has more. Spans without rows have no cell, hence no chunk.

The number of rows before a cell is the one before the cell that it refines plus that of its earlier
siblings (24, 60 or at most a million of them), so no window runs over more than the days of the calendar.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reconlake.functions import dates
from reconlake.functions.columns import col
from reconlake.operators.chunks import CHUNK, NO_TIME
from reconlake.session import scratch_path

_DAY, _HOUR, _MINUTE, _SECOND = 86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000
WIDTHS = (_DAY, _HOUR, _MINUTE, _SECOND, 1)
#: The last microsecond of the year 9999; an end after it is NULL.
_LATEST = 253_402_300_799_999_999
_CELL = "begin long, n long, before long, dense boolean"


def _cell(at: Column, width: int) -> Column:
    return at - F.pmod(at, F.lit(width))


def _clock(micros: Column) -> Column:
    """The wall clock of a number of microseconds."""
    day = _cell(micros, _DAY)
    seconds = ((micros - day) / F.lit(_SECOND).cast("decimal(18,0)")).cast("decimal(18,6)")
    days = dates.whole_quotient(day, F.lit(_DAY)).cast("int")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds)


@dataclass(frozen=True)
class EvenChunks:
    """Cells per level of the histogram (as far down as it was needed) and the wanted rows of a chunk."""

    levels: tuple[DataFrame, ...]
    wanted: int

    @classmethod
    def of(cls, df: DataFrame, ts: str, wanted: int) -> EvenChunks:
        """Counts the rows of a frame; each further level reads only rows of dense cells' spans."""
        at = dates.clock_micros(col(ts).cast("timestamp_ntz"))
        rows = df.select(at.alias("at")).where("at IS NOT NULL")

        def counted(level: int, dense: DataFrame | None) -> DataFrame:
            inside = rows
            if dense is not None:
                # at most one dense cell per chunk
                inside = rows.withColumn("begin", _cell(F.col("at"), WIDTHS[level - 1])).join(dense.select("begin"), "begin", "left_semi")
            return inside.groupBy(_cell(F.col("at"), WIDTHS[level]).alias("begin")).agg(F.count(F.lit(1)).alias("n"))

        return cls._refined(df, counted, wanted, len(WIDTHS))

    @classmethod
    def of_counts(cls, days: DataFrame, hours: DataFrame, wanted: int) -> EvenChunks:
        """From counts that were taken elsewhere: (begin, n) per day and per hour, begin in microseconds."""

        def counted(level: int, dense: DataFrame | None) -> DataFrame:
            if dense is None:
                return days
            return hours.withColumn("day", _cell(F.col("begin"), _DAY)).join(
                dense.select(F.col("begin").alias("day")), "day", "left_semi"
            ).select("begin", "n")

        return cls._refined(days, counted, wanted, 2)

    @classmethod
    def _refined(cls, df: DataFrame, counted, wanted: int, depth: int) -> EvenChunks:
        if wanted < 1:
            raise ValueError("a chunk has at least one row")
        spark, at = df.sparkSession, scratch_path(df.sparkSession, "even-chunks")
        levels: list[DataFrame] = []
        dense = None
        for level in range(depth):
            cells = counted(level, dense)
            if dense is None:
                earlier = Window.orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
                cells = cells.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
            else:
                earlier = Window.partitionBy("above").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
                above = dense.select(F.col("begin").alias("above"), F.col("before").alias("start"))
                cells = cells.withColumn("above", _cell(F.col("begin"), WIDTHS[level - 1])).join(above, "above")
                cells = cells.withColumn("before", F.col("start") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
            last = level == depth - 1
            marked = cells.select("begin", "n", "before", (F.lit(not last) & (F.col("n") > wanted)).alias("dense"))
            marked.write.parquet(f"{at}/level-{level}")
            levels.append(spark.read.schema(_CELL).parquet(f"{at}/level-{level}"))
            dense = levels[-1].where("dense")
            if dense.isEmpty():
                break
        return cls(tuple(levels), wanted)

    def _chunk(self) -> Column:
        return dates.whole_quotient(F.col("before"), F.lit(self.wanted)).cast("bigint")

    def plan(self) -> DataFrame:
        """chunk_id, start_ts, end_ts (behind the last cell; NULL after the year 9999) and planned rows.

        Ids ascend with time; one instant with more rows than wanted leaves a gap in them.
        """
        cells = None
        for width, level in zip(WIDTHS, self.levels):
            own = level.where("NOT dense").select("begin", (F.col("begin") + width).alias("stop"), "n", self._chunk().alias(CHUNK))
            cells = own if cells is None else cells.unionByName(own)
        spans = cells.groupBy(CHUNK).agg(F.min("begin").alias("begin"), F.max("stop").alias("stop"), F.sum("n").alias("rows"))
        end = F.when(F.col("stop") <= _LATEST, _clock(F.col("stop")))
        return spans.select(CHUNK, _clock(F.col("begin")).alias("start_ts"), end.alias("end_ts"), "rows")

    def assign(self, df: DataFrame, ts: str) -> DataFrame:
        """chunk_id of every row; rows without a timestamp go to chunk -1.

        One join by the start of the cell per level that exists, as a rule one or two; a dense cell's
        key is only that of the day, where adaptive execution splits it.
        """
        found, out = [], df.withColumn("__at", dates.clock_micros(col(ts).cast("timestamp_ntz")))
        for number, (width, level) in enumerate(zip(WIDTHS, self.levels)):
            name = f"__chunk_{number}"
            cells = level.where("NOT dense").select(F.col("begin").alias("__begin"), self._chunk().alias(name))
            out = out.join(cells, _cell(F.col("__at"), width) == F.col("__begin"), "left").drop("__begin")
            found.append(F.col(name))
        chunk = F.coalesce(*found, F.lit(NO_TIME).cast("bigint"))
        return out.select(*[col(c) for c in df.columns], chunk.alias(CHUNK))
