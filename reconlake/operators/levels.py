"""In which order scripts can run: levels of the graph that their lineage spans.

A script comes after every other script that writes a table it reads. Rounds take off the scripts whose
tables have no writer left, so a round's number is the level. Scripts and tables are both nodes: a table
with many writers and many readers takes one row per writer and reader, never one per pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reconlake.session import scratch_path

ORDERED, CYCLE, BEHIND = "ordered", "cycle", "behind a cycle"
_LEVELS = "file_path string, level int"


def uses(lineage: DataFrame) -> DataFrame:
    """file_path, table_name (lower case), reads, writes: one row per script and table."""

    def side(role: str) -> DataFrame:
        return lineage.select(
            "file_path",
            F.explode(f"{role}_table_names").alias("table_name"),
            F.lit(role == "source").alias("reads"),
            F.lit(role == "target").alias("writes"),
        )

    both = side("source").unionByName(side("target"))
    return both.groupBy("file_path", F.lower("table_name").alias("table_name")).agg(
        F.bool_or("reads").alias("reads"), F.bool_or("writes").alias("writes")
    )


def _peel(links: DataFrame, scripts: DataFrame, before: str, after: str) -> str:
    """Folder of file_path and level: each round takes scripts whose ``after`` tables have no other ``before`` script left."""
    spark = links.sparkSession
    path = scratch_path(spark, "levels")
    spark.createDataFrame([], _LEVELS).write.parquet(path)
    level = 0
    while True:
        done = spark.read.schema(_LEVELS).parquet(path)
        left = links.join(done, "file_path", "left_anti")
        waiting = left.groupBy("table_name").agg(F.count_if(before).alias("waiting"))
        # a script does not wait for itself
        held = (
            left.filter(after)
            .join(waiting, "table_name")
            .filter(F.col("waiting") > F.col(before).cast("int"))
            .select("file_path")
        )
        free = scripts.join(done, "file_path", "left_anti").join(held, "file_path", "left_anti")
        found = scratch_path(spark, "level")
        free.select("file_path", F.lit(level).alias("level")).write.parquet(found)
        # a frame that reads a folder must not be written to it
        new = spark.read.schema(_LEVELS).parquet(found)
        if new.isEmpty():
            return path
        new.write.mode("append").parquet(path)
        level += 1


def run_levels(lineage: DataFrame) -> DataFrame:
    """file_path, level, state. Scripts of one level can run side by side, levels one after the other.

    A script in a cycle, or between two, has no level and the state ``cycle``; one that waits for such a script
    is ``behind a cycle``. A script that reads what it writes itself does not wait for itself. There are as many
    rounds as the longest chain has scripts; each round's result is kept in the scratch folder.
    """
    spark = lineage.sparkSession
    kept = scratch_path(spark, "uses")
    uses(lineage).write.parquet(kept)
    links = spark.read.parquet(kept)
    scripts = lineage.select("file_path").distinct()
    levels = spark.read.schema(_LEVELS).parquet(_peel(links, scripts, "writes", "reads"))
    rest = scripts.join(levels, "file_path", "left_anti")
    stuck = links.join(rest, "file_path", "left_semi")
    # from the other end: what nothing in a cycle waits for is only behind it
    behind = spark.read.schema(_LEVELS).parquet(_peel(stuck, rest, "reads", "writes"))
    return (
        levels.select("file_path", "level", F.lit(ORDERED).alias("state"))
        .unionByName(behind.select("file_path", F.lit(None).cast("int").alias("level"), F.lit(BEHIND).alias("state")))
        .unionByName(
            rest.join(behind, "file_path", "left_anti").select(
                "file_path", F.lit(None).cast("int").alias("level"), F.lit(CYCLE).alias("state")
            )
        )
    )
