"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Joins each node's larger neighbours to the least node around it."""
    both = edges.select("u", "v").union(edges.select("v", "u"))
    joined = both.join(_least_neighbour(both), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Joins each node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least_neighbour(down)
    moved = down.join(least, "u").where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least).distinct()


def connected_components(edges: DataFrame, at: str) -> DataFrame:
    """(node, root) of every node in ``edges`` (long columns u and v, u not equal v); root is the least node.

    Each round is written below ``at``, so no lineage grows; the rounds needed rise with the logarithm of
    a component's length. Only a count and a checksum per round reach the driver.
    """
    spark = edges.sparkSession
    checksum, turn = None, 0
    while True:
        edges.write.parquet(f"{at}/round-{turn}")
        edges = spark.read.schema("u long, v long").parquet(f"{at}/round-{turn}")
        total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        found = edges.agg(F.count(F.lit(1)).alias("n"), total.alias("sum")).first()
        if found == checksum or found["n"] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct()
            )
        checksum, turn = found, turn + 1
        edges = _small_star(_large_star(edges))
