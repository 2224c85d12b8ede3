"""A hierarchical index of 64-bit fingerprints in Gray order.

Fingerprints are sorted by their rank in the Gray code, in which neighbours differ in few bits. A node
is a run of that order (the ranks with one prefix), of some more bits on each level until a run is
small. It stores the bits that all its members share, as a mask and a pattern. A fingerprint goes down
the levels with the differences it has collected against the masked patterns, and a whole group is
left out as soon as they exceed the limit; because the patterns nest, the differences of a node
contain those of its ancestors. What arrives at a leaf is compared with its few members.

Levels are tables and the descent is a join per level. The first levels have at most 16 to 4,096
nodes and are broadcast; deeper ones, whose number grows with the data, are joined by key. Runs are followed in one direction of the order only, so each pair is met once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Members of a leaf at most (any number of fingerprints can be split that far: they are distinct).
LEAF_MEMBERS = 512
#: Bits of the first level, and of each further one. Steps are small, so that work per fingerprint rises
#: evenly with their number, and long once under a quarter of them is left in large groups.
FIRST, STEP, LONG_STEP = 4, 2, 8
DEEPEST = 60
#: Levels up to this depth have at most 2**12 nodes of 40 bytes.
BROADCAST_DEPTH = 12


_NODE = "run long, node long, mask long, pattern long, n long, leaf boolean"


def gray_rank(bits: Column) -> Column:
    """The position of a 64-bit pattern in the reflected Gray code."""
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, shift))
    return bits


def _run(rank: Column, depth: int) -> Column:
    return F.shiftrightunsigned(rank, 64 - depth) if depth else F.lit(0).cast("long")


def _unsigned(value: Column) -> Column:
    return value.bitwiseXOR(F.lit(-(1 << 63)))


def near_pairs(fingerprints: DataFrame, limit: int, at: str, column: str = "fp") -> DataFrame:
    """All pairs (u, v) of distinct fingerprints (a long column) that differ in 1 to ``limit`` bits.

    Writes levels and pairs below ``at``; NULLs are left out, an empty table has no pairs.
    """
    spark = fingerprints.sparkSession
    distinct = fingerprints.select(F.col(column).alias("fp")).where("fp IS NOT NULL").distinct()
    distinct.withColumn("rank", gray_rank(F.col("fp"))).write.parquet(f"{at}/members")
    members = spark.read.schema("fp long, rank long").parquet(f"{at}/members")
    # members and travellers of the groups that are still too large
    open_members, travellers = members, members.withColumn("run", F.lit(0).cast("long"))
    depth, step, depths, everyone = 0, FIRST, [], 0
    while True:
        depth += step
        runs = open_members.groupBy(_run(F.col("rank"), depth).alias("node")).agg(
            F.count(F.lit(1)).alias("n"), F.bit_and("fp").alias("all_set"), F.bit_or("fp").alias("any_set")
        )
        shared = F.bitwise_not(F.col("all_set").bitwiseXOR(F.col("any_set")))
        runs.select(
            F.shiftrightunsigned("node", step).alias("run"), "node", shared.alias("mask"),
            F.col("all_set").alias("pattern"), "n", ((F.col("n") <= LEAF_MEMBERS) | F.lit(depth >= DEEPEST)).alias("leaf"),
        ).write.parquet(f"{at}/nodes-{depth}")
        nodes = spark.read.schema(_NODE).parquet(f"{at}/nodes-{depth}")
        near = F.bit_count((F.col("fp").bitwiseXOR(F.col("pattern"))).bitwiseAND(F.col("mask"))) <= limit
        onward = F.col("node") >= _run(F.col("rank"), depth)
        side = F.broadcast(nodes) if depth <= BROADCAST_DEPTH else nodes
        arrived = travellers.join(side, "run").where(near & onward).select("fp", "rank", "node", "leaf")
        arrived.write.parquet(f"{at}/arrived-{depth}")
        arrived = spark.read.schema("fp long, rank long, node long, leaf boolean").parquet(f"{at}/arrived-{depth}")
        housed = open_members.select(
            F.col("fp").alias("other"), F.col("rank").alias("other_rank"), _run(F.col("rank"), depth).alias("node")
        )
        met = arrived.where("leaf").join(housed, "node")
        later = _unsigned(F.col("rank")) < _unsigned(F.col("other_rank"))
        close = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= limit
        met.where(later & close).select(F.col("fp").alias("u"), F.col("other").alias("v")).write.parquet(
            f"{at}/pairs-{depth}"
        )
        depths.append(depth)
        here, left = nodes.agg(F.sum("n"), F.sum(F.when(~F.col("leaf"), F.col("n")))).first()
        if not left:
            break
        everyone = everyone or here
        large = nodes.where("NOT leaf").select("node")
        still = F.broadcast(large) if depth <= BROADCAST_DEPTH else large
        open_members = (
            members.withColumn("node", _run(F.col("rank"), depth)).join(still, "node", "left_semi").drop("node")
        )
        travellers = arrived.where("NOT leaf").select("fp", "rank", F.col("node").alias("run"))
        step = min(STEP if 4 * left > everyone else LONG_STEP, DEEPEST - depth)
    return spark.read.schema("u long, v long").parquet(*[f"{at}/pairs-{d}" for d in depths])
