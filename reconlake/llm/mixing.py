"""Mixing sources to target weights by Pareto order sampling.

Each source owes a target number of words. Whole copies that every document of the source is due
are certain; for the fraction that is left, documents are ranked by their random odds divided by
their inclusion odds, and taken in that order until the words owed are there. The random odds come
from a hash of the id, so reruns agree.

Only DataFrame functions are used. No task ever sorts a source: words are summed per source and
bucket of the rank, a running sum over the buckets finds the one in which the source's words end, and
only that bucket's rows are ordered. What decides is one short row per source, so documents are
filtered where they are read and texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reconlake.session import scratch_path

#: Buckets of the rank per source: the rows that one task orders are a source's share of one bucket.
RANK_BUCKETS = 1 << 14

_SPACE = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D; 0 for NULL."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    words = F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    return F.when(trimmed == "", 0).otherwise(words).cast("long")


def random_share(doc_id: Column, seed: int) -> Column:
    """A number between 0 and 1, both excluded, from a hash of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double")
    return (digits + 0.5) / float(1 << 48)


def targets(
    sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """Targets per source, from rows (source, source_size).

    Sources in code point order, NULL last, weigh ``weights``, repeating, and share ``share`` times all
    words. A target stops at ``most`` times the source's size; the excess is shared again by weight
    until no target is above. Sources in the order of size by weight fill up one after the other,
    so two running sums over the sources (one row each) give the level at which the rest stands.
    """
    ranked = sizes.withColumn(
        "place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weighed = ranked.withColumn("weight", F.get(listed, F.col("place") % len(weights)))
    full = (F.lit(float(most)) * F.col("source_size")).alias("full")
    order = Window.orderBy((F.col("full") / F.col("weight")).asc(), F.col("place"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    summed = weighed.withColumn("full", full).select(
        "source", "source_size", "full", "weight",
        (F.lit(float(share)) * F.sum("source_size").over(everything)).alias("total"),
        F.coalesce(F.sum("full").over(before), F.lit(0.0)).alias("full_before"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("rest"),
    )
    level = (F.col("total") - F.col("full_before")) / F.col("rest")
    levelled = summed.withColumn("level", level).withColumn(
        "filled", F.col("full") <= F.col("weight") * F.col("level")
    )
    rest = F.max(F.when(~F.col("filled"), F.col("level"))).over(everything)
    return levelled.withColumn("rest_level", rest).select(
        "source",
        "source_size",
        F.when(F.col("filled"), F.col("full")).otherwise(F.col("weight") * F.col("rest_level")).alias("target"),
    )


def _rank(share: Column, fraction: Column, odds: Column) -> Column:
    """NULL where nothing is left to draw."""
    return F.try_divide(share / (1 - share), odds * (fraction / (1 - fraction)))


def _bucket(rank: Column) -> Column:
    return F.floor(rank / (1 + rank) * RANK_BUCKETS).cast("int")


def _decided(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Adds ``copies`` to rows with s_source, s_id, s_bytes and s_odds, by the plan of their sources."""
    named = plan.select(*[F.col(c).alias(f"p_{c}") for c in plan.columns])
    joined = rows.join(named, F.col("s_source").eqNullSafe(F.col("p_source")), "left")
    rank = _rank(random_share(F.col("s_id"), seed), F.col("p_fraction"), F.col("s_odds"))
    key = F.struct(rank.alias("rank"), F.col("s_id").alias("id"), F.col("s_bytes").alias("bytes"))
    extra = F.col("p_cut").isNotNull() & (
        (_bucket(rank) < F.col("p_cut_bucket"))
        | ((_bucket(rank) == F.col("p_cut_bucket")) & (key <= F.col("p_cut")))
    )
    copies = F.coalesce(F.col("p_whole"), F.lit(0)) + F.when(F.coalesce(extra, F.lit(False)), 1).otherwise(0)
    return joined.withColumn("copies", copies.cast("int"))


class Mix:
    """The plan of a mix: per source its size, target, certain copies, and the rank where it stops.

    ``odds`` is an optional column of positive relative odds; without it documents of one source are
    as likely as each other, and sources differ. Defined cases: a NULL or empty text has size 0 and
    adds no words; NULL sources are one source of their own; rows alike in id and length are
    taken or left together; an empty table gives an empty mix; NULL odds count as 1.
    """

    def __init__(
        self,
        docs: DataFrame,
        weights: Sequence[float] = (3, 1, 2),
        share: float = 1.5,
        most: float = 2.0,
        seed: int = 17,
        source: str = "source",
        text: str = "text",
        id_column: str = "doc_id",
        odds: str | None = None,
    ):
        self.docs, self.seed = docs, seed
        spark = docs.sparkSession
        self._text = F.col(f"`{text}`")
        self._keys = [
            F.col(f"`{source}`").alias("s_source"),
            F.col(f"`{id_column}`").alias("s_id"),
            F.coalesce(F.octet_length(self._text), F.lit(0)).alias("s_bytes"),
            (F.coalesce(F.col(f"`{odds}`").cast("double"), F.lit(1.0)) if odds else F.lit(1.0)).alias("s_odds"),
        ]
        at = scratch_path(spark, "mix")
        docs.select(*self._keys, word_count(self._text).alias("size")).write.parquet(f"{at}/sizes")
        self.sizes = spark.read.parquet(f"{at}/sizes")
        per_source = self.sizes.groupBy(F.col("s_source").alias("source")).agg(
            F.sum("size").alias("source_size")
        )
        ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        shares = targets(per_source, weights, share, most).withColumn("ratio", ratio)
        shares = shares.withColumn("whole", F.floor("ratio").cast("int")).select(
            "source", "source_size", "target", "whole",
            (F.col("ratio") - F.col("whole")).alias("fraction"),
            (F.col("target") - F.col("whole") * F.col("source_size")).alias("owed"),
        )
        shares.coalesce(1).write.parquet(f"{at}/shares")
        shares = spark.read.parquet(f"{at}/shares")
        cuts = self._cuts(shares).withColumnRenamed("source", "c_source")
        plan = shares.join(cuts, F.col("source").eqNullSafe(F.col("c_source")), "left").drop("c_source")
        plan.coalesce(1).write.parquet(f"{at}/plan")
        self.plan = spark.read.parquet(f"{at}/plan")

    def _cuts(self, shares: DataFrame) -> DataFrame:
        """Per source with a fraction owed, the last bucket and rank that are taken."""
        owing = shares.where("fraction > 0").select(
            F.col("source").alias("p_source"), F.col("fraction").alias("p_fraction"), "owed"
        )
        rank = _rank(random_share(F.col("s_id"), self.seed), F.col("p_fraction"), F.col("s_odds"))
        ranked = (
            self.sizes.join(owing, F.col("s_source").eqNullSafe(F.col("p_source")))
            .withColumn("rank", rank)
            .withColumn("bucket", _bucket(F.col("rank")))
        )
        sums = ranked.groupBy("s_source", "owed", "bucket").agg(F.sum("size").alias("words"))
        running = Window.partitionBy("s_source").orderBy("bucket")
        earlier = running.rowsBetween(Window.unboundedPreceding, -1)
        begun = sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        # the last bucket that begins below what is owed; all rows of earlier buckets are taken
        ends = (
            begun.where("before < owed")
            .groupBy(F.col("s_source").alias("e_source"))
            .agg(F.max("bucket").alias("e_bucket"), F.max("before").alias("e_before"))
        )
        last = ranked.join(
            ends, F.col("s_source").eqNullSafe(F.col("e_source")) & (F.col("bucket") == F.col("e_bucket"))
        )
        in_order = Window.partitionBy("s_source").orderBy("rank", "s_id", "s_bytes")
        so_far = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
        taken = last.withColumn("so_far", F.col("e_before") + so_far).withColumn(
            "taken", F.col("so_far") - F.col("size") / 2 < F.col("owed")
        )
        key = F.struct("rank", F.col("s_id").alias("id"), F.col("s_bytes").alias("bytes"))
        none_taken = F.struct(
            F.lit(-1.0).alias("rank"),
            F.lit(None).cast(self.sizes.schema["s_id"].dataType).alias("id"),
            F.lit(0).alias("bytes"),
        )
        return taken.groupBy(F.col("s_source").alias("source")).agg(
            F.max("bucket").alias("cut_bucket"),
            F.coalesce(F.max(F.when(F.col("taken"), key)), none_taken).alias("cut"),
        )

    def decisions(self) -> DataFrame:
        """doc_id, size, source_size, target, copies and taken (words, repeats counted) of every row."""
        return _decided(self.sizes, self.plan, self.seed).select(
            F.col("s_id").alias("doc_id"), "size", F.col("p_source_size").alias("source_size"),
            F.col("p_target").alias("target"), "copies", (F.col("size") * F.col("copies")).alias("taken"),
        )

    def documents(self) -> DataFrame:
        """The mix itself: the columns of the documents, each row as often as it is taken."""
        rows = self.docs.select(F.struct("*").alias("row"), *self._keys)
        decided = _decided(rows, self.plan, self.seed).where("copies > 0")
        repeated = decided.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
        return repeated.select("row.*")
