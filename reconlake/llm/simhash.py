"""SimHash near-duplicates of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reconlake.llm import workers
from reconlake.llm.components import connected_components
from reconlake.llm.filters import HashFilter
from reconlake.llm.gray_index import near_pairs
from reconlake.session import scratch_path

SHINGLE_WORDS = 3
MOST_DIFFERENCES = 2
_SEED = 42
_PIECE = 1 << 16


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """The fingerprint as a signed 64-bit number; 0 if there are no words.

    A-Z are lower-cased, words end at space and U+0009 to U+000D, and a bit is set if more than half
    of the shingles' hashes have it.
    """
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined, shingles = b" ".join(words), max(1, len(words) - width + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:shingles].tolist()
    ends = (ends[min(width, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for at in range(0, shingles, _PIECE):
        piece = zip(starts[at : at + _PIECE], ends[at : at + _PIECE])
        hashes = b"".join([digest(joined[s:e], _SEED) for s, e in piece])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > shingles).tobytes(), "big", signed=True)


@F.pandas_udf(T.LongType())
def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    workers.in_use("simhash")
    for texts in batches:
        yield pd.Series([fingerprint(t) for t in texts], dtype="int64")


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


class NearDuplicates:
    """Fingerprints, links and components of a table of documents.

    Defined cases: a NULL text is an empty one, fingerprint 0; texts without words link to each other
    and to any fingerprint within the limit; a component's id is its smallest doc_id, NULL ids aside;
    repeated rows are in one component; an empty table has no rows. Equal fingerprints are one
    node of the graph however many documents have them.
    """

    def __init__(
        self, docs: DataFrame, limit: int = MOST_DIFFERENCES, text: str = "text", id_column: str = "doc_id"
    ):
        workers.importable(docs.sparkSession)
        workers.small_batches(docs.sparkSession)
        self.docs, self.spark = docs, docs.sparkSession
        self._id, self._text = F.col(f"`{id_column}`"), F.col(f"`{text}`")
        at = scratch_path(self.spark, "simhash")
        docs.select(self._id.alias("doc_id"), self._text.alias("t")).select(
            "doc_id", _text_key(F.col("t")).alias("text_key"), _fingerprints("t").alias("fp")
        ).write.parquet(f"{at}/fingerprints")
        self.rows = self.spark.read.parquet(f"{at}/fingerprints")
        self.pairs = near_pairs(self.rows, limit, f"{at}/index")
        linked = connected_components(self.pairs, f"{at}/components")
        nodes = self.rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
        rooted = nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
        rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
        rooted.write.parquet(f"{at}/roots")
        self._roots = self.spark.read.parquet(f"{at}/roots")

    def components(self) -> DataFrame:
        """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
        ids = self._roots.groupBy("root").agg(F.min("least_id").alias("component_id"))
        of_fp = self._roots.select("fp", "root").join(ids, "root").select("fp", "component_id")
        digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
        return self.rows.join(of_fp, "fp").select("doc_id", digits, "component_id")

    def kept(self) -> DataFrame:
        """The columns of the documents, one row of each component: the one with the smallest id.

        A bounded filter of what goes, and of rows alike that would both stay, is tested where rows are read;
        only rows that it finds are moved, to the exact list of what stays.
        """
        rooted = self.rows.join(self._roots.select("fp", "root"), "fp")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key"))
        at = scratch_path(self.spark, "simhash-kept")
        chosen = rooted.groupBy("root").agg(first.alias("first"))
        chosen.select(
            F.col("first.doc_id").alias("k_id"), F.col("first.text_key").alias("k_text"), F.col("root").alias("k_root")
        ).write.parquet(f"{at}/chosen")
        keys = self.spark.read.schema("k_id long, k_text long, k_root long").parquet(f"{at}/chosen")
        mine = F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("text_key") == F.col("k_text"))
        named = rooted.groupBy("root", "doc_id", "text_key").count().join(keys, F.col("root") == F.col("k_root"))
        unsure = named.where(~mine | (F.col("count") > 1)).select(F.xxhash64("doc_id", "text_key").alias("h"))
        unsure.write.parquet(f"{at}/unsure")
        shared = self.spark.sparkContext.broadcast(HashFilter.of(self.spark.read.schema("h long").parquet(f"{at}/unsure"), "h"))

        @F.pandas_udf(T.BooleanType())
        def in_filter(hashes: pd.Series) -> pd.Series:
            return pd.Series(shared.value.might_have(hashes.to_numpy(np.int64).view(np.uint64)))

        rows = self.docs.select(F.struct("*").alias("row"), self._id.alias("r_id"), _text_key(self._text).alias("r_text"))
        rows = rows.withColumn("unsure", in_filter(F.xxhash64("r_id", "r_text")))
        same = F.col("r_id").eqNullSafe(F.col("k_id")) & (F.col("r_text") == F.col("k_text"))
        met = rows.where("unsure").join(keys, same).dropDuplicates(["k_root"])
        return rows.where("NOT unsure").select("row.*").unionByName(met.select("row.*"))
