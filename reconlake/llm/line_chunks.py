"""Removal of repeated passages by content-defined chunks of lines.

A rolling hash over the hashes of neighbouring lines decides where a chunk ends, so chunks do not move
when lines are put in before them, and the same passage falls into the same chunks in every
document. Chunks of two lines or more that occur again anywhere in the corpus are removed
except for their first place, after their bytes were compared.

1. Every document yields one short row per chunk (digest, place); nothing of the text is moved.
2. Digests that occur again go into a filter of bounded size; chunks that pass it are written with their
   bytes and grouped by digest and bytes. Partial aggregation leaves one row per task for a passage
   that a third of all documents have.
3. Documents that may have chunks to remove (another such filter says which) meet the list of them. This
   is the one shuffle of texts; all other documents stay where they are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reconlake.llm import workers
from reconlake.llm.filters import HashFilter
from reconlake.session import scratch_path

#: Lines that the rolling hash sees, average lines of a chunk, and lines that a chunk to remove has.
ROLLING_LINES = 2
MEAN_LINES = 3
LEAST_LINES = 2

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def chunk_lines(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The lines of a text, and its chunks as (first line, line after the last)."""
    lines = text.split("\n")
    hashes = np.array([xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass")) for line in lines], np.uint64)
    rolling = hashes.copy()
    for back in range(1, min(ROLLING_LINES, len(lines))):
        rolling[back:] += hashes[:-back] * (_FACTOR ** np.uint64(back))
    mixed = (rolling ^ (rolling >> np.uint64(32))) * _FACTOR
    ends = np.nonzero((mixed >> np.uint64(40)) % np.uint64(MEAN_LINES) == 0)[0] + 1
    ends = [*ends.tolist(), *([len(lines)] if not len(ends) or ends[-1] != len(lines) else [])]
    return lines, list(zip([0, *ends[:-1]], ends))


def repeatable_chunks(text: str) -> Iterator[tuple[int, int, bytes]]:
    """Number, lines and bytes of the chunks that may be removed: of several lines, not all blank."""
    lines, chunks = chunk_lines(text)
    for number, (first, last) in enumerate(chunks):
        if last - first >= LEAST_LINES:
            joined = "\n".join(lines[first:last])
            if joined.strip():
                yield number, last - first, joined.encode("utf-8", "surrogatepass")


def without_chunks(text: str, removed: set[int]) -> tuple[str, int]:
    """The text without the numbered chunks, and the number of lines that went with them."""
    lines, chunks = chunk_lines(text)
    kept = [line for n, (a, b) in enumerate(chunks) if n not in removed for line in lines[a:b]]
    return "\n".join(kept), len(lines) - len(kept)


_CHUNK = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("chunk", pa.int32()), ("digest", pa.binary(16))])
_CHUNK_DDL = "doc_id long, text_key long, chunk int, digest binary"
_BYTES_DDL = _CHUNK_DDL + ", content binary"


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _short(digest: Column) -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 8)), 16, -10).cast("long")


class LineChunks:
    """Repeated chunks of a table of documents.

    Defined cases: a NULL text has no chunks and stays NULL; an empty one stays empty; a document of which
    every chunk is removed stays, with an empty text; the first place of a chunk is in the smallest
    doc_id (NULL last), then by hash of the text, then the first in the text; rows alike in id and text
    count as one document and are cut alike; an empty table gives no rows.
    """

    def __init__(self, docs: DataFrame, text: str = "text", id_column: str = "doc_id"):
        self.docs, self.spark, self.text = docs, docs.sparkSession, text
        self._id, self._text = F.col(f"`{id_column}`").cast("long"), F.col(f"`{text}`")
        workers.importable(self.spark)
        self.at = scratch_path(self.spark, "line-chunks")
        self._rows = docs.select(self._id.alias("doc_id"), _text_key(self._text).alias("text_key"), self._text.alias("t"))
        self._chunks().write.parquet(f"{self.at}/chunks")
        self.chunks = self.spark.read.schema(_CHUNK_DDL).parquet(f"{self.at}/chunks")
        again = self.chunks.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        again.select("digest", _short(F.col("digest")).alias("short")).write.parquet(f"{self.at}/again")
        self.again = self.spark.read.schema("digest binary, short long").parquet(f"{self.at}/again")
        self._with_bytes().write.parquet(f"{self.at}/contents")
        self.contents = self.spark.read.schema(_BYTES_DDL).parquet(f"{self.at}/contents")
        self._removals().write.parquet(f"{self.at}/removed")
        self.removed = self.spark.read.schema("doc_id long, text_key long, chunk int").parquet(f"{self.at}/removed")

    def _chunks(self) -> DataFrame:
        def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            workers.in_use("line_chunks")
            for batch in batches:
                rows = [
                    (doc_id, key, number, xxhash.xxh3_128_digest(content))
                    for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns))
                    for number, _, content in repeatable_chunks(text)
                ]
                columns = list(zip(*rows)) or [()] * len(_CHUNK)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.binary() if f.name == "digest" else f.type) for c, f in zip(columns, _CHUNK)],
                    [f.name for f in _CHUNK],
                )

        return self._rows.where("t IS NOT NULL").mapInArrow(digests, _CHUNK_DDL)

    def _with_bytes(self) -> DataFrame:
        """Chunks whose digest occurs again, with their bytes (and few others, which the join drops)."""
        shared = self.spark.sparkContext.broadcast(HashFilter.of(self.again, "short"))

        def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [
                    (doc_id, key, number, xxhash.xxh3_128_digest(content), content)
                    for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns))
                    for number, _, content in repeatable_chunks(text)
                ]
                if rows:
                    short = np.array([int.from_bytes(r[3][:8], "big") for r in rows], np.uint64)
                    rows = [r for r, may in zip(rows, shared.value.might_have(short)) if may]
                columns = list(zip(*rows)) or [()] * 5
                types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "text_key", "chunk", "digest", "content"]
                )

        return self._rows.where("t IS NOT NULL").mapInArrow(contents, _BYTES_DDL)

    def _removals(self) -> DataFrame:
        """doc_id, text_key and number of each chunk to remove."""
        place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key", "chunk")
        same = self.contents.groupBy("digest", "content").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        classes = same.groupBy("digest").agg(
            F.count(F.lit(1)).alias("classes"), F.first("first").alias("first"), F.first("last").alias("last")
        )
        classes.write.parquet(f"{self.at}/classes")
        classes = self.spark.read.parquet(f"{self.at}/classes")
        again = F.col("first") != F.col("last")
        later = ~place.eqNullSafe(F.col("first"))
        columns = ["doc_id", "text_key", "chunk"]
        places = self.contents.select(*columns, "digest")
        found = places.join(classes.where((F.col("classes") == 1) & again), "digest").where(later)
        mixed = classes.where("classes > 1").select("digest")
        if not mixed.isEmpty():
            # digests of several contents: compare by bytes
            apart = same.where(again).join(mixed, "digest", "left_semi")
            found = found.select(*columns).union(
                self.contents.join(apart, ["digest", "content"]).where(later).select(*columns)
            )
        return found.select(*columns).distinct()

    def clean(self) -> DataFrame:
        """The columns of the documents, with repeated chunks cut from the text, every row kept."""
        return self._cut().select("row.*", "cut").select(
            *[F.col("cut.text").alias(c) if c == self.text else F.col(f"`{c}`") for c in self.docs.columns]
        )

    def report(self) -> DataFrame:
        """doc_id, removed_chunks, removed_lines and the text that is left, of every row."""
        return self._cut().select("doc_id", "cut.removed_chunks", "cut.removed_lines", "cut.text")

    def _cut(self) -> DataFrame:
        lists = self.removed.groupBy(F.col("doc_id").alias("l_id"), F.col("text_key").alias("l_key")).agg(
            F.collect_list("chunk").alias("removed")
        )

        @F.pandas_udf("text string, removed_chunks int, removed_lines int")
        def cut(texts: pd.Series, removed: pd.Series) -> pd.DataFrame:
            made = []
            for whole, numbers in zip(texts, removed):
                numbers = set() if numbers is None or whole is None else set(numbers)
                left, lines = without_chunks(whole, numbers) if numbers else (whole, 0)
                made.append((left, len(numbers), lines))
            return pd.DataFrame(made, columns=["text", "removed_chunks", "removed_lines"])

        shared = self.spark.sparkContext.broadcast(HashFilter.of(self.removed.select("text_key").distinct(), "text_key"))

        @F.pandas_udf("boolean")
        def touched(keys: pd.Series) -> pd.Series:
            return pd.Series(shared.value.might_have(keys.to_numpy(np.int64).view(np.uint64)))

        rows = self.docs.select(
            F.struct("*").alias("row"), self._id.alias("doc_id"), _text_key(self._text).alias("text_key"), self._text.alias("t")
        ).withColumn("touched", touched("text_key"))
        same = F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("text_key") == F.col("l_key"))
        met = rows.where("touched").join(lists, same, "left").withColumn("cut", cut("t", "removed"))
        # a text that surely has no chunk to remove stays where it is
        none = F.lit(0)
        whole = F.struct(F.col("t").alias("text"), none.alias("removed_chunks"), none.alias("removed_lines"))
        rest = rows.where("NOT touched").withColumn("cut", whole)
        columns = ["row", "doc_id", "cut"]
        return met.select(*columns).unionByName(rest.select(*columns))
