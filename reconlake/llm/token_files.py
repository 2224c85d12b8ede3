"""Token ids in files: separately compressed documents, one shared dictionary, an offset index.

File format, a folder of three Parquet tables (so any store that Spark writes to will do, and lost
tasks are committed anew by Spark's own protocol):

``dictionary``
    one row: dictionary_hash (sha256), dictionary (zstandard; empty if there was nothing to train on),
    id_bytes (2 or 4: width of a little-endian id), end_id.
``blocks``
    one row per run of neighbouring documents: shard, block, first_id (ids of the shard before it),
    dictionary_hash, payload (the documents' frames one after the other), payload_bytes, and for each
    document doc_ids, byte_offsets and counts of ids.
``index``
    one row per document, without the payload: doc_id, shard, block, place (its rank in the block),
    byte_offset and n_bytes of its frame in the payload, n_tokens.

A document is read by its index row, one block row and the dictionary; no neighbour is decompressed.
Shards hold ascending ranges of doc_id and are sorted, so the ids of all shards, blocks and places
in order are the corpus in ascending doc_id order.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reconlake.llm import bpe, workers

#: Documents and compressed bytes of a block at most (a longer document is a block of its own).
BLOCK_DOCUMENTS = 1024
BLOCK_BYTES = 1 << 20
#: The dictionary is trained on about so many documents of at most so many bytes of text. It makes
#: short documents smaller and changes no result, so its sample is bounded.
SAMPLE_DOCUMENTS = 1000
SAMPLE_TEXT_BYTES = 16 << 10
DICTIONARY_BYTES = 64 << 10

_LEVEL = 3
_BLOCK_SCHEMA = (
    "shard int, block int, first_id long, dictionary_hash string, payload binary, payload_bytes long,"
    " doc_ids array<long>, byte_offsets array<long>, counts array<long>"
)
_READ_SCHEMA = "doc_id long, shard int, shard_start long, n_tokens long, ids_crc32 long"


def _id_type(vocabulary: bpe.Vocabulary, end_id: int) -> str:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary.tokenizer_json)
    largest = max(end_id, *tokenizer.get_vocab(with_added_tokens=True).values())
    return "<u2" if largest < 1 << 16 else "<u4"


def _dictionary(samples: list[bytes]) -> bytes:
    """A dictionary trained on the serialized ids; raw content if there is too little to train on."""
    samples = [s for s in samples if len(s) >= 16]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def _loaded(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def _sample(docs: DataFrame) -> list[str]:
    """About SAMPLE_DOCUMENTS short texts, chosen by a hash of the text, so reruns agree."""
    short = F.octet_length("whole_text").between(1, SAMPLE_TEXT_BYTES)
    rows = docs.count()
    share = min(1.0, SAMPLE_DOCUMENTS / max(rows, 1))
    chosen = F.pmod(F.xxhash64("whole_text"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    # copies of one text are chosen together: the limit bounds what reaches the driver
    found = docs.where(short & chosen).select("whole_text").limit(4 * SAMPLE_DOCUMENTS).collect()
    return sorted(r[0] for r in found)


def _named(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    return docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("whole_text"),
    )


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 0,
    text: str = "text",
    id_column: str = "doc_id",
) -> None:
    """Encodes every whole text, appends ``end_id``, and writes the files in ascending doc_id order.

    A NULL text is an empty one, that is, the end id alone. Rows with a NULL id come first.
    Repeated ids stand next to each other, ordered by text. An empty table writes empty tables.
    Texts are moved once, by range of doc_id; tokens are never shuffled. A task holds one block.
    """
    spark = docs.sparkSession
    workers.importable(spark)
    workers.small_batches(spark)
    vocabulary = bpe.load_vocabulary(tokenizer_path)
    dtype = _id_type(vocabulary, end_id)
    named = _named(docs, text, id_column)
    encode = bpe.PieceEncoder(vocabulary, bpe.id_bytes(dtype), b"".join).encode
    dictionary = _dictionary([encode(t) for t in _sample(named)])
    digest = hashlib.sha256(dictionary).hexdigest()
    head = [(digest, bytearray(dictionary), int(dtype[-1]), end_id)]
    spark.createDataFrame(
        head, "dictionary_hash string, dictionary binary, id_bytes int, end_id int"
    ).coalesce(1).write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast((vocabulary, dictionary))
    end = np.array([end_id], dtype).tobytes()
    width = int(dtype[-1])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, dictionary = shared.value
        encode = bpe.id_encoder(vocabulary, dtype).encode
        known = _loaded(dictionary)
        packer = zstandard.ZstdCompressor(level=_LEVEL, dict_data=known, write_dict_id=True)
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        ids, counts, frames, size = [], [], [], 0

        def row() -> pa.RecordBatch:
            offsets = np.cumsum([0, *map(len, frames)])[:-1].tolist()
            payload = b"".join(frames)
            made = [
                [shard], [block], [before], [digest], [payload], [len(payload)], [ids], [offsets], [counts],
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(made, _ARROW_BLOCKS)], schema=_ARROW_BLOCKS
            )

        for batch in batches:
            for doc_id, whole in zip(batch.column(0).to_pylist(), batch.column(1)):
                serialized = encode(whole.as_py()) + end
                frames.append(packer.compress(serialized))
                ids.append(doc_id)
                counts.append(len(serialized) // width)
                size += len(frames[-1])
                if size >= BLOCK_BYTES or len(frames) >= BLOCK_DOCUMENTS:
                    yield row()
                    block, before = block + 1, before + sum(counts)
                    ids, counts, frames, size = [], [], [], 0
        if frames:
            yield row()

    ordered = named.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "whole_text")
    made = ordered.mapInArrow(blocks, _BLOCK_SCHEMA)
    made.write.option("compression", "none").parquet(f"{path}/blocks")
    stored = spark.read.schema(_BLOCK_SCHEMA).parquet(f"{path}/blocks")
    each = F.posexplode(F.arrays_zip("doc_ids", "byte_offsets", "counts")).alias("place", "d")
    index = stored.select("shard", "block", "payload_bytes", "byte_offsets", each)
    following = F.coalesce(F.get("byte_offsets", F.col("place") + 1), F.col("payload_bytes"))
    index = index.select(
        F.col("d.doc_ids").alias("doc_id"), "shard", "block", "place",
        F.col("d.byte_offsets").alias("byte_offset"),
        (following - F.col("d.byte_offsets")).alias("n_bytes"),
        F.col("d.counts").alias("n_tokens"),
    )
    index.write.parquet(f"{path}/index")


_ARROW_BLOCKS = pa.schema(
    [
        ("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("dictionary_hash", pa.string()),
        ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("byte_offsets", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
    ]
)


class Frames:
    """Decompresses frames under the dictionary whose hash the files name."""

    def __init__(self, dictionary: bytes, id_bytes: int):
        self.hash = hashlib.sha256(dictionary).hexdigest()
        self.unpack = zstandard.ZstdDecompressor(dict_data=_loaded(dictionary)).decompress
        self.dtype = f"<u{id_bytes}"

    def ids(self, frame: bytes, dictionary_hash: str) -> np.ndarray:
        if dictionary_hash != self.hash:
            raise ValueError(f"written with dictionary {dictionary_hash}, not {self.hash}")
        return np.frombuffer(self.unpack(frame), self.dtype)


def _opened(spark: SparkSession, path: str) -> tuple[bytes, int]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    return bytes(row["dictionary"]), row["id_bytes"]


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone.

    ``start`` counts the ids of all documents before; shard totals are the only rows that meet in
    one task, one per written partition.
    """
    workers.importable(spark)
    workers.small_batches(spark)
    dictionary, id_bytes = _opened(spark, path)
    shared = spark.sparkContext.broadcast((dictionary, id_bytes))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = Frames(*shared.value)
        for batch in batches:
            for r in batch.to_pylist():
                ends = [*r["byte_offsets"][1:], len(r["payload"])]
                starts, crcs, at = [], [], r["first_id"]
                for begin, stop, count in zip(r["byte_offsets"], ends, r["counts"]):
                    ids = frames.ids(r["payload"][begin:stop], r["dictionary_hash"])
                    if len(ids) != count:
                        raise ValueError("a frame and the index differ in length")
                    starts.append(at)
                    crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    at += count
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(r["doc_ids"], pa.int64()),
                        "shard": pa.array([r["shard"]] * len(starts), pa.int32()),
                        "shard_start": pa.array(starts, pa.int64()),
                        "n_tokens": pa.array(r["counts"], pa.int64()),
                        "ids_crc32": pa.array(crcs, pa.int64()),
                    }
                )

    stored = spark.read.schema(_BLOCK_SCHEMA).parquet(f"{path}/blocks")
    found = stored.mapInArrow(digests, _READ_SCHEMA)
    totals = stored.groupBy("shard").agg(
        F.max(F.col("first_id") + F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n")
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return found.join(bases, "shard").select(
        "doc_id", (F.col("base") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_documents(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """doc_id and ids of the wanted doc_ids (a frame with a column doc_id), or of all documents.

    Only the frames that the index names are cut from the blocks and decompressed.
    """
    workers.importable(spark)
    workers.small_batches(spark)
    dictionary, id_bytes = _opened(spark, path)
    shared = spark.sparkContext.broadcast((dictionary, id_bytes))
    index = spark.read.parquet(f"{path}/index")
    if wanted is not None:
        index = index.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    blocks = spark.read.schema(_BLOCK_SCHEMA).parquet(f"{path}/blocks")
    frame = F.substring("payload", F.col("byte_offset") + 1, F.col("n_bytes"))
    cut = index.join(blocks.select("shard", "block", "dictionary_hash", "payload"), ["shard", "block"])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = Frames(*shared.value)
        for batch in batches:
            rows = batch.to_pylist()
            ids = [frames.ids(r["frame"], r["dictionary_hash"]) for r in rows]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()),
                    "ids": pa.array([i.tolist() for i in ids], pa.list_(pa.int64())),
                }
            )

    chosen = cut.select("doc_id", "dictionary_hash", frame.alias("frame"))
    return chosen.mapInArrow(decoded, "doc_id long, ids array<long>")
