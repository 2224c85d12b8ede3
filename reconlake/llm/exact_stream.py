"""Exact deduplication by keyed streaming state on disk.

Two streams, both resumable from their checkpoints in the shared folder:

1. documents -> one short row each: digest of the normalised text, id, length, and a locator (file and
   row in it), appended to a Parquet sink;
2. those rows -> a grouping by digest with state in RocksDB, without watermark or expiry. Per digest it
   retains the number of rows and the identifier and locator of the row that stays.

New files continue both streams. Partial aggregation before the shuffle leaves one row per digest and
task, so a text that a third of all rows share is no hot key. Afterwards the full bytes of all rows whose
digest was hit are compared; should they differ, the digest's rows are grouped by their bytes instead. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reconlake.session import scratch_path

_SPACE = " \t\n\x0b\x0c\r"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_SETTINGS = {
    _PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # many small stores: reserve no disk in advance
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Files are taken in however old they are (Spark passes over those a week older than the newest seen).
MOST_FILE_AGE = "36500d"
#: Bits that mark the rows whose bytes are compared, at most.
MOST_BITS = 1 << 28


def normalised(text: Column) -> Column:
    """The text without space and U+0009 to U+000D; NULL is empty."""
    return F.translate(F.coalesce(text, F.lit("")), _SPACE, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _row_hash() -> Column:
    return F.xxhash64("file", "row")


def _as_pattern(path: str) -> str:
    """The same path as a pattern: a file stream takes a single file only in that form."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in _SETTINGS}
    try:
        for key, value in _SETTINGS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class ExactDedup:
    """State and short rows of a folder of Parquet documents, below ``at``.

    Defined cases: a NULL text equals an empty one; of rows alike in length and id, the first by locator
    stays, so exactly one row of a group is kept; a row with a NULL id stays only if no other of
    that length has an id; an empty table gives no rows; other columns are not read.
    """

    def __init__(
        self,
        spark: SparkSession,
        documents: str,
        at: str | None = None,
        schema: T.StructType | None = None,
        digest: Callable[[Column], Column] = sha256,
        text: str = "text",
        id_column: str = "doc_id",
        bytes_per_trigger: int = 64 << 30,
    ):
        self.spark, self.documents, self.digest = spark, documents, digest
        self.at = at or scratch_path(spark, "exact")
        self.schema = schema or spark.read.parquet(documents).schema
        self.text, self.id_column, self.bytes_per_trigger = text, id_column, bytes_per_trigger
        self.id_type = self.schema[id_column].dataType

    def _located(self, docs: DataFrame, *columns: Column) -> DataFrame:
        return docs.select(
            F.col(f"`{self.id_column}`").alias("doc_id"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
            *columns,
        )

    def _drain(self, stream: DataFrame, kind: str, mode: str, name: str, **options: str) -> None:
        writer = stream.writeStream.format(kind).outputMode(mode)
        writer = writer.option("checkpointLocation", f"{self.at}/{name}-checkpoint").options(**options)
        writer.trigger(availableNow=True).start().awaitTermination()

    def advance(self) -> ExactDedup:
        """Takes in all files that were not seen before."""
        text = F.col(f"`{self.text}`")
        clean = normalised(text)
        source = self.spark.readStream.schema(self.schema)
        source = source.option("maxBytesPerTrigger", str(self.bytes_per_trigger)).option("maxFileAge", MOST_FILE_AGE)
        short = self._located(
            source.parquet(_as_pattern(self.documents)),
            self.digest(clean).alias("digest"),
            F.coalesce(F.char_length(text), F.lit(0)).alias("points"),
        )
        self._drain(short, "parquet", "append", "rows", path=f"{self.at}/rows")
        rows = self.spark.readStream.schema(self.rows().schema).option("maxFileAge", MOST_FILE_AGE).parquet(f"{self.at}/rows")
        first = F.min(
            F.struct(
                (-F.col("points")).alias("longest"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file", "row"
            )
        )
        state = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), first.alias("stays"))
        with _state_on_disk(self.spark):
            self._drain(state, "noop", "update", "state")
        return self

    def rows(self) -> DataFrame:
        """One short row per document taken in so far."""
        schema = T.StructType(
            [
                T.StructField("doc_id", self.id_type),
                T.StructField("file", T.StringType()),
                T.StructField("row", T.LongType()),
                T.StructField("digest", T.BinaryType()),
                T.StructField("points", T.IntegerType()),
            ]
        )
        return self.spark.read.schema(schema).parquet(f"{self.at}/rows")

    def state(self) -> DataFrame:
        """digest, n and the row that stays, read from the state store."""
        stored = self.spark.read.format("statestore").load(f"{self.at}/state-checkpoint")
        return stored.select(
            F.col("key.digest").alias("digest"), F.col("value.count").alias("n"), F.col("value.min").alias("stays")
        )

    def _hits(self) -> DataFrame:
        """Bits of the rows whose digest more than one row has: bucket and a bitmap of 32,768 bits.

        The number of bits follows the number of hits up to MOST_BITS (32 MB), which bounds the broadcast.
        """
        repeated = self.rows().join(self.state().where("n > 1").select("digest"), "digest", "left_semi")
        repeated.select(_row_hash().alias("h")).write.parquet(f"{self.at}/hits")
        hits = self.spark.read.schema("h long").parquet(f"{self.at}/hits")
        bits, wanted = 1 << 15, 64 * hits.count()
        while bits < min(wanted, MOST_BITS):
            bits *= 2
        self.bits = bits
        place = F.col("h").bitwiseAND(F.lit(bits - 1))
        placed = hits.select(F.shiftright(place, 15).alias("bucket"), place.bitwiseAND(F.lit(32767)).alias("bit"))
        return placed.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))

    def _whole(self) -> DataFrame:
        docs = self.spark.read.schema(self.schema).parquet(self.documents)
        return self._located(docs, F.col(f"`{self.text}`").alias("t"))

    def _collisions(self) -> DataFrame:
        """Digests under which rows with different bytes were found.

        Texts of hits alone are moved, and per task once, however many rows have them.
        """
        bitmaps = self._hits()
        place = _row_hash().bitwiseAND(F.lit(self.bits - 1))
        rows = self._whole().withColumn("place", place)
        rows = rows.join(F.broadcast(bitmaps), F.shiftright("place", 15) == F.col("bucket"))
        bit = F.col("place").bitwiseAND(F.lit(32767)).cast("int")
        byte = F.conv(F.hex(F.substring(F.col("bitmap"), F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
        is_hit = F.call_function("shiftright", byte, bit.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1)) == 1
        clean = normalised(F.col("t"))
        whole = rows.where(is_hit).select(self.digest(clean).alias("digest"), clean.alias("clean"))
        same = whole.groupBy("digest").agg(F.min("clean").alias("a"), F.max("clean").alias("b"))
        return same.where("a != b").select("digest")

    def result(self) -> DataFrame:
        """doc_id, keep_id, group_size, kept, text_sha256 of every row taken in."""
        self._collisions().write.parquet(f"{self.at}/collisions")
        collisions = self.spark.read.schema("digest binary").parquet(f"{self.at}/collisions")
        stays = (F.col("file") == F.col("stays.file")) & (F.col("row") == F.col("stays.row"))
        found = self.rows().join(self.state(), "digest")
        columns = [
            "doc_id", F.col("stays.doc_id").alias("keep_id"), F.col("n").alias("group_size"), stays.alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        ]
        if collisions.isEmpty() and self.digest is sha256:
            return found.select(*columns)
        return self._by_bytes(found, self._whole(), collisions, columns)

    def _by_bytes(self, found: DataFrame, whole: DataFrame, collisions: DataFrame, columns: list) -> DataFrame:
        """Groups the rows of colliding digests by their bytes; the other rows stay as they are."""
        clean = normalised(F.col("t")).alias("clean")
        texts = whole.select(F.col("file").alias("h_file"), F.col("row").alias("h_row"), clean)
        same_row = (F.col("file") == F.col("h_file")) & (F.col("row") == F.col("h_row"))
        hashed = found.join(texts, same_row).drop("h_file", "h_row").withColumn("sha", sha256(F.col("clean")))
        alone = hashed.join(collisions, "digest", "left_anti")
        mixed = hashed.join(collisions, "digest", "left_semi").drop("n", "stays")
        first = F.min(
            F.struct(
                (-F.col("points")).alias("longest"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file", "row"
            )
        )
        groups = mixed.groupBy("digest", "clean").agg(F.count(F.lit(1)).alias("n"), first.alias("stays"))
        regrouped = mixed.join(groups, ["digest", "clean"])
        both = alone.drop("digest").unionByName(regrouped.drop("digest"))
        return both.withColumnRenamed("sha", "digest").select(*columns)
