"""A prefix trie of conversations from vertical bitmaps.

Conversations are dealt out by ranges of their id and cut into shards of bounded size. In a shard every
(position, turn) has a bitset of the conversations that have that turn there. The trie is walked
depth first: the bitset of a node, intersected with the posting of the turn that its lowest open member has
next, is a child; popcounts are its members, and the members that have no further turn are its
list of ends. Nodes are named by a digest that is chained over their turns, so nodes of several shards meet
by name.

Numbers over subtrees come from the shards as well, without following the merged trie downwards: a
node belongs to the shard of its smallest member, and each shard adds up along its own tree what
belongs to it (leaves, lengths) and what all its members have (lengths times members). These sums are
additive over the shards. Shards are cut from ascending ranges, so lists of ends follow one another by shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reconlake.llm import workers
from reconlake.session import scratch_path

#: Conversations and turns that a shard has at most; a longer conversation is a shard of its own, never held whole.
SHARD_CONVERSATIONS = 4096
SHARD_TURNS = 1 << 16

_ROOT = bytes(16)
_ROWS = 8192
_PARTIAL = pa.schema(
    [
        ("shard", pa.int64()), ("place", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()),
        ("depth", pa.int64()), ("first_conv", pa.int64()), ("members", pa.int64()), ("points", pa.int64()),
        ("inner", pa.bool_()), ("ends", pa.string()),
    ]
)
_PARTIAL_DDL = (
    "shard long, place long, node binary, parent binary, depth long, first_conv long, members long, points long, "
    "inner boolean, ends string"
)


def _child(node: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(node + turn, digest_size=16).digest()


def _bits(bitset: int) -> Iterator[int]:
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


def shard_nodes(ids: list[int], turns: list[list[bytes]], points: list[list[int]]) -> Iterator[tuple]:
    """The nodes of a shard in preorder, as rows of ``_PARTIAL``; ids ascend."""
    postings: dict[tuple[int, bytes], int] = {}
    ending: dict[int, int] = {}
    for number, own in enumerate(turns):
        bit = 1 << number
        for position, turn in enumerate(own):
            postings[position, turn] = postings.get((position, turn), 0) | bit
        ending[len(own)] = ending.get(len(own), 0) | bit
    place = 0
    stack = [((1 << len(ids)) - 1, 0, _ROOT, None, 0)]
    while stack:
        members, depth, node, parent, length = stack.pop()
        ended = members & ending.get(depth, 0)
        open_members, children = members ^ ended, []
        while open_members:
            lowest = (open_members & -open_members).bit_length() - 1
            turn = turns[lowest][depth]
            same = open_members & postings[depth, turn]
            children.append((same, depth + 1, _child(node, turn), node, points[lowest][depth]))
            open_members ^= same
        first = ids[(members & -members).bit_length() - 1]
        ends = ",".join([str(ids[i]) for i in _bits(ended)]) if ended else None
        yield ids[0], place, node, parent, depth, first, members.bit_count(), length, bool(children), ends
        place += 1
        stack.extend(reversed(children))


def lone_nodes(conv_id: int, turns: Iterator[tuple[bytes, int]]) -> Iterator[tuple]:
    """The chain of nodes of a conversation that is a shard of its own, turn by turn."""
    node, parent, depth, length = _ROOT, None, 0, 0
    for turn, points in turns:
        yield conv_id, depth, node, parent, depth, conv_id, 1, length, True, None
        node, parent, depth, length = _child(node, turn), node, depth + 1, points
    yield conv_id, depth, node, parent, depth, conv_id, 1, length, False, str(conv_id)


def _shards(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Nodes of all shards from rows (conv_id, turn or None, points) that come in order."""
    ids: list[int] = []
    turns: list[list[bytes]] = []
    points: list[list[int]] = []
    held = 0
    row = next(rows, None)
    while row is not None:
        conv_id = row[0]
        if ids and (len(ids) >= SHARD_CONVERSATIONS or held >= SHARD_TURNS):
            yield from shard_nodes(ids, turns, points)
            ids, turns, points, held = [], [], [], 0
        own: list[bytes] = []
        lengths: list[int] = []
        while row is not None and row[0] == conv_id and len(own) < SHARD_TURNS:
            if row[1] is not None:
                own.append(row[1])
                lengths.append(row[2])
            row = next(rows, None)
        if row is None or row[0] != conv_id:
            ids.append(conv_id)
            turns.append(own)
            points.append(lengths)
            held += len(own)
            continue
        if ids:
            yield from shard_nodes(ids, turns, points)
            ids, turns, points, held = [], [], [], 0
        after: list[tuple | None] = [row]

        def rest() -> Iterator[tuple[bytes, int]]:
            yield from zip(own, lengths)
            while after[0] is not None and after[0][0] == conv_id:
                yield after[0][1], after[0][2]
                after[0] = next(rows, None)

        yield from lone_nodes(conv_id, rest())
        row = after[0]
    if ids:
        yield from shard_nodes(ids, turns, points)


def _as_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _as_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    made = []
    for row in rows:
        made.append(row)
        if len(made) == _ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)
            made = []
    if made:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    workers.in_use("conversation_trie")
    yield from _as_batches(_shards(_as_rows(batches)), _PARTIAL)


_SUMS = pa.schema([("node", pa.binary()), ("weighted", pa.int64()), ("own", pa.int64()), ("leaves", pa.int64())])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the subtrees of each shard, from its nodes in reverse preorder."""

    def rows() -> Iterator[tuple]:
        shard, below = None, {}
        for of, depth, node, members, points, own, leaf in _as_rows(batches):
            if of != shard:
                shard, below = of, {}
            a, b, c = below.pop(depth + 1, (0, 0, 0))
            total = (a + members * points, b + (points if own else 0), c + leaf)
            a, b, c = below.get(depth, (0, 0, 0))
            below[depth] = (a + total[0], b + total[1], c + total[2])
            yield node, *total

    yield from _as_batches(rows(), _SUMS)


_ENDS = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each node's list of ends, from its pieces in order, a piece at a time."""

    def rows() -> Iterator[tuple]:
        current, digest = None, None
        for node, piece in _as_rows(batches):
            if node != current:
                if digest is not None:
                    yield current, digest.hexdigest()
                current, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
        if digest is not None:
            yield current, digest.hexdigest()

    yield from _as_batches(rows(), _ENDS)


def turn_key(role: Column, text: Column) -> Column:
    """16 bytes that name a turn; NULLs count as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, 16)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, n (from 1), turn (its key) and points (code points of its text).

    Turns are in order of ``turn``, NULL first, ties by key; rows without a conv_id belong to no conversation.
    """
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("at"),
        turn_key(F.col("role"), F.col("text")).alias("turn"),
        F.length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("points"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("at").asc_nulls_first(), "turn")
    return rows.select("conv_id", F.row_number().over(order).alias("n"), "turn", "points")


def with_shared_heads(turns: DataFrame, group: int = 100, modulus: int = 6) -> DataFrame:
    """Conversations whose first turns are those of the first one of their group.

    The first h turns, h = CRC-32 of the decimal id modulo ``modulus``, become those of conversation
    ``conv_id - conv_id % group`` (all if it has fewer, none if there is none). Every conversation has a row
    with n = 0 and without a turn as well, so that one left without turns is still there.
    """
    at = scratch_path(turns.sparkSession, "conversation-turns")
    turns.write.parquet(at)
    turns = turns.sparkSession.read.schema("conv_id long, n int, turn binary, points long").parquet(at)
    given = F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus
    every = turns.where("n = 1").select("conv_id", given.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    heads = turns.where((F.col("n") < modulus) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "base")
    given_turns = every.join(heads, "base").where("n <= h").select("conv_id", "n", "turn", "points")
    own = turns.where(F.col("n") > given)
    none = every.select("conv_id", F.lit(0).alias("n"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("points"))
    return none.unionByName(given_turns).unionByName(own)


class ConversationTrie:
    """The trie of conversations given as rows (conv_id, n, turn, points), in order of n within a conversation.

    A row with a NULL turn only says that the conversation exists. Defined cases: conversations alike share
    all their nodes; an empty table has no nodes, not even a root; a conversation with any number of
    turns is walked without holding it whole.
    """

    def __init__(self, turns: DataFrame):
        self.spark = turns.sparkSession
        workers.importable(self.spark)
        self.at = scratch_path(self.spark, "conversation-trie")
        # ranges are sampled before they are dealt out, so the turns are written first
        turns.select("conv_id", "n", "turn", "points").write.parquet(f"{self.at}/turns")
        rows = self.spark.read.schema("conv_id long, n int, turn binary, points long").parquet(f"{self.at}/turns")
        ranges = rows.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "n")
        ranges.select("conv_id", "turn", "points").mapInArrow(_partial, _PARTIAL_DDL).write.parquet(f"{self.at}/partial")
        self.partial = self.spark.read.schema(_PARTIAL_DDL).parquet(f"{self.at}/partial")
        merged = self.partial.groupBy("node", "parent", "depth", "points").agg(
            F.min("first_conv").alias("conv_id"), F.sum("members").alias("n_convs"), F.bool_or("inner").alias("inner")
        )
        merged.write.parquet(f"{self.at}/merged")
        self.merged = self.spark.read.parquet(f"{self.at}/merged")

    def nodes(self) -> DataFrame:
        """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
        saved_tokens and ends_sha256."""
        named = self.partial.join(self.merged.select("node", "conv_id", F.col("inner").alias("any_inner")), "node")
        own = F.col("first_conv") == F.col("conv_id")
        flagged = named.select(
            "shard", "depth", "node", "members", "points", own.alias("own"),
            (own & ~F.col("any_inner")).cast("long").alias("leaf"), "place",
        ).repartition("shard").sortWithinPartitions("shard", F.col("place").desc())
        sums = flagged.drop("place").mapInArrow(_sums, "node binary, weighted long, own long, leaves long")
        sums = sums.groupBy("node").agg(
            F.sum("leaves").alias("n_leaves"), (F.sum("weighted") - F.sum("own")).alias("saved_tokens")
        )
        pieces = self.partial.where("ends IS NOT NULL").select("node", "shard", "ends")
        pieces = pieces.repartition("node").sortWithinPartitions("node", "shard").select("node", "ends")
        ends = pieces.mapInArrow(_end_hashes, "node binary, ends_sha256 string")
        below = self.merged.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            F.count(F.lit(1)).alias("n_children")
        )
        # a parent with very many children is a skewed join: adaptive execution splits the children
        above = self.merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
        whole = self.merged.join(sums, "node").join(below, "node", "left").join(ends, "node", "left")
        return whole.join(above, "parent", "left").select(
            "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
