"""Removal of repeated byte strings by distributed prefix doubling over sampled positions.

A byte goes if a string of ``THRESHOLD`` bytes over it also starts in a document with a smaller id. A plain
prefix doubling would sort every byte position of the corpus in every round. Here a position stands for
all strings that choose it: of the 8-byte grams in a string of 50 bytes the one with the least hash is its
anchor, and strings alike have the same anchor at the same place. On average 22 neighbouring strings
choose one anchor and travel as one row.

1. First round: the strings of an anchor are halved, those that begin nearer to it and those that begin farther away,
   so that the strings of a half have 29 or 30 bytes in common. (A gram of 8 or 16 bytes alone is met by chance ever more
   often as the corpus grows.) Spark sorts the halves by rank (a hash of these bytes) and by the whole stretch that their strings
   cover. Rows of a stretch that a smaller document has as well are done: all their bytes go. A rank
   that no other stretch has is unique and drops out. Within a batch of documents this happens before anything is
   shuffled, so a passage that a third of all documents have is one row per batch. The round is made in ``SHARES`` parts
   by rank, one after the other, so that no more than a part of its rows is on disk at a time.
2. What is left lies at the edges of repeated passages. There the strings are halved again, which
   makes what they have in common grow from 29 bytes to 40, 45, 48, 49 and 50. Each round sorts rows by
   a pair, the rank of the last round and the bytes at the new offset, gives new ranks, and drops rows that are
   unique or whose whole stretch is found in a smaller document. Past the threshold a row is one string. If the first
   round leaves more than a row per ``OPEN_BYTES`` bytes of text, these rounds are made in parts, too.

Bytes of the later rounds are exact. In the first round a rank is a 64-bit hash, and a stretch is known by two.
Rows are read in sorted order with a state of one group, so no group is held; texts move
only where rows are left after the first round, and where bytes go. Shuffles of a round, and the rows that it left
open, are removed as soon as the next one is written; marks stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reconlake.llm import workers
from reconlake.llm.filters import HashFilter
from reconlake.session import discard, scratch_path, shuffles_removed

THRESHOLD = 50
GRAM = 8
#: Strings that may choose one anchor, and the last of their offsets before it.
_STRINGS = THRESHOLD - GRAM + 1
_LAST = _STRINGS - 1
#: The last offset of the half that begins nearer to the anchor.
_MIDDLE = _LAST // 2
#: Parts of the first round, by rank. Each reads the texts again.
SHARES = 2
#: Bytes of text per open row of the first round for which the later rounds are made once; the halves of such a row
#: take about half of that in a shuffle.
OPEN_BYTES = 240
#: Strings looked at together; their number within a piece fits into 16 bits.
_PIECE = (1 << 16) - 64
#: Anchors that are compared with each other before they are shuffled.
_COMBINED = 1 << 20
_ROWS = 1 << 14
_LATEST = (1 << 63) - 1

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFF)
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.concatenate(([np.uint64(1)], np.full((1 << 16) + 64, _A))), dtype=np.uint64)
    _INVERSE = np.uint64(pow(int(_A), -1, 1 << 64))
    _NEGATIVE = np.cumprod(np.concatenate(([np.uint64(1)], np.full((1 << 16) + 64, _INVERSE))), dtype=np.uint64)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _C
    return values ^ (values >> np.uint64(29))


def _gram_hashes(part: np.ndarray, grams: int) -> np.ndarray:
    """The hash of the 8 bytes from each place on."""
    hashes = np.ndarray((grams,), "<u8", np.ascontiguousarray(part), strides=(1,)) * _A
    hashes ^= hashes >> np.uint64(31)
    hashes *= _B
    hashes ^= hashes >> np.uint64(32)
    hashes *= _C
    hashes ^= hashes >> np.uint64(29)
    return hashes


def anchors(data: np.ndarray, ends: np.ndarray, share: int = 0, shares: int = 1) -> Iterator[tuple[np.ndarray, ...]]:
    """Per piece of the joined texts: first and last string of each half of a group, anchor, rank and stretch.

    ``ends`` are the ends of the texts in ``data``. Neighbouring strings with one anchor are a group; strings
    do not cross the end of a text. Of all ranks those of one share are given.
    """
    for at in range(0, len(data) - THRESHOLD + 1, _PIECE):
        m = min(_PIECE, len(data) - THRESHOLD + 1 - at)
        first, last = np.searchsorted(ends, [at, at + m - 1], "right")
        own = ends[first : last + 1]
        inside = np.repeat(own, np.diff(np.concatenate(([at], np.minimum(own, at + m)))))
        ok = np.arange(at + THRESHOLD, at + m + THRESHOLD) <= inside
        if not ok.any():
            continue
        grams = m + _LAST
        hashes = _gram_hashes(data[at : at + m + THRESHOLD - 1], grams)
        least = (hashes & ~_LOW) | np.arange(grams, dtype=np.uint64)
        width = 1
        while 2 * width <= _STRINGS:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < _STRINGS:
            rest = _STRINGS - width
            least = np.minimum(least[:-rest], least[rest:])
        anchor = (least & _LOW).astype(np.int64)
        fresh = ok.copy()
        fresh[1:] &= ~ok[:-1] | (anchor[1:] != anchor[:-1])
        breaks = np.nonzero(fresh | ~ok)[0]
        begins = fresh[breaks]
        lo = breaks[begins]
        hi = np.concatenate((breaks[1:], [m]))[begins] - 1
        a = anchor[lo]
        sums = np.zeros(grams + 1, np.uint64)
        np.cumsum(hashes * _POWERS[:grams], out=sums[1:])
        halves_of = []
        for nearest, farthest in ((0, _MIDDLE), (_MIDDLE + 1, _LAST)):
            some = np.nonzero((a - hi <= farthest) & (a - lo >= nearest))[0]
            # the bytes that all strings of the half have
            begin, end = a[some] - nearest, a[some] - farthest + _STRINGS
            rank = _mixed((((sums[end] - sums[begin]) * _NEGATIVE[begin]) ^ np.uint64(nearest)) + _B)
            if shares > 1:
                mine = (rank >> np.uint64(40)) % np.uint64(shares) == np.uint64(share)
                some, rank = some[mine], rank[mine]
            halves_of.append((np.maximum(lo[some], a[some] - farthest), np.minimum(hi[some], a[some] - nearest), a[some], rank))
        lo, hi, a, rank = (np.concatenate(c) for c in zip(*halves_of))
        stretch = (sums[hi + _STRINGS] - sums[lo]) * _NEGATIVE[lo]
        shape = ((a - lo) * 64 + (hi - lo)).astype(np.uint64)
        yield lo + at, hi + at, a + at, rank, _mixed((stretch ^ (shape * _B)) + _A)


# a mark has the end of its bytes in "core" and no stretch; "place" is the 21 bits of the tag, the 31 of the first string and the 12 of the shape
_ANCHOR = pa.schema([("core", pa.int64()), ("stretch", pa.int64()), ("doc", pa.int64()), ("place", pa.int64())])
_ANCHOR_DDL = "core long, stretch long, doc long, place long"
_FOUND = pa.schema(
    [
        ("doc", pa.int64()), ("tag", pa.int32()), ("lo", pa.int32()), ("end", pa.int32()),
        ("offset", pa.int32()), ("node", pa.int32()), ("bytes", pa.binary()), ("rank", pa.int64()),
    ]
)
_MARKS_DDL = "doc long, tag int, lo int, end int"
_FOUND_DDL = "doc long, tag int, lo int, end int, offset int, node int, bytes binary, rank long"
_PAIR = pa.schema(
    [
        ("doc", pa.int64()), ("tag", pa.int32()), ("lo", pa.int32()), ("end", pa.int32()),
        ("offset", pa.int32()), ("node", pa.int32()), ("bytes", pa.binary()), ("rank", pa.int64()), ("next", pa.binary()),
    ]
)
_PAIR_DDL = "doc long, tag int, lo int, end int, offset int, node int, bytes binary, rank long, next binary"
#: Bytes of the longest stretch after the first round, and of the longest step from one round to the next.
_LONGEST, _LONGEST_STEP = THRESHOLD + _MIDDLE, _MIDDLE // 2 + 1


def _placed(tag: np.ndarray, lo: np.ndarray, shape: np.ndarray) -> np.ndarray:
    return (tag.astype(np.int64) << 43) | (lo.astype(np.int64) << 12) | shape


def _place(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tag, first string and shape."""
    return place.view(np.uint64) >> np.uint64(43), (place >> 12) & 0x7FFFFFFF, place & 0xFFF


def _combined(rank: np.ndarray, stretch: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Rows of a batch; one whose stretch a smaller document of the batch has becomes a mark."""
    # rows that agree with another one in most bits of both hashes are few
    key = rank ^ (stretch * _A)
    bits = np.uint64((1 << max(1, len(key) - 1).bit_length()) - 1)
    quick = np.sort((key & ~bits) | np.arange(len(key), dtype=np.uint64))
    alike = (quick[1:] ^ quick[:-1]) <= bits
    near = np.zeros(len(key), bool)
    near[1:] = alike
    near[:-1] |= alike
    some = (quick[near] & bits).astype(np.int64)
    later = np.zeros(len(key), bool)
    if len(some):
        order = some[np.lexsort((doc[some], key[some]))]
        r, s, d = rank[order], stretch[order], doc[order]
        new = np.ones(len(order), bool)
        new[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1])
        later[order] = d > d[new][np.cumsum(new) - 1]
    marks = np.nonzero(later)[0]
    tag, lo, shape = _place(place[marks])
    end = lo + (shape & 63) + THRESHOLD
    # marks of a document that touch are one; their ends are in the order of their beginnings
    if len(marks):
        by = np.lexsort((lo, tag, doc[marks]))
        marks, tag, lo, end = marks[by], tag[by], lo[by], end[by]
        same = (doc[marks][1:] == doc[marks][:-1]) & (tag[1:] == tag[:-1]) & (lo[1:] <= end[:-1])
        end = end[np.concatenate((~same, [True]))]
        marks = marks[np.concatenate(([True], ~same))]
    kept = np.nonzero(~later)[0]
    rows = np.concatenate((kept, marks))
    core = np.concatenate((rank[kept].view(np.int64), end.astype(np.int64)))
    known = np.concatenate((np.zeros(len(kept), bool), np.ones(len(marks), bool)))
    return pa.RecordBatch.from_arrays(
        [pa.array(core), pa.array(stretch[rows].view(np.int64), mask=known), pa.array(doc[rows]), pa.array(place[rows])], schema=_ANCHOR
    )


def _anchored(share: int, shares: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    workers.in_use("suffix_doubling")
    held: list[tuple[np.ndarray, ...]] = []
    count = 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        tags = batch.column(1).to_numpy(zero_copy_only=False)
        texts = batch.column(2).cast(pa.large_binary())
        if not len(texts):
            continue
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        for lo, hi, a, rank, stretch in anchors(data, offsets[1:], share, shares):
            row = np.searchsorted(offsets[1:], lo, "right")
            held.append((rank, stretch, ids[row], _placed(tags[row], lo - offsets[row], (a - lo) * 64 + (hi - lo))))
            count += len(lo)
            if count >= _COMBINED:
                yield _combined(*(np.concatenate(c) for c in zip(*held)))
                held, count = [], 0
    if held:
        yield _combined(*(np.concatenate(c) for c in zip(*held)))


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _content(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column and where each value begins, and the last ends."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), at


def _slices(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> pa.Array:
    """A binary column of the given slices."""
    ends = np.concatenate(([0], np.cumsum(length)))
    values = data[np.repeat(begin - ends[:-1], length) + np.arange(ends[-1])]
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(begin), buffers)


def _padded(column: pa.Array, width: int) -> np.ndarray:
    """One row per value: its bytes, zeros, and its length."""
    data, at = _content(column)
    length = np.diff(at)
    rows = np.zeros((len(length), width + 1), np.uint8)
    rows[:, -1] = length
    place = np.arange(width)
    there = place < length[:, None]
    rows[:, :width][there] = data[(at[:-1, None] + place)[there]]
    return rows


class Groups:
    """Reads rows sorted by (pair, stretch, doc) batch by batch; a state of one pair is carried along.

    Rows with one pair get one new rank. Those of a stretch that a smaller document has become marks (without an
    offset). Others stay open if their pair has a second stretch in another document, and drop out otherwise;
    until that is known they are held, which only one document's rows can be.
    """

    def __init__(self, share: int = 0, shares: int = 1) -> None:
        task = TaskContext.get()
        self.rank = ((task.partitionId() if task else 0) * shares + share) << 40
        self.least = self.first_doc = None
        self.classes, self.differs = 0, False
        self.held: list[pa.RecordBatch] = []

    def read(self, rows: pa.RecordBatch, new_pair: np.ndarray, new_stretch: np.ndarray) -> Iterator[pa.RecordBatch]:
        """``rows`` are the columns of ``_FOUND`` but for the rank; the flags compare each row with the one before."""
        doc = _numbers(rows.column(0))
        new_stretch = new_stretch | new_pair
        pair = np.cumsum(new_pair)
        pairs = int(pair[-1]) + 1
        least = np.concatenate(([self.least if self.least is not None else 0], doc[new_stretch]))[np.cumsum(new_stretch)]
        marks = doc > least
        classes = np.bincount(pair[new_stretch], minlength=pairs)
        classes[0] += self.classes
        first_doc = np.concatenate(([self.first_doc if self.first_doc is not None else 0], doc[new_pair]))
        differs = np.bincount(pair, doc != first_doc[pair], pairs) > 0
        differs[0] |= self.differs
        shared = (classes > 1) & differs
        if shared[0] and self.held:
            yield from self.held
        if shared[0] or pairs > 1:
            self.held = []
        rank = pa.array(self.rank + pair)
        open_rows = ~marks & shared[pair]
        waiting = ~marks & ~shared[pair] & (pair == pairs - 1)
        whole = pa.RecordBatch.from_arrays([*rows.columns, rank], schema=_FOUND)
        if open_rows.any():
            yield whole.filter(pa.array(open_rows))
        if waiting.any():
            self.held.append(whole.filter(pa.array(waiting)))
        if marks.any():
            yield _marks(*(c.filter(pa.array(marks)) for c in rows.columns[:4]))
        self.rank += pairs - 1
        self.least, self.first_doc = int(least[-1]), int(first_doc[-1])
        self.classes, self.differs = int(classes[-1]), bool(differs[-1])


def _marks(doc: pa.Array, tag: pa.Array, lo: pa.Array, end: pa.Array) -> pa.RecordBatch:
    none = [pa.nulls(len(doc), f.type) for f in list(_FOUND)[4:]]
    return pa.RecordBatch.from_arrays([doc, tag, lo, end, *none], schema=_FOUND)


def _first_round(share: int, shares: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    workers.in_use("suffix_doubling")
    groups, before = Groups(share, shares), None
    for batch in batches:
        known = batch.column(1).is_null()
        already = batch.filter(known)
        if len(already):
            tag, lo, _ = _place(_numbers(already.column(3)))
            yield _marks(already.column(2), pa.array(tag.astype(np.int32)), pa.array(lo.astype(np.int32)), already.column(0).cast(pa.int32()))
        batch = batch.filter(pa.compute.invert(known))
        if not len(batch):
            continue
        core, stretch, _, place = (_numbers(c) for c in batch.columns)
        tag, lo, shape = _place(place)
        new_pair, new_stretch = np.ones(len(core), bool), np.ones(len(core), bool)
        new_pair[1:] = core[1:] != core[:-1]
        new_stretch[1:] = stretch[1:] != stretch[:-1]
        if before is not None:
            new_pair[0], new_stretch[0] = core[0] != before[0], stretch[0] != before[1]
        before = core[-1], stretch[-1]
        offset = shape >> 6
        node = np.where(offset > _MIDDLE, (_MIDDLE + 1) * 64 + _LAST, _MIDDLE)
        numbers = [tag, lo, lo + (shape & 63) + THRESHOLD, offset, node]
        columns = [batch.column(2), *(pa.array(c.astype(np.int32)) for c in numbers), pa.nulls(len(core), pa.binary())]
        yield from groups.read(pa.RecordBatch.from_arrays(columns, names=_FOUND.names[:-1]), new_pair, new_stretch)


def halves(
    data: np.ndarray, begin: np.ndarray, doc: np.ndarray, tag: np.ndarray, lo: np.ndarray, end: np.ndarray,
    offset: np.ndarray, node: np.ndarray, rank: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    """Rows of ``_PAIR`` for the two halves of the offsets that a row stands for, as far as it has strings there.

    ``node`` is 64 times the first offset of the row's group plus the last; its bytes begin at ``begin`` in ``data``.
    """
    least_offset = offset - (end - THRESHOLD - lo)
    low, high = node >> 6, node & 63
    middle = (low + high) // 2
    for side, first, last in ((0, low, middle), (1, middle + 1, high)):
        a, b = np.maximum(first, least_offset), np.minimum(last, offset)
        some = np.nonzero((a <= b) & (low < high))[0]
        if not len(some):
            continue
        a, b = a[some], b[some]
        skipped, length = offset[some] - b, b - a + THRESHOLD
        at = begin[some]
        # what the strings have in common grows to the right in the lower half, to the left in the upper
        if side:
            step_at, step = at + offset[some] - middle[some] - 1, middle[some] + 1 - low[some]
        else:
            step_at, step = at + offset[some] - high[some] + THRESHOLD, high[some] - middle[some]
        start = lo[some] + skipped
        numbers = [
            doc[some], tag[some].astype(np.int32), start.astype(np.int32), (start + length).astype(np.int32),
            b.astype(np.int32), (first[some] * 64 + last[some]).astype(np.int32),
        ]
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(c) for c in numbers), _slices(data, at + skipped, length),
                pa.array(2 * rank[some] + side), _slices(data, step_at, step),
            ],
            schema=_PAIR,
        )


def _halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            doc, tag, lo, end, offset, node = (_numbers(c) for c in batch.columns[:6])
            data, at = _content(batch.column(6))
            yield from halves(data, at[:-1], doc, tag, lo, end, offset, node, _numbers(batch.column(7)))


def _cut_and_halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Halves of the open rows of the first round, with their bytes from the text."""
    for batch in batches:
        if not len(batch):
            continue
        data, at = _content(batch.column(2))
        items = batch.column(3)
        row = np.repeat(np.arange(len(batch)), _numbers(pa.compute.list_value_length(items)))
        lo, end, offset, rank, node = (_numbers(c) for c in items.flatten().flatten())
        for few in range(0, len(row), _ROWS):
            part = slice(few, few + _ROWS)
            of = row[part]
            doc, tag = _numbers(batch.column(0))[of], _numbers(batch.column(1))[of]
            yield from halves(data, at[:-1][of] + lo[part], doc, tag, lo[part], end[part], offset[part], node[part], rank[part])


def _next_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups, before = Groups(), None
    for batch in batches:
        for few in range(0, len(batch), _ROWS):
            part = batch.slice(few, _ROWS)
            rank, offset = _numbers(part.column(7)), _numbers(part.column(4))
            step, content = _padded(part.column(8), _LONGEST_STEP), _padded(part.column(6), _LONGEST)
            keys = (rank, step, offset, content)
            if before is None:
                before = tuple(k[:1] for k in keys)
                first = True
            else:
                first = False
            rank, step, offset, content = (np.concatenate((b, k)) for b, k in zip(before, keys))
            new_pair = (rank[1:] != rank[:-1]) | (step[1:] != step[:-1]).any(axis=1)
            new_stretch = (offset[1:] != offset[:-1]) | (content[1:] != content[:-1]).any(axis=1)
            if first:
                new_pair[0] = True
            before = tuple(k[-1:] for k in keys)
            rows = pa.RecordBatch.from_arrays(part.columns[:7], names=_FOUND.names[:-1])
            yield from groups.read(rows, new_pair, new_stretch)


def without(text: bytes, marks: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The bytes outside of all marks, the number of bytes that went, and of the runs they made."""
    kept, at, spans, open_end = [], 0, 0, -1
    for lo, end in sorted(marks):
        if lo > open_end:
            kept.append(text[at:lo])
            spans += 1
        open_end = max(open_end, end)
        at = open_end
    kept.append(text[at:])
    left = b"".join(kept)
    return left, len(text) - len(left), spans


class RepeatedBytes:
    """Bytes of a table of documents that lie in strings which a document with a smaller id has, too.

    Defined cases: a NULL text counts as empty; a text shorter than the threshold loses nothing; a NULL
    doc_id counts as the greatest; rows of one doc_id take nothing from each other (they are told apart by 21
    bits of their text's hash); repeated rows get equal results; an empty table gives no rows. Strings are
    judged on the input and may begin or end inside of a character, so what is left is binary.
    """

    def __init__(self, docs: DataFrame, text: str = "text", id_column: str = "doc_id"):
        self.spark = docs.sparkSession
        workers.importable(self.spark)
        self.at = scratch_path(self.spark, "suffix-doubling")
        content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
        doc_id = F.col(f"`{id_column}`").cast("long")
        self.rows = docs.select(
            doc_id.alias("doc_id"),
            F.coalesce(doc_id, F.lit(_LATEST)).alias("doc"),
            F.shiftrightunsigned(F.xxhash64(content), 43).cast("int").alias("tag"),
            content.cast("binary").alias("content"),
        )
        texts = self.rows.select("doc", "tag", "content")
        with shuffles_removed(self.spark):
            found = []
            for share in range(SHARES):
                sampled = texts.mapInArrow(partial(_anchored, share, SHARES), _ANCHOR_DDL)
                ranked = sampled.repartition("core").sortWithinPartitions("core", "stretch", "doc")
                found.append(self._write(ranked.mapInArrow(partial(_first_round, share, SHARES), _FOUND_DDL), f"round-0-{share}"))
            open_rows = self._read(_FOUND_DDL, *found).where("offset IS NOT NULL")
            size = self.rows.agg(F.sum(F.octet_length("content"))).first()[0] or 1
            parts = 1 + open_rows.count() * OPEN_BYTES // size
            done = []
            for part in range(parts):
                done += self._later_rounds(open_rows.where(F.col("rank") % parts == part), f"-{part}")
            done.append(self._marks_of(found, "marks"))
        #: One row per removed stretch of bytes; stretches may overlap.
        self.marks = self._read(_MARKS_DDL, *done)

    def _later_rounds(self, left: DataFrame, part: str) -> list[str]:
        """What is left after the first round, or a part of its ranks; gives the names of the marks made."""
        items = F.collect_list(F.struct("lo", "end", "offset", "rank", "node")).alias("items")
        texts = self._texts(left.groupBy("doc", "tag").agg(items))
        pairs = texts.select("doc", "tag", "content", "items").mapInArrow(_cut_and_halved, _PAIR_DDL)
        strings, found, done = _MIDDLE + 1, None, []
        while strings > 1:
            strings = (strings + 1) // 2
            ranked = pairs.repartition("rank", "next").sortWithinPartitions("rank", "next", "offset", "bytes", "doc")
            fresh = self._write(ranked.mapInArrow(_next_round, _FOUND_DDL), f"round-{strings}{part}")
            if found:
                done.append(self._marks_of([found], f"marks-{len(done)}{part}"))
            found = fresh
            pairs = self._read(_FOUND_DDL, found).where("offset IS NOT NULL").mapInArrow(_halved, _PAIR_DDL)
        return [*done, self._marks_of([found], f"marks-{len(done)}{part}")]

    def _write(self, rows: DataFrame, name: str) -> str:
        rows.write.parquet(f"{self.at}/{name}")
        return name

    def _read(self, ddl: str, *names: str) -> DataFrame:
        return self.spark.read.schema(ddl).parquet(*[f"{self.at}/{name}" for name in names])

    def _marks_of(self, found: list[str], name: str) -> str:
        """The marks of a round whose open rows have been read; the round itself is deleted."""
        self._write(self._read(_FOUND_DDL, *found).where("offset IS NULL").select("doc", "tag", "lo", "end"), name)
        for made in found:
            discard(self.spark, f"{self.at}/{made}")
        return name

    def _touched(self, few: DataFrame):
        """A test on "doc" that holds for all rows of ``few``, and for few others."""
        shared = self.spark.sparkContext.broadcast(HashFilter.of(few.select("doc").distinct().select(F.xxhash64("doc").alias("h")), "h"))

        @F.pandas_udf("boolean")
        def touched(hashes):
            return type(hashes)(shared.value.might_have(hashes.to_numpy(np.int64).view(np.uint64)))

        return touched(F.xxhash64("doc"))

    def _texts(self, few: DataFrame) -> DataFrame:
        """``few`` with the texts of its documents; other documents stay where they are read."""
        texts = self.rows.where(self._touched(few)).select("doc", "tag", "content").dropDuplicates(["doc", "tag"])
        return texts.join(few, ["doc", "tag"])

    def report(self) -> DataFrame:
        """doc_id, n_bytes, n_removed, n_spans and the bytes that are left (``kept``) of every row."""
        # both ends of a stretch in one number
        span = F.shiftleft(F.col("lo").cast("long"), 32).bitwiseOR(F.col("end").cast("long"))
        lists = self.marks.groupBy("doc", "tag").agg(F.collect_list(span).alias("marks"))

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made, size = [], 0
                for doc_id, text, marks in zip(*batch.columns):
                    text = text.as_py()
                    spans = [(m >> 32, m & 0xFFFFFFFF) for m in marks.as_py() or ()]
                    left, removed, n = without(text, spans)
                    made.append((doc_id.as_py(), len(text), removed, n, left))
                    size += len(left)
                    if size > 1 << 24:
                        yield as_batch(made)
                        made, size = [], 0
                if made:
                    yield as_batch(made)

        def as_batch(made: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), kept)], schema=kept)

        kept = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
        with shuffles_removed(self.spark):
            rows = self.rows.withColumn("touched", self._touched(lists))
        met = rows.where("touched").join(lists, ["doc", "tag"], "left").select("doc_id", "content", "marks")
        met = met.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
        none = F.lit(0).cast("long")
        rest = rows.where("NOT touched").select(
            "doc_id", F.octet_length("content").cast("long").alias("n_bytes"), none.alias("n_removed"),
            none.alias("n_spans"), F.col("content").alias("kept"),
        )
        return met.unionByName(rest)
