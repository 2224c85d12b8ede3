"""Benchmark decontamination by template windows.

Words are put into canonical form: numbers, units and names become typed placeholders, other words are
lower-cased without punctuation. Windows of five words of a benchmark item are looked up in documents
twice, as they are written and as templates, so that a question asked anew with other numbers or
names is found too; what fills the placeholders must then agree: one value of the item stands for one
value in the document, and the other way round. An item is in a document if 0.8 or more of its
windows are. An item of fewer than five words is one window, compared as it is written.

A capitalised word that begins a sentence may be a name or not, so windows with such words have two
templates, one for either reading. A window of hardly any ordinary word says nothing alone: it counts
where it stands in one run with windows of the benchmark that have more.

Documents stay where they are read. Their windows are tested against a Bloom filter of the
benchmark's windows (its size has a bound, whatever the benchmark's), and only windows that may match become
rows. Pairs of document and item are found through each item's rarest windows: an item of n windows
that has 0.8 n of them in a document has at least one of its n - ceil(0.8 n) + 1 rarest there, so text that
all items share makes no pairs. The pairs found are then counted exactly, over all windows.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reconlake.llm import workers
from reconlake.llm.bpe import RecentTable
from reconlake.llm.filters import HashFilter
from reconlake.session import scratch_path

WINDOW = 5
LEAST_SHARE = 0.8
#: A template window with fewer ordinary words counts only next to others that match.
LEAST_WORDS = 2
# Units that count as placeholders after a number, or joined to it.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t lb oz ml l s sec min h hr d ms hz khz mhz ghz w kw v a k c f pa kpa"
    " percent meter meters metre metres kilometer kilometers kilometre kilometres mile miles foot feet inch"
    " inches gram grams kilogram kilograms pound pounds liter liters litre litres second seconds minute"
    " minutes hour hours day days week weeks month months year years dollar dollars cent cents euro euros".split()
)

_TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+")
_NUMBER, _UNIT, _NAME = (xxhash.xxh64_intdigest(f"<{kind}>", 7) for kind in ("number", "unit", "name"))
_RECORD = np.dtype([("plain", "<u8"), ("kind", "u1"), ("ends", "u1")])
_WORD, _NUM, _AFTER_NUM, _NAMED = 0, 1, 2, 3
_PLACEHOLDERS = np.array([0, _NUMBER, _UNIT, _NAME], np.uint64)
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(WINDOW)], np.uint64)


_PACK = struct.Struct("<QBB").pack
_MARKS = frozenset(".,;:!?")
_ENDS = frozenset(".!?:")


def _kind(token: str, word: str) -> int:
    if token[0].isdigit():
        return _NUM
    if word in UNITS:
        return _AFTER_NUM
    return _NAMED if token[0].isupper() and len(token) > 1 and token[1:].islower() else _WORD


def _records(chunk: str) -> bytes:
    """The token records of characters without white space: hash, kind, and whether a sentence ends after."""
    mark = chunk[-1] if chunk[-1] in _MARKS else ""
    token = chunk[:-1] if mark else chunk
    if token.isalpha():
        word = token.lower()
        return _PACK(xxhash.xxh64_intdigest(word, 7), _kind(token, word), mark in _ENDS and mark != "")
    found = list(_TOKEN.finditer(chunk))
    out = []
    for i, match in enumerate(found):
        word = match[0].lower()
        rest = chunk[match.end() : found[i + 1].start() if i + 1 < len(found) else len(chunk)]
        out.append(_PACK(xxhash.xxh64_intdigest(word, 7), _kind(match[0], word), not _ENDS.isdisjoint(rest)))
    return b"".join(out)


_KNOWN = RecentTable(_records)
workers.keeps("templates", _KNOWN.drop)


def canonical(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: hash as written (lower case), kind of placeholder (0: none), and whether it may be no name.

    A capitalised word may be no name if it begins a sentence; a unit counts only right after a number.
    """
    rows = np.frombuffer(b"".join(map(_KNOWN.__getitem__, text.split())), _RECORD)
    kind = rows["kind"].copy()
    doubtful = np.zeros(len(kind), bool)
    if len(kind):
        begins = np.concatenate(([True], rows["ends"][:-1].astype(bool)))
        after_number = np.concatenate(([False], kind[:-1] == _NUM))
        doubtful = (kind == _NAMED) & begins
        kind[(kind == _AFTER_NUM) & ~after_number] = _WORD
    return np.ascontiguousarray(rows["plain"]), kind, doubtful


def _mixed(words: np.ndarray) -> np.ndarray:
    return words ^ (words >> np.uint64(29))


def _final(sums: np.ndarray) -> np.ndarray:
    return (sums ^ (sums >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _sums(words: np.ndarray, length: int = WINDOW) -> np.ndarray:
    """Per window, those that begin before the first or end after the last word included: sum over its words."""
    mixed, sums = _mixed(words), np.full(len(words) + length - 1, WINDOW - length, np.uint64)
    for i, factor in enumerate(_FACTORS[:length]):
        sums[length - 1 - i : len(sums) - i] += mixed * factor
    return sums


def _window_hashes(words: np.ndarray, length: int = WINDOW) -> np.ndarray:
    return _final(_sums(words, length)[length - 1 : len(words)])


def _with_placeholders(sums: np.ndarray, words: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The sums of whole windows after words that have a kind gave way to its placeholder."""
    places, sums = np.flatnonzero(kind), sums.copy()
    change = _mixed(_PLACEHOLDERS[kind[places]]) - _mixed(words[places])
    for i, factor in enumerate(_FACTORS):
        sums[places + (WINDOW - 1 - i)] += change * factor
    return sums[WINDOW - 1 : len(words)]


class Template(NamedTuple):
    """One reading of a text: kinds of all words, and the windows with placeholders, their hashes and use."""

    kind: np.ndarray
    at: np.ndarray
    hashes: np.ndarray
    telling: np.ndarray


def _within(marked: np.ndarray) -> np.ndarray:
    """Per window, the number of its words that are marked."""
    before = np.zeros(len(marked) + 1, np.int32)
    np.cumsum(marked, out=before[1:])
    return before[WINDOW:] - before[:-WINDOW]


def _template(plain: np.ndarray, sums: np.ndarray, kind: np.ndarray, only: np.ndarray | None = None) -> Template:
    filled = _within(kind > 0)
    at = np.flatnonzero(filled if only is None else only)
    hashes = _final(_with_placeholders(sums, plain, kind)[at]) if len(at) else np.zeros(0, np.uint64)
    return Template(kind, at, hashes, filled[at] <= WINDOW - LEAST_WORDS)


def windows(text: str) -> tuple[np.ndarray, np.ndarray, list[Template]]:
    """Hashes of the words and of their windows as written, and the templates of the text's readings.

    The second reading, in which every doubtful word is a name, has only the windows with such words.
    """
    plain, kind, doubtful = canonical(text)
    if len(plain) < WINDOW:
        return plain, np.zeros(0, np.uint64), []
    sums = _sums(plain)
    readings = [_template(plain, sums, np.where(doubtful, np.uint8(_WORD), kind))]
    if doubtful.any():
        readings.append(_template(plain, sums, kind, _within(doubtful)))
    return plain, _final(sums[WINDOW - 1 : len(plain)]), readings


def _near_telling(n: int, readings: list[Template], may: list[np.ndarray]) -> list[np.ndarray]:
    """Which of each reading's windows stand in a run of windows that may match, one of them telling."""
    matched, telling = np.zeros(n, bool), np.zeros(n, bool)
    for reading, m in zip(readings, may):
        matched[reading.at[m]] = True
        telling[reading.at[m & reading.telling]] = True
    run = np.cumsum(~matched)
    counts = np.bincount(run[telling], minlength=int(run[-1]) + 1)
    return [m & (counts[run[r.at]] > 0) for r, m in zip(readings, may)]


def _slots(words: np.ndarray, kind: np.ndarray, at: int) -> list[int]:
    return [int(w) for w in words[at : at + WINDOW][kind[at : at + WINDOW] > 0].astype(np.int64)]


_ITEM = pa.schema(
    [("item_id", pa.int64()), ("item_key", pa.int64()), ("place", pa.int32()), ("n", pa.int32()), ("hash", pa.int64()),
     ("template", pa.bool_()), ("slots", pa.list_(pa.int64())), ("words", pa.int32())]
)
_ITEM_DDL = "item_id long, item_key long, place int, n int, hash long, template boolean, slots array<long>, words int"
_HIT = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("hash", pa.int64()), ("slots", pa.list_(pa.int64()))])
_HIT_DDL = "doc_id long, text_key long, hash long, slots array<long>"


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for item_id, key, text in zip(*(c.to_pylist() for c in batch.columns)):
            words, plain, readings = windows(text)
            if 0 < len(words) < WINDOW:
                whole = _window_hashes(words, len(words)).astype(np.int64).tolist()
                rows.append((item_id, key, 0, 1, whole[0], False, [], len(words)))
            written = plain.astype(np.int64).tolist()
            rows += [(item_id, key, at, len(plain), h, False, [], WINDOW) for at, h in enumerate(written)]
            # an item without a telling window has no template, as written only is it told from others
            if any(r.telling.any() for r in readings):
                for reading in readings:
                    for at, h in zip(reading.at.tolist(), reading.hashes.astype(np.int64).tolist()):
                        rows.append((item_id, key, at, len(plain), h, True, _slots(words, reading.kind, at), WINDOW))
        columns = list(zip(*rows)) or [()] * len(_ITEM)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ITEM)], schema=_ITEM)


def _consistent(matches: list, n: int) -> int:
    """Windows of the item that match under one mapping of its values to the document's.

    Of the values that a value of the item meets, it stands for the one met most often (of equals, the
    smallest number); two values of the item never stand for the same one.
    """
    met: dict[int, dict[int, int]] = {}
    for m in matches:
        for ours, theirs in zip(m["slots"], m["d_slots"]):
            met.setdefault(ours, {}).setdefault(theirs, 0)
            met[ours][theirs] += 1
    ranked = sorted(((-c, ours, theirs) for ours, to in met.items() for theirs, c in to.items()))
    chosen: dict[int, int] = {}
    taken: set[int] = set()
    for _, ours, theirs in ranked:
        if ours not in chosen and theirs not in taken:
            chosen[ours] = theirs
            taken.add(theirs)
    places = {
        m["place"]
        for m in matches
        if all(chosen.get(ours) == theirs for ours, theirs in zip(m["slots"], m["d_slots"]))
    }
    return min(len(places), n)


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


class Leaks:
    """Which benchmark items stand in which documents.

    Defined cases: NULL texts and texts without words have no windows and never match; an item of one to four
    words is in every document that has these words in a row; an item none of whose windows has
    two ordinary words and a placeholder is found as written only; a NULL id of an item or document stays NULL in the result; repeated documents are reported once
    per id and text; every distinct text under an item's id (NULL included) is searched, and the id is
    reported once per document, with the greatest share of its texts; empty tables give no pairs; other
    columns are not read.
    """

    def __init__(
        self,
        docs: DataFrame,
        benchmark: DataFrame,
        least_share: float = LEAST_SHARE,
        text: str = "text",
        id_column: str = "doc_id",
        item_column: str = "item_id",
        item_text: str = "text",
    ):
        self.docs, self.spark = docs, docs.sparkSession
        self._id, self._text, self.least_share = F.col(f"`{id_column}`"), F.col(f"`{text}`"), least_share
        workers.importable(self.spark)
        workers.small_batches(self.spark)
        self.at = scratch_path(self.spark, "leaks")
        items = benchmark.select(
            F.col(f"`{item_column}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").alias("t")
        ).where("t IS NOT NULL")
        # ids repeat where suites are numbered anew or an item has variants: each text is searched
        items = items.distinct().select("item_id", text_key(F.col("t")).alias("item_key"), "t")
        items.mapInArrow(_item_windows, _ITEM_DDL).write.parquet(f"{self.at}/items")
        self.items = self.spark.read.schema(_ITEM_DDL).parquet(f"{self.at}/items")
        self._find_hits()
        self._candidates().write.parquet(f"{self.at}/candidates")
        self.candidates = self.spark.read.parquet(f"{self.at}/candidates")

    def _find_hits(self) -> None:
        shared = self.spark.sparkContext.broadcast(HashFilter.of(self.items, "hash"))
        # lengths of the items that are one short window: numbers below five
        short = sorted(r.words for r in self.items.where(F.col("words") < WINDOW).select("words").distinct().collect())

        def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            workers.in_use("templates")
            possible = shared.value.might_have
            for batch in batches:
                ids, keys, hashes, slots = [], [], [], []
                for doc_id, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                    words, plain, readings = windows(text.as_py())
                    found = [plain, *(_window_hashes(words, k) for k in short)]
                    rows = [(h, ()) for f in found for h in np.unique(f[possible(f)]).astype(np.int64).tolist()]
                    may = [possible(r.hashes) for r in readings]
                    if any(m.any() for m in may):
                        for reading, near in zip(readings, _near_telling(len(plain), readings, may)):
                            met = zip(reading.at[near].tolist(), reading.hashes[near].astype(np.int64).tolist())
                            rows += sorted({(h, tuple(_slots(words, reading.kind, at))) for at, h in met})
                    ids += [doc_id] * len(rows)
                    keys += [key] * len(rows)
                    hashes += [h for h, _ in rows]
                    slots += [list(s) for _, s in rows]
                columns = (ids, keys, hashes, slots)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _HIT)], schema=_HIT)

        rows = self.docs.select(self._id.cast("long").alias("doc_id"), text_key(self._text).alias("text_key"), self._text.alias("t"))
        rows = rows.where("t IS NOT NULL").mapInArrow(hits, _HIT_DDL)
        rows.write.parquet(f"{self.at}/hits")
        self.hits = self.spark.read.schema(_HIT_DDL).parquet(f"{self.at}/hits")

    def _candidates(self) -> DataFrame:
        """Distinct pairs of document and item that share one of the item's rarest windows."""
        item = ["item_id", "item_key"]
        # a NULL id is an item, too: structs are counted, columns with NULLs are not
        spread = self.items.groupBy("hash").agg(F.count_distinct(F.struct(*item)).alias("spread"))
        places = self.items.join(spread, "hash").groupBy(*item, "place", "n").agg(F.max("spread").alias("spread"))
        rarest = Window.partitionBy(*item).orderBy("spread", "place")
        needed = F.ceil(F.col("n") * F.lit(self.least_share) - 1e-9)
        first = places.withColumn("r", F.row_number().over(rarest)).where(F.col("r") <= F.col("n") - needed + 1)
        first = first.select(F.col("item_id").alias("f_item"), F.col("item_key").alias("f_key"), F.col("place").alias("f_place"))
        same = (
            F.col("item_id").eqNullSafe(F.col("f_item")) & (F.col("item_key") == F.col("f_key"))
            & (F.col("place") == F.col("f_place"))
        )
        keys = self.items.join(first, same).select("hash", *item).distinct()
        met = self.hits.select("doc_id", "text_key", "hash").distinct().join(keys, "hash")
        return met.select("doc_id", "text_key", *item).distinct()

    def pairs(self) -> DataFrame:
        """doc_id, text_key, item_id, share of the item's windows, and whether they stand there as written."""
        candidates = self.candidates.withColumnsRenamed({"item_id": "c_item", "item_key": "c_key"})
        wanted = candidates.join(
            self.items, F.col("c_item").eqNullSafe(F.col("item_id")) & (F.col("c_key") == F.col("item_key"))
        ).drop("c_item", "c_key")
        hits = self.hits.select(
            F.col("doc_id").alias("h_id"), F.col("text_key").alias("h_key"), F.col("hash").alias("h_hash"),
            F.col("slots").alias("d_slots"),
        )
        same = (
            F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_key") == F.col("h_key"))
            & (F.col("hash") == F.col("h_hash"))
        )
        # a window without placeholders is the same as written and as a template
        met = wanted.join(hits, same).where(F.size("d_slots") == F.size("slots"))
        match = F.struct("place", "slots", "d_slots")
        found = met.groupBy("doc_id", "text_key", "item_id", "item_key", "n").agg(
            F.count_distinct(F.when(~F.col("template"), F.col("place"))).alias("written"),
            F.collect_set(match).alias("matches"),
        )

        @F.pandas_udf(T.IntegerType())
        def consistent(matches: pd.Series, n: pd.Series) -> pd.Series:
            return pd.Series([_consistent(m, k) for m, k in zip(matches, n)], dtype="int32")

        needed = F.col("n") * F.lit(self.least_share) - 1e-9
        as_written = F.col("written") >= needed
        exact = found.where(as_written).select("doc_id", "text_key", "item_id", "n", F.col("written").cast("int").alias("m"), F.lit(True).alias("as_written"))
        other = found.where(~as_written).withColumn("m", consistent("matches", "n"))
        other = other.where(F.col("m") >= needed).select("doc_id", "text_key", "item_id", "n", "m", F.lit(False).alias("as_written"))
        best = F.max(F.struct((F.col("m") / F.col("n")).alias("share"), "as_written")).alias("best")
        return exact.unionByName(other).groupBy("doc_id", "text_key", "item_id").agg(best).select(
            "doc_id", "text_key", "item_id", "best.share", "best.as_written"
        )

    def clean(self) -> DataFrame:
        """The columns of the documents, without those that hold an item."""
        at = scratch_path(self.spark, "leaking")
        self.pairs().select(F.col("doc_id").alias("l_id"), F.col("text_key").alias("l_key")).distinct().write.parquet(at)
        leaking = self.spark.read.parquet(at)
        rows = self.docs.select(F.struct("*").alias("row"), self._id.cast("long").alias("r_id"), text_key(self._text).alias("r_key"))
        same = F.col("r_id").eqNullSafe(F.col("l_id")) & (F.col("r_key") == F.col("l_key"))
        return rows.join(leaking, same, "left_anti").select("row.*")


def least_windows(n: int, share: float = LEAST_SHARE) -> int:
    """Windows of an item of n windows that must be in a document."""
    return math.ceil(n * share - 1e-9)
