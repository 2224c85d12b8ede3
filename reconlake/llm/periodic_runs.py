"""Periodic runs of words, found in a Re-Pair grammar of the word ids.

A run is a stretch of words with smallest period q, at least twice as long as q and at least ``LEAST_WORDS``
long, that cannot be extended. Every document is searched on its own:

1. A run holds no word that occurs once, and one of its six-word windows occurs again within it (words q
   apart are equal over six places or more). Stretches without either are left out before anything is
   built; that loses nothing.
2. Re-Pair replaces the most frequent pair of neighbouring symbols, earliest pair first among equals, until
   no pair occurs twice. What remains is halved into a balanced tree, so that every run has a lowest
   node whose words hold it, and the run crosses the boundary between that node's halves.
3. The runs across the boundary of a nonterminal are computed once, however often it occurs.
4. They are translated to all places where the nonterminal is derived; a stretch inside a longer one of the
   same period is part of it, so only the maximal ones stay.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reconlake.llm import workers

#: Words that a run has at least, and words of the window that occurs twice in any run.
LEAST_WORDS = 12
_WINDOW = LEAST_WORDS // 2
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of collapsed text that one batch of results holds, about.
_BATCH_BYTES = 1 << 24

Run = tuple[int, int, int]
Words = list[bytes]


def candidate_stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (start, end) of word ids; no run lies outside of them."""
    if len(ids) < LEAST_WORDS:
        return []
    single = np.nonzero(np.bincount(ids)[ids] == 1)[0]
    walls = np.concatenate(([-1], single, [len(ids)]))
    wide = np.nonzero(np.diff(walls) > LEAST_WORDS)[0]
    if not len(wide):
        return []
    # windows alike have hashes alike; others that collide only let more through
    plain = ids.astype(np.uint64) + np.uint64(1)
    windows = np.zeros(len(ids) - _WINDOW + 1, np.uint64)
    for at in range(_WINDOW):
        windows = windows * _FACTOR + plain[at : at + len(windows)]
    found = []
    for wall in wide.tolist():
        start, end = int(walls[wall]) + 1, int(walls[wall + 1])
        inside = windows[start : end - _WINDOW + 1]
        if len(np.unique(inside)) < len(inside):
            found.append((start, end))
    return found


def re_pair(ids: list[int]) -> tuple[int, list[tuple[int, int]], list[int]]:
    """Number of terminals, rules (symbol ``terminals + i`` is the i-th pair) and the sequence that is left."""
    n, terminals = len(ids), max(ids) + 1
    symbols, following, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], list[int]] = {}
    for at in range(n - 1):
        places.setdefault((ids[at], ids[at + 1]), []).append(at)
    count = {pair: len(p) for pair, p in places.items()}
    serial = {pair: number for number, pair in enumerate(places)}
    queue = [(-c, serial[pair], pair) for pair, c in count.items() if c > 1]
    heapq.heapify(queue)
    rules: list[tuple[int, int]] = []
    while queue:
        expected, number, pair = heapq.heappop(queue)
        now = count.get(pair, 0)
        if now < 2:
            continue
        if now != -expected:
            heapq.heappush(queue, (-now, number, pair))
            continue
        a, b = pair
        valid, free = [], -1
        for at in sorted(set(places.pop(pair))):
            if at >= free and symbols[at] == a and following[at] < n and symbols[following[at]] == b:
                valid.append(at)
                free = following[at] + 1
        count[pair] = 0
        if len(valid) < 2:
            continue
        new = terminals + len(rules)
        rules.append(pair)
        touched: dict[tuple[int, int], None] = {}
        for at in valid:
            second = following[at]
            left, right = before[at], following[second]
            if left >= 0:
                old, made = (symbols[left], a), (symbols[left], new)
                count[old] = count.get(old, 0) - 1
                count[made] = count.get(made, 0) + 1
                places.setdefault(made, []).append(left)
                touched[made] = None
            if right < n:
                old, made = (b, symbols[right]), (new, symbols[right])
                count[old] = count.get(old, 0) - 1
                count[made] = count.get(made, 0) + 1
                places.setdefault(made, []).append(at)
                touched[made] = None
                before[right] = at
            symbols[at], symbols[second], following[at] = new, -1, right
        for made in touched:
            if count[made] > 1:
                heapq.heappush(queue, (-count[made], serial.setdefault(made, len(serial)), made))
    rest, at = [], 0
    while at < n:
        rest.append(symbols[at])
        at = following[at]
    return terminals, rules, rest


def crossing(u: np.ndarray, middle: int) -> list[Run]:
    """(start, end, smallest period) of the runs of ``u``, maximal in it, that hold words on both sides of ``middle``."""
    n, most = len(u), len(u) // 2
    # a run that reaches a period to the right has equal words at middle - 1 and a period on; any other one
    # at middle and a period back
    right = np.nonzero(u[middle : middle + most] == u[middle - 1])[0] + 1
    left = np.nonzero(u[max(0, middle - most) : middle][::-1] == u[middle])[0] + 1
    period = np.concatenate((right, left))
    centre = np.concatenate((np.full(len(right), middle - 1), middle - left))
    if not len(period):
        return []
    # equal pairs of words next to each other, around the centre: six or more in any run
    padded = np.concatenate((np.full(_WINDOW, -1, u.dtype), u, np.full(_WINDOW, -2, u.dtype)))
    at, total = centre + _WINDOW, np.ones(len(period), np.int64)
    for way in (-1, 1):
        alive = np.ones(len(period), bool)
        for step in range(1, _WINDOW):
            alive &= padded[at + way * step] == padded[at + way * step + period]
            total += alive
    keep = (total >= _WINDOW) & (2 * period <= n)
    order = np.argsort(period[keep], kind="stable")
    period, centre = period[keep][order], centre[keep][order]
    best: dict[tuple[int, int], int] = {}
    while len(period):
        q, c = int(period[0]), int(centre[0])
        period, centre = period[1:], centre[1:]
        differ = u[:-q] != u[q:]
        below, above = np.nonzero(differ[: c + 1])[0], np.nonzero(differ[c:])[0]
        start = int(below[-1]) + 1 if len(below) else 0
        end = (c + int(above[0]) if len(above) else n - q) + q
        if end - start >= max(LEAST_WORDS, 2 * q):
            best.setdefault((start, end), q)
            # a multiple of the period that fits twice gives the same stretch again
            other = (period % q != 0) | (2 * period > end - start)
            period, centre = period[other], centre[other]
    return [(start, end, q) for (start, end), q in best.items()]


def _halved(rest: list[int], lengths: list[int], rules: list[tuple[int, int]], terminals: int) -> int:
    """Adds rules that join the sequence, cut near the middle again and again; the topmost symbol."""
    ends = np.cumsum([lengths[s] for s in rest])
    made: dict[tuple[int, int], int] = {}
    stack = [(0, len(rest), False)]
    while stack:
        first, last, ready = stack.pop()
        if last - first == 1:
            made[first, last] = rest[first]
            continue
        low = int(ends[first - 1]) if first else 0
        cut = int(np.searchsorted(ends[first:last], (low + int(ends[last - 1])) / 2)) + first
        cut = min(max(cut, first + 1), last - 1)
        if not ready:
            stack += [(first, last, True), (first, cut, False), (cut, last, False)]
            continue
        pair = (made.pop((first, cut)), made.pop((cut, last)))
        made[first, last] = terminals + len(rules)
        rules.append(pair)
        lengths.append(lengths[pair[0]] + lengths[pair[1]])
    return made[0, len(rest)]


def _stretch_runs(ids: np.ndarray) -> Iterator[Run]:
    """(period, start, end) of the runs of a stretch, and of parts of them."""
    _, small = np.unique(ids, return_inverse=True)
    terminals, rules, rest = re_pair(small.tolist())
    lengths = [1] * terminals
    for a, b in rules:
        lengths.append(lengths[a] + lengths[b])
    top = _halved(rest, lengths, rules, terminals)
    starts: dict[int, list[int]] = {top: [0]}
    for symbol in range(terminals + len(rules) - 1, terminals - 1, -1):
        at = starts.pop(symbol, None)
        if at is None or lengths[symbol] < LEAST_WORDS:
            continue
        a, b = rules[symbol - terminals]
        middle = lengths[a]
        for start, end, q in crossing(ids[at[0] : at[0] + lengths[symbol]], middle):
            for place in at:
                yield q, place + start, place + end
        if lengths[a] >= LEAST_WORDS:
            starts.setdefault(a, []).extend(at)
        if lengths[b] >= LEAST_WORDS:
            starts.setdefault(b, []).extend(place + middle for place in at)


def runs(words: Words) -> list[Run]:
    """(start, length, period) of every run, by start, then period."""
    table: dict[bytes, int] = {}
    ids = np.fromiter((table.setdefault(w, len(table)) for w in words), np.int64, len(words))
    periods: dict[tuple[int, int], int] = {}
    for first, last in candidate_stretches(ids):
        found = sorted(set(_stretch_runs(ids[first:last])), key=lambda r: (r[0], r[1], -r[2]))
        period, reached = 0, 0
        for q, start, end in found:
            if q == period and end <= reached:
                continue
            period, reached = q, end
            periods.setdefault((first + start, first + end), q)
    return sorted(((s, e - s, q) for (s, e), q in periods.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: Words, found: list[Run]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not found:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, q in found:
        depth[start + q] += 1
        depth[start + length] -= 1
    kept = np.nonzero(np.cumsum(depth[:-1]) == 0)[0]
    return b" ".join([words[i] for i in kept.tolist()])


def repeat_tail(doc_id: int | None, words: Words) -> Words:
    """Words with the tail of every tenth document (by CRC-32 of its id) made periodic; a NULL id changes nothing."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def find_runs(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    rewrite: Callable[[int | None, Words], Words] | None = None,
) -> DataFrame:
    """doc_id, n_words, all runs in order (start, length, period) and the collapsed text of every row.

    Words end at space and U+0009 to U+000D. ``rewrite`` may change the words of a document before they are
    searched. Defined cases: a NULL or empty text has no words, no runs and an empty collapsed text;
    repeated rows get equal results; rows of a NULL id are searched like others; further columns are not
    read; an empty table gives no rows. A document is searched in one task, by parts between words that occur
    once, with memory in proportion to its length.
    """
    workers.importable(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("t"))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.in_use("periodic_runs")
        made: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            ids, counts, found, texts = zip(*made)
            made.clear()
            as_rows = [[{"start": s, "length": n, "period": q} for s, n, q in one] for one in found]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(as_rows, _RUNS), pa.array(texts, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

        for several in batches:
            for doc_id, whole in zip(several.column(0), several.column(1)):
                doc_id, words = doc_id.as_py(), (whole.as_py() or b"").split()
                if rewrite is not None:
                    words = rewrite(doc_id, words)
                found = runs(words)
                made.append((doc_id, len(words), found, collapsed(words, found)))
                size += len(made[-1][3]) + 64 * len(found)
                if size >= _BATCH_BYTES:
                    yield batch()
                    size = 0
            if made:
                yield batch()
                size = 0

    return rows.mapInArrow(searched, _SCHEMA)
