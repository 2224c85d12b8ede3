"""Repeated bytes against a dictionary of all strings of 50 bytes."""

from __future__ import annotations

import hashlib
import os
import random
import time

import numpy as np
import pytest
from odd_rows import ROWS, empty, frame

from reconlake.llm import queries, suffix_doubling


def plain(docs):
    """(doc_id, bytes, removed, runs, hash of the rest) per (doc_id, text)."""
    first: dict[bytes, float] = {}
    rank = [float("inf") if d is None else d for d, _ in docs]
    texts = [(t or "").encode() for _, t in docs]
    for r, text in zip(rank, texts):
        for i in range(len(text) - 49):
            s = text[i : i + 50]
            first[s] = min(first.get(s, float("inf")), r)
    rows = []
    for (doc_id, _), r, text in zip(docs, rank, texts):
        gone = bytearray(len(text))
        for i in range(len(text) - 49):
            if first[text[i : i + 50]] < r:
                gone[i : i + 50] = b"\x01" * 50
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        left = bytes(b for b, g in zip(text, gone) if not g)
        rows.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(rows, key=repr)


def found(spark, docs):
    table = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, doc long, tag string").repartition(3)
    return sorted(
        ((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
         for r in suffix_doubling.RepeatedBytes(table).report().collect()), key=repr
    )


def random_docs(seed):
    rng = random.Random(seed)
    letters = ["ab", "abcdefgh", "aé漢 \n"][seed % 3]
    pool = ["".join(rng.choice(letters) for _ in range(rng.randint(30, 200))) for _ in range(12)]
    docs = []
    for doc_id in rng.sample(range(-50, 1000), 60):
        parts = []
        for _ in range(rng.randint(0, 6)):
            piece = rng.choice(pool)
            a = rng.randint(0, len(piece) // 2)
            parts.append(rng.choice([piece, piece[a:], piece[: len(piece) - a], "".join(rng.choice(letters) for _ in range(rng.randint(0, 70)))]))
        docs.append((doc_id, "".join(parts)))
    docs += [(2000, docs[0][1]), (2000, docs[1][1]), (2001, docs[0][1]), (None, docs[2][1]), (None, None), (5000, "")]
    return docs


@pytest.mark.parametrize("seed", range(6))
def test_random_texts(spark, seed):
    docs = random_docs(seed)
    assert found(spark, docs) == plain(docs)


def test_limits_of_batches_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_doubling, "_PIECE", 97)
    monkeypatch.setattr(suffix_doubling, "_COMBINED", 50)
    monkeypatch.setattr(suffix_doubling, "_ROWS", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    docs = random_docs(1)
    try:
        assert found(spark, docs) == plain(docs)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_exactly_fifty_bytes(spark):
    s = "".join(chr(65 + i % 26) for i in range(49))
    docs = [(1, "x" + s + "y"), (2, "z" + s + "y"), (3, "q" + s + "z"), (4, "z" + s), (5, s), (6, "é" + s + "y")]
    assert found(spark, docs) == plain(docs)


def test_runs_of_one_byte_and_whole_copies(spark):
    docs = [(i, "a" * n) for i, n in enumerate([40, 49, 50, 51, 1000, 70])]
    docs += [(100 + i, "one text that many documents have, word for word, and that is long enough") for i in range(300)]
    assert found(spark, docs) == plain(docs)


def test_halving_reaches_every_string():
    for low in range(35):
        for high in range(low, 35):
            content = bytes(range(50 + high - low))
            open_rows, singles = [(content, 0, len(content), high, 34)], set()
            while open_rows:
                content, *numbers = open_rows.pop()
                lo, end, offset, node = (np.array([x]) for x in numbers)
                one = np.array([1])
                data = np.frombuffer(content, np.uint8)
                for part in suffix_doubling.halves(data, one - 1, one, one, lo, end, offset, node, one):
                    for row in part.to_pylist():
                        assert row["bytes"] == bytes(range(row["lo"], row["end"]))
                        if row["node"] >> 6 == row["node"] & 63:
                            singles.add(row["lo"])
                        else:
                            open_rows.append((row["bytes"], row["lo"], row["end"], row["offset"], row["node"]))
            assert singles == set(range(high - low + 1))


def test_query_on_the_table(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = sorted((tuple(r) for r in queries.QUERIES["op11_repeated_bytes"](spark, sf_dir).collect()), key=repr)
    assert rows == plain(docs)


def test_odd_rows(spark):
    made = suffix_doubling.RepeatedBytes(frame(spark)).report().collect()
    rows = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in made), key=repr)
    assert rows == plain([(r[0], r[1]) for r in ROWS])
    assert suffix_doubling.RepeatedBytes(empty(spark)).report().count() == 0


def ranks(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return {int(r) for piece in suffix_doubling.anchors(data, np.array([len(data)])) for r in piece[3]}


def test_a_short_common_passage_gives_no_common_rank():
    rng = random.Random(5)
    for length in (16, 24, 28, 49, 50, 200):
        alike = 0
        for _ in range(200):
            shared = "".join(rng.choices("abcdefgh", k=length))
            one, two = ("".join(rng.choices(letters, k=80)) + shared + "".join(rng.choices(letters, k=80)) for letters in ("ijkl", "mnop"))
            alike += bool(ranks(one) & ranks(two))
        assert alike == 0 if length < 29 else alike == 200 if length >= 50 else alike


def test_all_shares_have_each_half_once():
    data = np.frombuffer("".join(random.Random(3).choices("abcde ", k=5000)).encode(), np.uint8)
    rows = lambda *share: {tuple(int(x) for x in row) for piece in suffix_doubling.anchors(data, np.array([2000, 5000]), *share) for row in zip(*piece)}
    shares = [rows(i, 3) for i in range(3)]
    assert all(shares) and sum(map(len, shares)) == len(set().union(*shares)) and set().union(*shares) == rows()
    strings = sorted(x for lo, hi, *_ in rows() for x in range(lo, hi + 1))
    assert strings == [*range(1951), *range(2000, 4951)]


def test_parts_of_all_rounds(spark, monkeypatch):
    monkeypatch.setattr(suffix_doubling, "SHARES", 3)
    monkeypatch.setattr(suffix_doubling, "OPEN_BYTES", 240)
    made = []
    later = suffix_doubling.RepeatedBytes._later_rounds
    monkeypatch.setattr(suffix_doubling.RepeatedBytes, "_later_rounds", lambda self, left, part: made.append(part) or later(self, left, part))
    docs = random_docs(4)
    assert found(spark, docs) == plain(docs)
    assert 1 < len(made) < 9


def test_only_marks_stay_on_disk(spark):
    def shuffles():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {name for name in manager.getAllFiles().mkString(" ").split() if "/shuffle_" in name}

    table = spark.createDataFrame(random_docs(1), "doc_id long, text string")
    before = shuffles()
    made = suffix_doubling.RepeatedBytes(table)
    late = time.time() + 20
    while shuffles() - before and time.time() < late:
        time.sleep(0.2)
    assert not shuffles() - before
    folders = os.listdir(made.at.removeprefix("file:"))
    assert folders and all(name.startswith("marks") for name in folders)
    assert made.marks.count() > 0
