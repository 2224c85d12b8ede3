"""Periodic runs against a search by the definition."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import empty, frame

from reconlake.llm import periodic_runs, queries


def plain_runs(words):
    """Every maximal stretch with words q apart alike, for every q, kept with its smallest q."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - at >= max(12, 2 * q):
                best.setdefault((at, end + q), q)
            at = end + 1
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=250, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=120), st.integers(1, 5), st.integers(0, 30))
def test_random_words(letters, times, tail):
    words = (letters * times + letters[:tail])[:300]
    encoded = [w.encode() for w in words]
    found = periodic_runs.runs(encoded)
    assert found == plain_runs(words)
    assert periodic_runs.collapsed(encoded, found).decode() == plain_collapsed(words, found)


def _nested(depth):
    words = ["a"]
    for i in range(depth):
        words = words * (2 + i % 3) + [f"x{i % 2}"] + words
    return words


@pytest.mark.parametrize(
    "words",
    [
        ["a"] * 1000,
        ["a", "b"] * 300 + ["c"] + ["a", "b"] * 20,
        _nested(4),
        [f"w{i}" for i in range(400)] * 3,
        [f"w{i % 7}" for i in range(50)] + ["z"] * 11 + [f"w{i % 7}" for i in range(13)],
    ],
    ids=["one word", "interrupted", "nested", "long period", "short of twelve"],
)
def test_shapes(words):
    assert periodic_runs.runs([w.encode() for w in words]) == plain_runs(words)


def test_fibonacci_and_random_words():
    a, b = ["a"], ["a", "b"]
    while len(b) < 600:
        a, b = b, b + a
    assert periodic_runs.runs([w.encode() for w in b]) == plain_runs(b)
    rng = random.Random(3)
    for _ in range(60):
        piece = [rng.choice("abcdef") for _ in range(rng.randint(1, 30))]
        words = [rng.choice("abcdef") for _ in range(rng.randint(0, 40))] + piece * rng.randint(1, 6)
        words += [rng.choice("abc") for _ in range(rng.randint(0, 40))] + words[: rng.randint(0, 50)]
        assert periodic_runs.runs([w.encode() for w in words]) == plain_runs(words)


def test_a_very_long_text_is_searched_whole():
    rng = random.Random(5)
    words = [f"w{rng.randint(0, 3000)}".encode() for _ in range(60000)]
    words[20000:20000] = words[1000:3000] * 3
    found = periodic_runs.runs(words)
    longest = max(found, key=lambda r: r[1])
    assert longest[0] <= 20000 <= longest[0] + 2 and longest[2] == 2000 and longest[1] >= 6000


def expected_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    numbers = (None,) * 4 if top is None else (top[0], top[1], top[2], 1000 * top[1] // top[2])
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, plain_collapsed(words, found))]
    return (doc_id, len(found), *numbers, *sha)


def test_query_against_the_definition(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    small = [d for d in docs if len((d[1] or "").split()) < 2500]
    found = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    assert sum(r[1] > 0 for r in found.values()) > 10
    for doc_id, text in small:
        assert found[doc_id] == expected_row(doc_id, text)


def test_odd_rows(spark):
    found = periodic_runs.find_runs(frame(spark)).collect()
    assert len(found) == 14
    of = {}
    for r in found:
        of.setdefault(r["doc_id"], []).append(r)
    assert of[3][0]["n_words"] == 0 and of[3][0]["runs"] == [] and of[3][0]["collapsed"] == ""
    assert of[2][0] == of[2][1] and len(of[None]) == 2
    assert periodic_runs.find_runs(empty(spark)).count() == 0
