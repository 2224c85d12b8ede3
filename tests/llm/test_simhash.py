from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from odd_rows import ROWS, empty, frame
from pyspark.sql import functions as F

from reconlake.llm import gray_index, simhash
from reconlake.llm.components import connected_components
from reconlake.session import scratch_path


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints):
    """Smallest id per row, from (id, fingerprint) of all rows, by comparing all of them."""
    values = sorted(set(p for _, p in prints))
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    every = np.array(values, np.uint64)
    for i, v in enumerate(values):
        for j in np.nonzero(np.bitwise_count(every[i + 1 :] ^ np.uint64(v)) <= 2)[0]:
            parent[find(values[i + 1 + int(j)])] = find(v)
    least = {}
    for doc_id, p in prints:
        if doc_id is not None:
            least[find(p)] = min(least.get(find(p), doc_id), doc_id)
    return [(doc_id, f"{p:016x}", least.get(find(p))) for doc_id, p in prints]


@pytest.mark.parametrize("leaf", [512, 6])
def test_index_finds_all_pairs(spark, monkeypatch, leaf):
    monkeypatch.setattr(gray_index, "LEAF_MEMBERS", leaf)
    rng = np.random.default_rng(1)
    values = set(rng.integers(-(2**63), 2**63 - 1, 120, dtype=np.int64).tolist()) | {0, -1, 1, 3, -(2**63)}
    for base in list(values)[:12]:
        for _ in range(20):
            bits = rng.choice(64, rng.integers(1, 4), replace=False)
            flipped = (base % 2**64) ^ sum(1 << int(b) for b in bits)
            values.add(flipped - 2**64 if flipped >= 2**63 else flipped)
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "fp long")
    pairs = gray_index.near_pairs(rows, 2, scratch_path(spark, "index"))
    found = [tuple(sorted(r)) for r in pairs.collect()]
    order = sorted(values)
    every = np.array(order, np.int64).view(np.uint64)
    wanted = {
        (order[i], order[i + 1 + int(j)])
        for i in range(len(order))
        for j in np.nonzero(np.bitwise_count(every[i + 1 :] ^ every[i]) <= 2)[0]
    }
    assert len(found) == len(set(found))
    assert set(found) == wanted


def test_gray_rank(spark):
    codes = [(n ^ (n >> 1)) for n in range(1000)]
    rows = spark.createDataFrame([(c,) for c in codes], "fp long").select(gray_index.gray_rank(F.col("fp")))
    assert [r[0] for r in rows.collect()] == list(range(1000))


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 102), (102, 101), (200, 201), (200, 202), (200, 203)]
    rows = spark.createDataFrame([(b, a) if a % 3 else (a, b) for a, b in edges], "u long, v long")
    got = {r.node: r.root for r in connected_components(rows, scratch_path(spark, "cc")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100, **{i: 200 for i in range(200, 204)}}
    none = connected_components(spark.createDataFrame([], "u long, v long"), scratch_path(spark, "cc"))
    assert none.collect() == []


def test_odd_rows(spark):
    found = simhash.NearDuplicates(frame(spark))
    want = plain_components([(r[0], plain_fingerprint(r[1])) for r in ROWS])
    assert sorted(map(tuple, found.components().collect()), key=repr) == sorted(want, key=repr)
    kept = found.kept()
    assert kept.columns == frame(spark).columns
    rows = [tuple(r)[:2] for r in kept.collect()]
    assert len(rows) == len({plain for _, plain, _ in want}) == len(set(rows))
    none = simhash.NearDuplicates(empty(spark))
    assert none.components().collect() == none.kept().collect() == []


def test_documents_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = docs.limit(60)
    # one word changed in a long text: fingerprints a bit or two apart
    near = base.selectExpr("doc_id + 1000000 AS doc_id", "concat(text, ' ', text, ' ', text, ' end') AS text")
    other = base.selectExpr("doc_id + 2000000 AS doc_id", "concat(text, ' ', text, ' ', text, ' fin') AS text")
    every = docs.select("doc_id", "text").union(near).union(other)
    want = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in every.collect()])
    got = sorted(map(tuple, simhash.NearDuplicates(every).components().collect()))
    assert got == sorted(want)
