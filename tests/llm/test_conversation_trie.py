"""The trie of conversations against a dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reconlake.llm import conversation_trie as trie
from reconlake.llm import queries

DDL = "conv_id long, turn long, role string, text string, n int, points long, place long, node string"


def plain_nodes(conversations):
    """Rows of all nodes of {conv_id: [(role, text), ...]}, by enumerating prefixes."""
    members, paths = defaultdict(list), {}
    for conv_id in sorted(conversations):
        path = [tuple(conversations[conv_id][:d]) for d in range(len(conversations[conv_id]) + 1)]
        paths[conv_id] = path
        for prefix in path:
            members[prefix].append(conv_id)
    children = defaultdict(int)
    for prefix in members:
        if prefix:
            children[prefix[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for prefix, own in members.items():
        cost = (len(own) - 1) * len(prefix[-1][1]) if prefix else 0
        for d in range(len(prefix) + 1):
            saved[prefix[:d]] += cost
            leaves[prefix[:d]] += not children[prefix]
    found = set()
    for prefix, own in members.items():
        ends = ",".join(str(c) for c in own if len(conversations[c]) == len(prefix))
        parent = members[prefix[:-1]][0] if prefix else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        found.add((own[0], len(prefix), parent, len(own), children[prefix], leaves[prefix], saved[prefix], sha))
    return found


def rebuilt(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            key = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()[:16]
            own[conv_id].append((turn is not None, turn or 0, key, role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts, key=lambda t: t[:3])] for c, ts in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        made[c] = own.get(base, [])[:h] + turns[h:]
    return made


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], DDL)


def spark_nodes(spark, rows):
    turns = trie.with_shared_heads(trie.numbered_turns(table(spark, rows)))
    found = [tuple(r) for r in trie.ConversationTrie(turns).nodes().collect()]
    assert len(found) == len(set(found))
    return set(found)


def rows_of(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(0, 700), n // 5) + [-5, -100, 10**12]:
        for turn in range(rng.randint(0, 9)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["", "a", "bb", "größe", "x" * 40])))
    return rows


@pytest.mark.parametrize("limits", [(4096, 1 << 16), (3, 1 << 16), (4096, 4)], ids=["one shard", "small shards", "lone"])
def test_against_prefixes(spark, monkeypatch, limits):
    monkeypatch.setattr(trie, "SHARD_CONVERSATIONS", limits[0])
    monkeypatch.setattr(trie, "SHARD_TURNS", limits[1])
    rows = rows_of(1)
    assert spark_nodes(spark, rows) == plain_nodes(rebuilt(rows))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c"]), max_size=7), min_size=1, max_size=12), st.integers(1, 9), st.integers(1, 5))
def test_shards_hold_every_turn(conversations, most_turns, most):
    rows = []
    for c, own in enumerate(conversations):
        rows.append((c, None, 0))
        rows += [(c, t.encode() * 16, 1) for t in own]
    saved = trie.SHARD_TURNS, trie.SHARD_CONVERSATIONS
    trie.SHARD_TURNS, trie.SHARD_CONVERSATIONS = most_turns, most
    try:
        found = list(trie._shards(iter(rows)))
    finally:
        trie.SHARD_TURNS, trie.SHARD_CONVERSATIONS = saved
    paths = {(c, d) for c, own in enumerate(conversations) for d in range(len(own) + 1)}
    assert sum(r[6] for r in found) == len(paths)
    ends = [int(c) for r in found if r[9] for c in r[9].split(",")]
    assert ends == sorted(ends, key=lambda c: next(i for i, r in enumerate(found) if r[9] and str(c) in r[9].split(",")))
    assert sorted(ends) == list(range(len(conversations)))


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, None, None, None), (1, 0, "user", "hello"), (2, 0, None, ""), (None, 1, "user", "x"),
        (None, None, None, None), (3, 5, "user", "y" * 100000), (3, 5, "user", "y" * 100000), (100, 0, "", ""), (101, 1, "a", "b"),
    ]
    assert spark_nodes(spark, rows) == plain_nodes(rebuilt(rows))
    assert spark_nodes(spark, []) == set()


def test_one_conversation_holds_most_rows(spark):
    rows = [(7, i, "user", f"t{i % 3}") for i in range(3000)] + [(8, i, "user", f"t{i % 3}") for i in range(5)]
    found = {(r[0], r[1]): r for r in spark_nodes(spark, rows)}
    assert len([1 for c, _ in found if c == 7]) >= 2990


def test_query_against_prefixes(spark, sf_dir):
    read = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = {tuple(r) for r in queries.QUERIES["op12_conversation_trie"](spark, sf_dir).collect()}
    assert found == plain_nodes(rebuilt([tuple(r) for r in read.collect()]))
