from __future__ import annotations

import hashlib
import os
import re

import pytest
from odd_rows import ROWS, SCHEMA, empty, frame
from pyspark.sql import functions as F

from reconlake.llm.exact_stream import ExactDedup, sha256
from reconlake.session import scratch_path


def clean(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def groups(rows):
    found = {}
    for doc_id, text in rows:
        found.setdefault(clean(text), []).append((-len(text or ""), doc_id is None, doc_id))
    return found


def agrees(result, rows):
    found = groups(rows)
    got = result.collect()
    assert len(got) == len(rows)
    by_text = {hashlib.sha256(t.encode()).hexdigest(): g for t, g in found.items()}
    kept = {}
    for r in got:
        group = by_text[r.text_sha256]
        best = min(group, key=lambda g: (g[0], g[1], g[2] or 0))
        assert (r.group_size, r.keep_id) == (len(group), best[2])
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
    assert set(kept.values()) == {1} and len(kept) == len(found)


@pytest.mark.parametrize("digest", [sha256, lambda t: F.substring(sha256(t), 1, 0), lambda t: F.unhex(F.substring(F.md5(t), 1, 2))])
def test_groups_whatever_the_digest(spark, digest):
    path = scratch_path(spark, "docs")
    more = [(100 + i, f"text {i % 9}" + " " * (i % 4), None, None, 1, *ROWS[0][5:]) for i in range(40)]
    frame(spark, ROWS + more).repartition(3).write.parquet(path)
    result = ExactDedup(spark, path, digest=digest).advance().result()
    agrees(result, [(r[0], r[1]) for r in ROWS + more])


def test_new_files_continue_the_state(spark):
    path, at = scratch_path(spark, "docs"), scratch_path(spark, "state")
    frame(spark, ROWS[:3]).coalesce(1).write.parquet(path)
    ExactDedup(spark, path, at=at).advance()
    frame(spark, ROWS[3:]).coalesce(1).write.mode("append").parquet(path)
    agrees(ExactDedup(spark, path, at=at).advance().result(), [(r[0], r[1]) for r in ROWS])


def test_old_files_are_taken_in_later(spark):
    path, at = scratch_path(spark, "docs"), scratch_path(spark, "exact")
    frame(spark).limit(4).coalesce(1).write.parquet(path)
    first = ExactDedup(spark, path, at=at).advance().rows().count()
    seen = set(os.listdir(path))
    frame(spark).limit(4).coalesce(1).write.mode("append").parquet(path)
    for name in set(os.listdir(path)) - seen:
        os.utime(f"{path}/{name}", (10**9, 10**9))
    assert (first, ExactDedup(spark, path, at=at).advance().rows().count()) == (4, 8)


def test_empty_table(spark):
    path = scratch_path(spark, "docs")
    empty(spark).write.parquet(path)
    result = ExactDedup(spark, path, schema=spark.read.parquet(path).schema).advance().result()
    assert result.collect() == []
    assert SCHEMA.startswith("doc_id")
