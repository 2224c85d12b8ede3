"""Levels of scripts by lineage, and runs that stop where an input is not there."""

from __future__ import annotations

import itertools
import random

import pytest

from reconlake.operators import levels
from reconlake.plans import gate

_LINEAGE = "file_path string, source_table_names array<string>, target_table_names array<string>"


def _states(df):
    return {r.file_path: (r.level, r.state) for r in df.collect()}


def _plain(lineage):
    """By paths of single scripts: reachable pairs, then longest paths."""
    names = [f for f, _, _ in lineage]
    after = {
        a: {b for b, reads, _ in lineage if a != b and {t.lower() for t in writes} & {t.lower() for t in reads}}
        for a, _, writes in lineage
    }
    reach = {a: set(after[a]) for a in names}
    for k, a in itertools.product(names, names):
        if k in reach[a]:
            reach[a] |= reach[k]
    out = {}
    tied = {a for a in names if a in reach[a]}

    def depth(b):
        return max((depth(a) + 1 for a in names if b in after[a]), default=0)

    for b in names:
        from_cycle = any(b in reach[a] for a in tied)
        to_cycle = bool(reach[b] & tied)
        if b in tied or (from_cycle and to_cycle):
            out[b] = (None, levels.CYCLE)
        elif from_cycle:
            out[b] = (None, levels.BEHIND)
        else:
            out[b] = (depth(b), levels.ORDERED)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_plain_paths(spark, seed):
    rng = random.Random(seed)
    tables = [f"S.t{i}" if i % 2 else f"s.T{i}" for i in range(14)]
    lineage = [
        (f"{i}.sql", rng.sample(tables, rng.randrange(0, 3)), rng.sample(tables, rng.randrange(0, 2)))
        for i in range(18)
    ]
    got = _states(levels.run_levels(spark.createDataFrame(lineage, _LINEAGE)))
    assert got == _plain(lineage)


def test_many_writers_and_readers_of_one_table(spark):
    lineage = [(f"w{i}", [], ["a.hot"]) for i in range(300)] + [(f"r{i}", ["A.HOT"], []) for i in range(300)]
    got = _states(levels.run_levels(spark.createDataFrame(lineage, _LINEAGE)))
    assert {f: s[0] for f, s in got.items()} == {f: int(f[0] == "r") for f, _, _ in lineage}


def test_empty_and_null(spark):
    assert levels.run_levels(spark.createDataFrame([], _LINEAGE)).count() == 0
    got = _states(levels.run_levels(spark.createDataFrame([("a", None, None)], _LINEAGE)))
    assert got == {"a": (0, levels.ORDERED)}


def test_scripts_behind_a_failed_one_do_not_run(spark, schema, monkeypatch):
    monkeypatch.setattr(gate, "RESULTS_TOGETHER", 2)
    s = schema
    scripts = spark.createDataFrame(
        [
            ("c.sql", f"CREATE TABLE {s}.c AS SELECT * FROM {s}.b; SELECT * FROM {s}.c"),
            ("a.sql", f"CREATE TABLE {s}.a AS SELECT 1 AS x"),
            ("b.sql", f"CREATE TABLE {s}.b AS SELECT x + 1 AS x FROM {s}.a"),
            ("bad.sql", f"CREATE TABLE {s}.bad AS SELECT nothing FROM {s}.a"),
            ("after.sql", f"CREATE TABLE {s}.after AS SELECT 1 AS x FROM {s}.bad"),
            ("last.sql", f"CREATE TABLE {s}.last AS SELECT 1 AS x FROM {s}.after"),
            ("held.sql", f"CREATE TABLE {s}.held AS SELECT 1 AS x FROM {s}.a"),
            ("next.sql", f"SELECT * FROM {s}.held"),
            ("p.sql", f"CREATE TABLE {s}.p AS SELECT * FROM {s}.q"),
            ("q.sql", f"CREATE TABLE {s}.q AS SELECT * FROM {s}.p"),
        ],
        "file_path string, text string",
    )
    decisions = scripts.selectExpr("file_path", "file_path <> 'held.sql' AS ready")
    results, outcomes = gate.run_by_level(spark, scripts, decisions)
    assert {r.file_path: r.outcome for r in outcomes.collect()} == {
        "a.sql": "Success", "b.sql": "Success", "c.sql": "Success", "bad.sql": "Failed",
        "after.sql": "Blocked", "last.sql": "Blocked", "held.sql": "Not ready", "next.sql": "Blocked",
        "p.sql": "cycle", "q.sql": "cycle",
    }
    assert spark.table(f"{s}.c").first().x == 2
    assert {r.file_path for r in results.collect()} == {"a.sql", "b.sql", "c.sql", "bad.sql"}
    assert results.count() == 5
