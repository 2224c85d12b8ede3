"""Alignment of two schemas: what was inserted, dropped, moved, renamed or retyped."""

from __future__ import annotations

from collections import Counter

from reconlake.operators.alignment import align_schemas

_SHEET = "schema_name string, table_name string, column_name string, data_type string, ordinal_position int"


def _sheet(spark, columns, table="t"):
    rows = [(None, table, *c.split(), i) for i, c in enumerate(columns, start=1)]
    return spark.createDataFrame(rows, _SHEET)


def _changes(spark, source, target):
    out = align_schemas(_sheet(spark, source), _sheet(spark, target)).collect()
    return {(r.source_column, r.target_column): r.change for r in out if r.change != "same"}, len(out)


_BASE = ["id bigint", "name string", "price double", "day date", "note string"]


def test_one_inserted_column_is_one_change(spark):
    assert _changes(spark, _BASE, [_BASE[0], "extra int", *_BASE[1:]]) == ({(None, "extra"): "inserted"}, 6)
    assert _changes(spark, _BASE, _BASE[1:]) == ({("id", None): "dropped"}, 5)


def test_renamed_needs_type_and_place(spark):
    renamed = [_BASE[0], "title string", *_BASE[2:]]
    assert _changes(spark, _BASE, renamed)[0] == {("name", "title"): "renamed"}
    other_type = [_BASE[0], "title int", *_BASE[2:]]
    assert _changes(spark, _BASE, other_type)[0] == {("name", None): "dropped", (None, "title"): "inserted"}
    elsewhere = [_BASE[0], *_BASE[2:], "title string"]
    assert _changes(spark, _BASE, elsewhere)[0] == {("name", None): "dropped", (None, "title"): "inserted"}


def test_moves_are_as_few_as_possible(spark):
    moved, _ = _changes(spark, _BASE, [*_BASE[1:], "ID bigint"])
    assert moved == {("id", "id"): "moved"}
    swapped, _ = _changes(spark, _BASE, [_BASE[1], _BASE[0], *_BASE[2:]])
    assert Counter(swapped.values()) == {"moved": 1}
    retyped, _ = _changes(spark, _BASE, [*_BASE[:4], "note int"])
    assert retyped == {("note", "note"): "retyped"}


def test_repeated_names_missing_tables_and_empty_sheets(spark):
    twice = ["a int", "a int", "b int"]
    assert _changes(spark, twice, ["a int", "b int"])[0] == {("a", None): "dropped"}
    assert set(_changes(spark, _BASE, [])[0].values()) == {"dropped"}
    assert set(_changes(spark, [], _BASE)[0].values()) == {"inserted"}
    assert _changes(spark, [], []) == ({}, 0)


def test_a_wide_table(spark):
    source = [f"c{i} int" for i in range(1500)]
    target = [f"c{i} int" for i in range(1, 1500)] + ["c0 int"]
    assert _changes(spark, source, target) == ({("c0", "c0"): "moved"}, 1500)
