"""Even time chunks, pages by key, and digest trees."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random
from collections import Counter

import pytest
from conftest import rows

from reconlake.functions.dates import as_temporal
from reconlake.operators import digest_tree, keyset
from reconlake.operators.even_chunks import EvenChunks
from reconlake.plans import exports
from reconlake.queries import fixtures as fx
from reconlake.session import scratch_path

URL = "jdbc:derby:memory:planners;create=true"
DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def times(spark, values):
    made = [(i, v, "x") for i, v in enumerate(values)]
    return spark.createDataFrame(made, "id long, ts timestamp_ntz, begin string")


def test_even_chunks_are_even_up_to_one_instant(spark):
    rng = random.Random(1)
    day = dt.datetime(2024, 3, 1)
    values = [day + dt.timedelta(days=rng.randint(0, 400)) for _ in range(300)]
    values += [day + dt.timedelta(seconds=rng.randint(0, 5000), microseconds=rng.randint(0, 999999)) for _ in range(700)]
    values += [dt.datetime(2024, 7, 7, 7, 7, 7)] * 90 + [dt.datetime(1, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999)]
    values += [dt.datetime(9999, 12, 31, 23, 59, 59)] * 3 + [None] * 4
    df = times(spark, values)
    even = EvenChunks.of(df, "ts", 20)
    plan = {r["chunk_id"]: r for r in even.plan().collect()}
    placed = even.assign(df, "ts").collect()
    assert len(placed) == len(values)
    counted = Counter(r["chunk_id"] for r in placed)
    assert counted.pop(-1) == 4
    assert counted == {c: r["rows"] for c, r in plan.items()}
    for c, n in counted.items():
        instants = Counter(r["ts"] for r in placed if r["chunk_id"] == c)
        assert n < 40 or max(instants.values()) > 20
    for r in placed:
        if r["ts"] is not None:
            span = plan[r["chunk_id"]]
            assert span["start_ts"] <= r["ts"] and (span["end_ts"] is None or r["ts"] < span["end_ts"])
    assert plan[max(plan)]["end_ts"] is None
    ordered = [plan[c] for c in sorted(plan)]
    assert all(a["end_ts"] <= b["start_ts"] for a, b in zip(ordered, ordered[1:]))


def test_even_chunks_of_nothing(spark):
    for df in (times(spark, []), times(spark, [None])):
        even = EvenChunks.of(df, "ts", 5)
        assert even.plan().count() == 0
        assert [r["chunk_id"] for r in even.assign(df, "ts").collect()] == [-1] * df.count()
    path = scratch_path(spark, "none")
    assert exports.export_by_time_even(times(spark, []), path, "ts", 5).check.first()["status"] == "VALIDATION_SUCCESS"


def test_remote_export_in_even_ranges(spark):
    values = [dt.datetime(2024, 1, 1, h % 24, h % 60) for h in range(200)]
    values += [dt.datetime(2900, 5, 5), dt.datetime(9999, 12, 31, 5), None, None]
    df = times(spark, values).drop("begin").withColumnRenamed("id", "n")
    df = df.withColumn("ts", df.ts.cast("timestamp"))
    df.write.jdbc(URL, "clicks", mode="overwrite", properties=DRIVER)
    path = scratch_path(spark, "remote-even")
    export = exports.export_remote_by_time_even(
        spark, URL, "clicks", "ts", path, 30, connections=2, column='"ts"', literal="TIMESTAMP('{}')", part="{part}({column})", **DRIVER
    )
    assert export.check.first()["status"] == "VALIDATION_SUCCESS"
    sizes = {int(r["chunk_id"]): r["rows"] for r in export.manifest.collect()}
    assert sizes.pop(-1) == 2 and sum(sizes.values()) == 202 and max(sizes.values()) < 60
    assert rows(spark.read.parquet(path).select("n")) == rows(df.select("n"))


def plain_pages(keys, size):
    found, at, after, upto = [], 0, None, 0
    for key in sorted(set(keys)):
        n = keys.count(key)
        upto += n
        if upto // size > (upto - n) // size or upto == len(keys):
            found.append((len(found), after, key, upto - at))
            after, at = key, upto
    return found


@pytest.mark.parametrize("kind", ["long", "string", "date", "timestamp_ntz"])
@pytest.mark.parametrize("spread", [3, 40, 100000])
def test_pages_by_key(spark, kind, spread):
    rng = random.Random(spread)
    numbers = [rng.randint(-spread, spread) if rng.random() < 0.7 else 7 for _ in range(500)]
    make = {
        "long": lambda n: n,
        "string": lambda n: f"common prefix {n}" if n % 2 else "é" * (n % 5),
        "date": lambda n: dt.date(2000, 1, 1) + dt.timedelta(days=n),
        "timestamp_ntz": lambda n: dt.datetime(2000, 1, 1) + dt.timedelta(microseconds=n),
    }[kind]
    keys = [make(n) for n in numbers]
    df = spark.createDataFrame([(k, 1) for k in keys] + [(None, 1)] * 3, f"k {kind}, code int")
    pages = keyset.key_pages(df, "k", 60).orderBy("chunk_id").collect()
    in_order = keys if kind != "string" else [k.encode() for k in keys]
    found = [(r[0], *(x.encode() if isinstance(x, str) else x for x in r[1:3]), r[3]) for r in pages]
    assert found == plain_pages(in_order, 60)
    placed = keyset.with_key_page(df, "k", [r["upto_key"] for r in pages]).groupBy("chunk_id").count().collect()
    assert {r["chunk_id"]: r["count"] for r in placed} == {-1: 3, **{r["chunk_id"]: r["rows"] for r in pages}}


def test_pages_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "k long")
    assert keyset.key_pages(df, "k", 5).count() == 0
    with pytest.raises(ValueError, match="pages go by"):
        keyset.key_pages(spark.createDataFrame([(1.5,)], "k double"), "k", 5)


def test_remote_export_by_key(spark):
    keys = [i // 7 for i in range(900)] + [None, None]
    texts = [f"it's {k}" for k in keys]
    df = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(zip(keys, texts))], "n long, k long, t string")
    df.write.jdbc(URL, "items", mode="overwrite", properties={**DRIVER, "createTableColumnTypes": "t varchar(20)"})
    for key in ("k", "t"):
        path = scratch_path(spark, "remote-keys-out")
        export = exports.export_remote_by_key(spark, URL, "items", key, path, 100, connections=3, column=f'"{key}"', **DRIVER)
        assert export.check.first()["status"] == "VALIDATION_SUCCESS"
        assert rows(spark.read.parquet(path).select("n", "k", "t")) == rows(df.select("n", "k", "t"))
        sizes = [r["rows"] for r in export.manifest.collect() if int(r["chunk_id"]) >= 0]
        assert len(sizes) >= 8 and max(sizes) < 108


def test_predicates_quote_text():
    made = keyset.key_predicates("k", [(None, "it's"), ("it's", "z")])
    assert made == ["k <= 'it''s'", "k > 'it''s' AND k <= 'z'", "k IS NULL"]


@pytest.fixture
def trees(spark, sf_dir):
    source, target = fx.orders_pair(spark, sf_dir)
    paths = [scratch_path(spark, "tree") for _ in range(2)]
    for df, path in zip((source, source), paths):
        digest_tree.write_tree(df, path, "o_orderdate", buckets=16)
    return source, target, paths


def test_equal_trees_differ_nowhere(spark, trees):
    _, _, paths = trees
    assert digest_tree.compare_trees(spark, *paths).count() == 0


def _days(df):
    day = as_temporal(df, "o_orderdate")
    return df.withColumn("day", day.cast("date").cast("string"))


def test_only_changed_days_are_written_and_read(spark, trees):
    source, target, paths = trees
    changed = ["1997-03-04", "1998-01-01"]
    copy = _days(source)
    copy = copy.where(~((copy.day == changed[0]) & (copy.o_orderkey % 2 == 0))).drop("day")
    copy = copy.unionByName(_days(source).where(f"day = '{changed[1]}'").drop("day"))
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{_local(paths[1])}/leaves/period=*/*.parquet")}
    digest_tree.update_tree(copy, paths[1], "o_orderdate", changed, buckets=16)
    after = {f: os.path.getmtime(f) for f in glob.glob(f"{_local(paths[1])}/leaves/period=*/*.parquet")}
    touched = {f.split("period=")[1][:7] for f in set(before) ^ set(after)}
    assert touched == {d[:7] for d in changed}
    # leaves of all other days are damaged, and the comparison does not notice
    for path in paths:
        for file in glob.glob(f"{_local(path)}/leaves/period=*/*.parquet"):
            if file.split("period=")[1][:7] not in touched:
                with open(file, "wb") as damaged:
                    damaged.write(b"no parquet")
    found = digest_tree.changed_days(digest_tree.compare_trees(spark, *paths)).collect()
    lost = _days(source).where(f"day = '{changed[0]}' AND o_orderkey % 2 = 0").count()
    twice = _days(source).where(f"day = '{changed[1]}'").count()
    expected = {changed[0]: (lost, lost, 0), changed[1]: (twice, 0, twice)}
    assert {r["day"]: tuple(r)[1:] for r in found} == {d: x for d, x in expected.items() if x[0]}


def _local(path):
    return path.removeprefix("file://")


def test_a_day_can_be_emptied_and_undated_rows_count(spark):
    rows_of = [(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)), (3, None)]
    df = spark.createDataFrame(rows_of, "n int, d date")
    paths = [scratch_path(spark, "tree") for _ in range(2)]
    for path in paths:
        digest_tree.write_tree(df, path, "d", buckets=4, folder="day")
    digest_tree.update_tree(df.where("n = 1"), paths[1], "d", ["2024-01-02", "undated", "2030-01-01"], buckets=4, folder="day")
    found = digest_tree.changed_days(digest_tree.compare_trees(spark, *paths)).collect()
    assert {tuple(r) for r in found} == {("2024-01-02", 1, 1, 0), ("undated", 1, 1, 0)}
    with pytest.raises(ValueError, match="another form"):
        digest_tree.update_tree(df, paths[1], "d", ["2024-01-02"], buckets=8)


def test_trees_of_other_types_are_not_compared(spark):
    paths = [scratch_path(spark, "tree") for _ in range(2)]
    for kind, path in zip(("int", "long"), paths):
        digest_tree.write_tree(spark.createDataFrame([(1, dt.date(2024, 1, 1))], f"n {kind}, d date"), path, "d", buckets=4)
    with pytest.raises(ValueError, match="different forms"):
        digest_tree.compare_trees(spark, *paths)


def test_an_empty_table_has_a_tree(spark):
    df = spark.createDataFrame([], "n int, d date")
    paths = [scratch_path(spark, "tree") for _ in range(2)]
    for path in paths:
        digest_tree.write_tree(df, path, "d", buckets=4)
    assert digest_tree.compare_trees(spark, *paths).count() == 0


@pytest.mark.parametrize("how", ["key", "even", "offset"])
def test_many_small_chunks_share_a_bounded_number_of_folders(spark, monkeypatch, how):
    monkeypatch.setattr(exports, "MOST_FOLDERS", 4, raising=False)
    day = dt.datetime(2024, 3, 1)
    values = [(i, day + dt.timedelta(minutes=7 * i)) for i in range(300)]
    missing = [] if how == "offset" else [(None, None)] * 2
    df = spark.createDataFrame([*values, *missing], "k long, ts timestamp_ntz")
    path = scratch_path(spark, "folders")
    if how == "key":
        export = exports.export_by_key(df, path, "ts", 10)
    elif how == "even":
        export = exports.export_by_time_even(df, path, "ts", 10)
    else:
        export = exports.export_by_offset(df, path, 10, ["k"])
    assert len(glob.glob(f"{_local(path)}/*=*")) <= 5 + bool(missing)
    assert export.check.first()["status"] == "VALIDATION_SUCCESS"
    manifest = export.manifest.collect()
    assert len(manifest) >= 20 and sum(r["rows"] for r in manifest) == df.count()
    written = spark.read.parquet(path)
    assert rows(written.select(*df.columns)) == rows(df)
    for r in manifest[::7]:
        chunk = spark.read.parquet(r["path"]).where(f"chunk_id = {r['chunk_id']}")
        assert chunk.count() == r["rows"]
    if export.plan is not None:
        planned = {r["chunk_id"]: r["rows"] for r in export.plan.collect()}
        assert planned == {r["chunk_id"]: r["rows"] for r in manifest if r["chunk_id"] >= 0}


def test_pages_are_planned_once(spark, monkeypatch):
    df = spark.range(100).toDF("k")
    asked, found = [], keyset.key_pages
    monkeypatch.setattr(keyset, "key_pages", lambda *a: asked.append(a) or found(*a))
    export = exports.export_by_key(df, scratch_path(spark, "once"), "k", 10)
    assert [tuple(r) for r in export.plan.orderBy("chunk_id").limit(2).collect()] == [(0, None, 9, 10), (1, 9, 19, 10)]
    assert len(asked) == 1
