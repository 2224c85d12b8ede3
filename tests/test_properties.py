"""Properties that hold for any input, and skewed inputs against brute force."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reconlake.operators import chunks
from reconlake.operators import counts as C
from reconlake.operators import repair as R
from reconlake.operators import row_hashes as H
from reconlake.operators.incremental import incremental_rows
from reconlake.plans import exports
from reconlake.queries import fixtures as fx
from reconlake.queries.repairs import DECLARED, encoded_events

SCHEMA = "k int, v string, d date"
ROW = st.tuples(
    st.one_of(st.none(), st.integers(0, 3)),
    st.one_of(st.none(), st.sampled_from(["", "a", "|", "1:a", "N"])),
    st.one_of(st.none(), st.dates(dt.date(2024, 12, 28), dt.date(2025, 1, 3))),
)
few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@few
@given(st.lists(ROW, max_size=12), st.lists(ROW, max_size=12))
def test_hash_compare_is_multiset_compare(spark, a, b):
    r = H.compare_rows(table(spark, a), table(spark, b)).first()
    x, y = Counter(a), Counter(b)
    assert r.matched_hash_count == len(set(x) & set(y))
    assert (r.source_only, r.target_only) == (len(set(x) - set(y)), len(set(y) - set(x)))
    assert (r.rows_lost, r.rows_added) == (sum((x - y).values()), sum((y - x).values()))
    assert H.summarize(H.row_profile(table(spark, a), table(spark, b))).first() == r
    assert (r.multiset_status == "Match") == (x == y)


@few
@given(st.lists(ROW, max_size=12), st.lists(ROW, max_size=12))
def test_incremental_is_what_is_missing(spark, a, b):
    new, old = table(spark, a), table(spark, b)
    got = Counter(tuple(r) for r in incremental_rows(new, old).collect())
    assert got == Counter(r for r in a if r not in set(b))
    assert incremental_rows(new, old.union(new)).isEmpty()


@few
@given(st.lists(ROW, max_size=12), st.lists(ROW, max_size=12))
def test_day_counts_are_counts(spark, a, b):
    days = C.day_counts(table(spark, a), table(spark, b), "d", "2025-01-01").collect()
    got = {dt.date(r.dpYear, r.dpMonth, r.dpDay): (r.source_count, r.target_count) for r in days}
    since = dt.date(2025, 1, 1)
    x = Counter(r[2] for r in a if r[2] and r[2] >= since)
    y = Counter(r[2] for r in b if r[2] and r[2] >= since)
    assert got == {d: (x[d], y[d]) for d in set(x) | set(y)}


def test_copy_of_itself_matches(spark, sf_dir):
    for name in fx.TABLES:
        df = fx.table(spark, sf_dir, name)
        r = H.compare_rows(df, df).first()
        assert (r.validation_status, r.multiset_status, r.rows_lost) == ("Match", "Match", 0), name


def test_repair_twice_changes_nothing(spark, sf_dir):
    once = R.repair(encoded_events(spark, sf_dir), DECLARED)
    twice = R.repair(once, DECLARED)
    assert twice.schema == once.schema
    assert H.compare_rows(once, twice).first().multiset_status == "Match"


def test_only_declared_columns_are_repaired(spark, sf_dir):
    out = R.repair(encoded_events(spark, sf_dir), DECLARED)
    kinds = dict(out.dtypes)
    assert kinds["raw_s"] == "bigint"
    assert {kinds[c] for c in ("epoch_s", "epoch_ms", "ts_text", "time_text")} == {"timestamp"}
    assert {kinds[c] for c in ("ymd", "epoch_day", "nothing")} == {"date"}


def test_hot_row_keeps_all_copies(spark):
    """A third of all rows are copies of one; the pieces put every copy back."""
    hot = spark.range(5003).select(F.lit(7).alias("k"), F.lit(None).cast("string").alias("v"))
    rest = spark.range(10_000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("v"))
    new = hot.union(rest)
    known = rest.filter("k % 2 = 0")
    out = incremental_rows(new, known)
    assert out.filter("v IS NULL").count() == 5003
    assert out.filter("v = 'x'").count() == 5000
    assert incremental_rows(new, new.limit(0), dedupe=True).count() == 10_001
    assert incremental_rows(new, hot.union(known)).count() == 5000


def test_hot_time_range_is_exported_whole(spark, tmp_path):
    hot = spark.range(20_000).select(F.lit("2025-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), "id")
    rest = spark.range(100).select(
        F.timestamp_add("DAY", F.col("id") + 40, F.lit("2025-01-01").cast("timestamp_ntz")).alias("ts"), "id"
    )
    df = hot.union(rest)
    out = exports.export_by_time(df, str(tmp_path / "x"), "ts", 30)
    assert out.check.first().status == "VALIDATION_SUCCESS"
    sizes = {r.chunk_id: r.rows for r in out.manifest.collect()}
    assert sizes[0] == 20_000 and sum(sizes.values()) == 20_100


def test_equal_keys_are_split_over_chunks(spark, tmp_path):
    df = spark.range(5000).select(F.lit(1).alias("k"))
    out = exports.export_by_offset(df, str(tmp_path / "x"), 1000, ["k"])
    assert [r.rows for r in out.manifest.collect()] == [1000] * 5


def test_time_manifest_lists_empty_ranges(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2025, 1, 1),), (dt.datetime(2025, 3, 15),), (None,)], "ts timestamp_ntz"
    )
    got = {r.chunk_id: r.rows for r in chunks.time_manifest(df, "ts", 30).collect()}
    assert got == {-1: 1, 0: 1, 1: 0, 2: 1}


def test_time_plan_of_an_empty_table(spark):
    df = spark.createDataFrame([], "ts timestamp_ntz")
    assert chunks.time_manifest(df, "ts").isEmpty()


# ---- shape of plans


def test_date_filter_reaches_the_scan(spark, sf_dir):
    df = fx.table(spark, sf_dir, "orders")
    plan = plan_of(C.day_counts(df, df, "o_orderdate", "1996-06-01"))
    assert plan.count("GreaterThanOrEqual(o_orderdate,1996-06-01T00:00") >= 2
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_total_counts_read_no_column(spark, sf_dir):
    df = fx.table(spark, sf_dir, "lineitem")
    plan = plan_of(C.reconcile_totals(spark, [C.TablePair("a.b", df, df)]))
    assert "ReadSchema: struct<>" in plan


def test_hash_compare_has_no_join_and_one_shuffle_of_rows(spark, sf_dir):
    df = fx.table(spark, sf_dir, "orders")
    plan = plan_of(H.compare_rows(df, df))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    # copies are merged before the exchange
    assert plan.count("partial_count") >= 2


def test_many_tables_share_one_shuffle(spark, sf_dir):
    pairs = [
        C.TablePair(n, fx.table(spark, sf_dir, n), fx.table(spark, sf_dir, n)) for n in fx.TABLES
    ]
    plan = plan_of(H.reconcile_hashes(pairs))
    assert plan.count("Exchange hashpartitioning(table_name") <= 3


def test_incremental_has_one_shuffle_of_rows_and_no_join(spark, sf_dir):
    df = fx.table(spark, sf_dir, "orders")
    plan = plan_of(incremental_rows(df, df, dedupe=True))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert plan.count("partial_count") >= 1


@few
@given(st.lists(ROW, max_size=12), st.lists(ROW, max_size=12), st.sampled_from([1, 4]))
def test_bucketed_differences_are_the_differences(spark, a, b, buckets):
    x, y = table(spark, a), table(spark, b)
    plain = Counter(tuple(r) for r in H.differing_rows(x, y).collect())
    assert Counter(tuple(r) for r in H.differing_rows(x, y, buckets=buckets).collect()) == plain
    assert len(plain) == len([k for k in set(a) | set(b) if a.count(k) != b.count(k)])


def test_export_by_time_balances_its_write(spark, sf_dir):
    from reconlake.sinks.tables import balanced

    df = chunks.with_time_chunk(fx.table(spark, sf_dir, "events"), "ts", dt.datetime(2024, 1, 1), 7)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(balanced(df, chunks.CHUNK))
