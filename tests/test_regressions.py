"""One test for each behaviour that was decided on in the survey (B1 - B29)."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from reconlake.functions import dates, status, text
from reconlake.functions.columns import align_to
from reconlake.functions.hashing import row_hash
from reconlake.operators import audit, chunks
from reconlake.operators import counts as C
from reconlake.operators import lineage as L
from reconlake.operators import repair as R
from reconlake.operators import row_hashes as H
from reconlake.operators.incremental import incremental_rows
from reconlake.plans import exports, gate, loads


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_b1_null_position_and_separators_do_not_collide(spark):
    df = frame(
        spark,
        [("a", None, "b"), ("a", "b", None), ("a|b", None, None), ("a", "b", ""), ("a||b", "", "")],
        "x string, y string, z string",
    )
    assert df.select(row_hash(df, mode="compat")).distinct().count() < 5
    assert df.select(row_hash(df)).distinct().count() == 5


def test_b2_column_order_does_not_matter(spark):
    a = frame(spark, [(1, "x")], "k int, v string")
    b = frame(spark, [("x", 1)], "v string, K int")
    assert H.compare_rows(a, b).first().validation_status == status.MATCH
    with pytest.raises(ValueError):
        align_to(b, ["k", "other"])


def test_b3_lost_copies_are_reported(spark):
    a = frame(spark, [(1,), (1,), (2,)], "k int")
    b = frame(spark, [(1,), (2,)], "k int")
    r = H.compare_rows(a, b).first()
    assert (r.validation_status, r.multiset_status) == (status.MATCH, status.NOT_MATCH)
    assert (r.uneven_copies, r.rows_lost, r.rows_added) == (1, 1, 0)


def test_b4_time_text_is_placed_on_a_real_date(spark):
    df = frame(spark, [("10:20:30",), ("23:59:59",)], "t string")
    out = R.repair(df, {"t": "timestamp"})
    assert rows(out.select(F.col("t").cast("string"))) == [
        ("1970-01-01 10:20:30",),
        ("1970-01-01 23:59:59",),
    ]


def test_b5_epoch_seconds(spark):
    df = frame(spark, [(1700000000,)], "t bigint")
    out = R.repair(df, {"t": "timestamp"}).select(dates.utc_clock(F.col("t"))).first()[0]
    assert out == dt.datetime(2023, 11, 14, 22, 13, 20)


def test_b6_one_odd_value_does_not_decide(spark):
    # the first value has 9 digits, a negative one 10 characters
    df = frame(spark, [(999999999,), (1700000000,), (1700000001,), (-1234567890,)], "t bigint")
    (d,) = R.profile(df, {"t": "timestamp"})
    assert (d.kind, d.values, d.matching) == ("epoch_seconds", 4, 3)
    assert R.repair(df, {"t": "timestamp"}).filter("t IS NULL").isEmpty()


def test_b7_null_rows_are_found_again(spark):
    new = frame(spark, [(1, None), (2, "b"), (3, None)], "k int, v string")
    old = frame(spark, [(1, None), (2, "b")], "k int, v string")
    assert rows(incremental_rows(new, old)) == [(3, None)]
    assert rows(incremental_rows(new, old, null_safe=False)) == [(1, None), (3, None)]


def test_b7_equality_follows_sql(spark):
    new = frame(spark, [(0.0,), (float("nan"),), (None,), (1.0,)], "x double")
    old = frame(spark, [(-0.0,), (float("nan"),), (None,)], "x double")
    assert rows(incremental_rows(new, old)) == [(1.0,)]


def test_b8_b9_rows_are_counted_as_written_and_copies_kept(spark, schema):
    table = f"{schema}.t"
    loads.full_load(frame(spark, [(1, "2025-01-01")], "k int, d string"), table)
    new = frame(
        spark, [(2, "2025-04-01"), (2, "2025-04-01"), (3, "2025-02-01")], "k int, d string"
    )
    first = loads.incremental_load(new, table, "d", "2025-03-01")
    assert (first.status, first.target_rows) == (audit.SUCCESS, 2)
    again = loads.incremental_load(new, table, "d", "2025-03-01")
    assert again.target_rows == 0
    assert spark.table(table).count() == 3


def test_b10_no_date_column_is_skipped_and_missing_target_is_an_error(spark, schema):
    df = frame(spark, [(1,)], "k int")
    loads.full_load(df, f"{schema}.t")
    assert loads.incremental_load(df, f"{schema}.t", None, "2025-01-01").status == audit.SKIPPED
    assert loads.incremental_load(df, f"{schema}.none", "k", "2025-01-01").status == audit.ERROR


def test_b11_skip_statuses(spark):
    t = dt.datetime(2025, 1, 1)
    log = audit.events(
        spark,
        [
            audit.finished("r1", "a", t, t, audit.SUCCESS),
            audit.finished("r2", "b", t, t, audit.ERROR),
            audit.started("r3", "c", t),
        ],
    )
    tasks = frame(spark, [("a",), ("b",), ("c",), ("d",)], "table_name string")
    assert rows(audit.pending(tasks, log)) == [("b",), ("c",), ("d",)]
    strict = audit.pending(tasks, log, (audit.SUCCESS, audit.ERROR))
    assert rows(strict) == [("c",), ("d",)]


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_b12_offset_chunks_partition_the_rows(spark, tmp_path, keys):
    df = spark.range(0, 2503, 1, 7).select((F.col("id") % 5).alias("k"), F.col("id").alias("v"))
    out = exports.export_by_offset(df, str(tmp_path / "out"), 100, keys)
    sizes = [r.rows for r in out.manifest.orderBy("chunk_id").collect()]
    assert sizes == [100] * 25 + [3]
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows(back.select("k", "v")) == rows(df)
    if keys:
        spans = back.groupBy("chunk_id").agg(F.min("k").alias("a"), F.max("k").alias("b"))
        ordered = spans.orderBy("chunk_id").collect()
        assert all(x.b <= y.a for x, y in zip(ordered, ordered[1:]))


def test_b13_rows_without_time_are_exported(spark, tmp_path):
    df = frame(
        spark,
        [(1, dt.datetime(2025, 1, 1)), (2, None), (3, dt.datetime(2025, 3, 1))],
        "k int, ts timestamp",
    )
    out = exports.export_by_time(df, str(tmp_path / "out"), "ts", 30)
    assert rows(out.manifest.select("chunk_id", "rows")) == [(-1, 1), (0, 1), (1, 1)]
    r = out.check.first()
    assert tuple(r) == (3, 3, 3, status.VALIDATION_SUCCESS)


def test_b13_only_missing_times(spark, tmp_path):
    df = frame(spark, [(1, None)], "k int, ts timestamp")
    out = exports.export_by_time(df, str(tmp_path / "out"), "ts")
    assert rows(out.manifest.select("chunk_id", "rows")) == [(-1, 1)]


def test_b14_failing_source_leaves_the_table_alone(spark, schema):
    table = f"{schema}.t"
    loads.guarded_load(frame(spark, [(1, "x")], "k int, v string"), table)
    bad = frame(spark, [(1, "x")], "k int, v string").withColumn(
        "v", F.raise_error(F.lit("broken")).cast("string")
    )
    with pytest.raises(Exception):
        loads.guarded_load(bad, table)
    assert rows(spark.table(table)) == [(1, "x")]


def test_b14_table_can_be_rebuilt_from_itself(spark, schema):
    table = f"{schema}.t"
    loads.guarded_load(frame(spark, [(1,), (2,)], "k int"), table)
    out = loads.guarded_load(spark.table(table).filter("k > 1"), table)
    assert (out.status, out.target_rows) == (status.VALIDATION_SUCCESS, 1)
    assert rows(spark.table(table)) == [(2,)]


def test_b15_b16_one_log_with_full_errors_and_real_nulls(spark, schema):
    log = f"{schema}.audit"
    good = loads.audited(spark, log, "a", lambda: loads.LoadResult("a", audit.SUCCESS, 5, 5))
    message = "something 'quoted' went wrong"

    def fail():
        raise ValueError(message)

    bad = loads.audited(spark, log, "b", fail)
    assert (good.status, bad.status) == (audit.SUCCESS, audit.ERROR)
    last = {r.table_name: r.status for r in audit.latest_status(spark.table(log)).collect()}
    assert last == {"a": audit.SUCCESS, "b": audit.ERROR}
    events = spark.table(log)
    assert events.filter("table_name = 'b'").filter(F.col("error_message") == message).count() == 1
    assert events.filter("table_name = 'a' AND error_message IS NULL").count() == 2
    assert loads.audited(spark, log, "a", fail).status == audit.SKIPPED
    assert rows(audit.run_summary(events)) == [("ERROR", 1), ("IN_PROGRESS", 2), ("SUCCESS", 1)]


def test_b17_missing_side_is_a_row(spark):
    df = frame(spark, [(1,)], "k int")
    pairs = [C.TablePair("a", df, df), C.TablePair("b", df, None, None, None, "not there")]
    out = {r.table_name: r for r in H.reconcile_hashes(pairs).collect()}
    assert out["a"].validation_status == status.MATCH
    assert (out["b"].validation_status, out["b"].error_message) == (status.NOT_MATCH, "not there")
    assert out["b"].source_hash_count is None


def test_b17_all_sides_missing(spark):
    df = frame(spark, [(1,)], "k int")
    out = H.reconcile_hashes([C.TablePair("b", None, df, None, "gone")]).first()
    assert (out.validation_status, out.error_message) == (status.NOT_MATCH, "gone")
    both = H.reconcile_hashes([C.TablePair("b", None, None, None, "gone", "lost")]).first()
    assert both.error_message == "gone; lost"


def test_empty_copies_match(spark):
    df = frame(spark, [], "k int, d date")
    assert H.reconcile_hashes([C.TablePair("a", df, df)]).first().validation_status == status.MATCH
    totals = C.reconcile_totals(spark, [C.TablePair("s.a", df, df)]).first()
    assert (totals.source_count, totals.catalog_count, totals.status) == (0, 0, status.SUCCESS)
    months = C.reconcile_months(spark, [C.TablePair("s.a", df, df)]).first()
    assert (months.source_count, months.validation_status) == (0, status.SUCCESS)


def test_b18_b24_notes_are_rows(spark):
    d = frame(spark, [(dt.date(2020, 1, 1),)], "d date")
    pairs = [
        C.TablePair("old", d, d, "d"),
        C.TablePair("dateless", d, d),
        C.TablePair("gone", None, d, "d", "no such table"),
    ]
    out = {r.target_table_name: r for r in C.reconcile_days(spark, pairs, "2025-01-01").collect()}
    assert out["old"].validation_status == "not_data_found_since_2025-01-01"
    assert out["old"].source_count is None
    assert out["dateless"].validation_status == status.SKIPPED_NO_DATE
    assert out["gone"].validation_status.startswith("ERROR")
    since = C.reconcile_days(spark, pairs, "2019-01-01")
    assert since.filter("target_table_name = 'old'").first().validation_status == status.SUCCESS


def test_b19_days_that_only_the_target_has_stay_visible(spark):
    a = frame(spark, [(dt.date(2025, 1, 1),)], "d date")
    b = frame(spark, [(dt.date(2025, 1, 1),), (dt.date(2025, 1, 2),)], "d date")
    all_days = C.three_way(C.day_counts(a, b, "d"))
    assert rows(all_days.select("dpDay", "validation_status")) == [
        (1, "Success"),
        (2, "Not Applicable"),
    ]
    assert C.three_way(C.day_counts(a, b, "d"), common_days_only=True).count() == 1


def test_b20_dateless_scripts_pass_on_totals(spark):
    lineage = frame(spark, [("a.sql", ["s.t"])], "file_path string, source_table_names array<string>")
    totals = frame(spark, [("s.t", 3, 3)], "table_name string, source_count long, target_count long")
    verdicts = gate.total_verdicts(totals)
    assert gate.decide(lineage, verdicts, "2025-01-01").first().ready
    assert gate.decide(lineage, verdicts, "2025-01-01", True).first().reason == "no date column"


def test_b21_b22_statements(spark):
    script = "SELECT 1 ;\n\n ; SELECT ';' AS x;\t-- done\n"
    scripts = frame(spark, [("d/a.sql", script)], "file_path string, text string")
    cut = [r.query for r in L.statements(scripts).orderBy("position").collect()]
    assert cut == ["SELECT 1", "SELECT '", "' AS x", "-- done"]
    decisions = frame(spark, [("d/a.sql", True)], "file_path string, ready boolean")
    out = gate.run_scripts(spark, scripts, decisions)
    assert [r.status for r in out.orderBy("position").collect()][:2] == ["Success", "Failed"]
    assert L.execution_status(out).first().execution_status == "Failed"


def test_b23_lineage_patterns(spark):
    script = """
    -- from old.comment
    MERGE INTO m.a USING x JOIN  r.b ON 1 = 1; INSERT into m.c select * FROM r.d, r.e;
    CREATE TABLE IF NOT EXISTS m.f (a int); update m.g set a = 1; select * from plain; from "q"."z"
    join cat.sch.tab on true; truncate table größe.tafel_1
    """
    df = frame(spark, [("a", script)], "file_path string, text string")
    r = L.script_lineage(df).first()
    assert r.source_table_names == ["cat.sch", "old.comment", "r.b", "r.d"]
    assert r.target_table_names == ["größe.tafel_1", "m.a", "m.c", "m.g"]
    assert "m.f" in L.script_lineage(df, allow_exists=True).first().target_table_names


def test_b25_one_predicate_on_both_sides(spark):
    a = frame(spark, [(dt.datetime(2025, 1, 1, 0, 0),), (dt.datetime(2024, 12, 31, 23, 59),)], "d timestamp_ntz")
    for side in (a, a.withColumn("d", F.col("d").cast("string"))):
        assert dates.since(side, "d", "2025-01-01").count() == 1


def test_b26_sides_are_named_correctly(spark):
    a = frame(spark, [(dt.date(2025, 1, 1),)] * 3, "d date")
    b = frame(spark, [(dt.date(2025, 1, 1),)], "d date")
    r = C.day_counts(a, b, "d").first()
    assert (r.source_count, r.target_count) == (3, 1)


def test_b27_one_failing_table_does_not_hide_others(spark, schema):
    loads.full_load(frame(spark, [(1,)], "k int"), f"{schema}.a")
    spark.sql(f"CREATE SCHEMA {schema}_copy")
    log = loads.copy_tables(
        spark, ["gone", "a"], lambda n: f"{schema}.{n}", lambda n: f"{schema}_copy.{n}"
    )
    assert {r.table_name: r.status for r in log.collect()} == {"gone": "FAILED", "a": "SUCCESS"}
    assert log.filter("table_name = 'gone'").first().error_message


def test_b29_counts_come_from_the_tables(spark):
    df = frame(spark, [(1,), (2,)], "k int")
    out = C.reconcile_totals(spark, [C.TablePair("s.a", df, df.limit(1))], "old", "new").first()
    assert (out.source_count, out.catalog_count, out.status) == (2, 1, status.FAIL)
    assert (out.source_table, out.catalog_table) == ("old.s.a", "new.s.a")


def test_negative_milliseconds_round_toward_zero(spark):
    df = frame(spark, [(-1500,)], "t bigint")
    out = df.select(dates.utc_clock(dates.from_epoch_millis(F.col("t"))).alias("x")).first().x
    assert out == dt.datetime(1969, 12, 31, 23, 59, 59)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_clock_arithmetic_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.000001' AS a")
        r = df.select(dates.clock_micros(F.col("a")).alias("us")).first()
        assert r.us == 1710037800000001
        bounds = spark.sql(
            "SELECT timestamp_ntz'2024-03-01 00:00:00' AS ts UNION ALL "
            "SELECT timestamp_ntz'2024-03-31 00:00:00'"
        )
        plan = chunks.time_plan(chunks.time_bounds(bounds, "ts"), 30)
        assert [r.chunk_id for r in plan.orderBy("chunk_id").collect()] == [0, 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_name_helpers(spark):
    df = frame(spark, [("cat_x.s.t", "a/b/c.sql")], "n string, p string")
    r = df.select(
        text.name_part(F.col("n"), 2),
        text.name_part(F.col("n"), 9),
        text.without_prefix(F.col("n"), "cat_x"),
        text.without_prefix(F.col("n"), "cat"),
        text.base_name(F.col("p")),
        text.short_error(F.lit("e" * 300)),
    ).first()
    assert tuple(r)[:5] == ("s", None, "s.t", "cat_x.s.t", "c.sql")
    assert len(r[5]) == 200


def test_b27_report_isolates_a_table_that_fails_while_running(spark, schema):
    from reconlake.plans.reports import write_report

    good = frame(spark, [(dt.date(2025, 1, 1),)], "d date")
    bad = good.withColumn("d", F.raise_error(F.lit("broken file")).cast("date"))
    pairs = [C.TablePair(n, bad if n == "c" else good, good, "d") for n in "abcde"]
    table = f"{schema}.days"
    write_report(pairs, lambda p: C.reconcile_days(spark, p, "2025-01-01"), table, 4)
    out = {r.target_table_name: r.validation_status for r in spark.table(table).collect()}
    assert {n for n, s in out.items() if s == status.SUCCESS} == set("abde")
    assert "broken file" in out["c"] and spark.table(table).count() == 5


def test_different_columns_are_a_row_of_the_report(spark):
    a = frame(spark, [(1, dt.date(2025, 1, 1))], "k int, d date")
    b = frame(spark, [(1, dt.date(2025, 1, 1))], "k int, happened date")
    pairs = [C.TablePair("same", a, a, "D"), C.TablePair("other", a, b, "d")]
    hashes = {r.table_name: r for r in H.reconcile_hashes(pairs).collect()}
    assert hashes["same"].validation_status == status.MATCH
    assert hashes["other"].validation_status == status.NOT_MATCH
    assert "missing ['d']" in hashes["other"].error_message
    since = {r.table_name: r for r in H.reconcile_hashes(pairs, "2025-01-01").collect()}
    assert since["other"].error_message == "no column d"
    for report in (
        C.reconcile_days(spark, pairs, "2025-01-01"),
        C.reconcile_months(spark, pairs),
    ):
        out = {r.target_table_name: r.validation_status for r in report.collect()}
        assert out == {
            "same": status.SUCCESS,
            "other": "ERROR: target missing/access - no column d",
        }
