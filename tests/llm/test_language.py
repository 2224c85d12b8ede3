from __future__ import annotations

import zlib

from odd_rows import ROWS, empty, frame

from reconlake.llm import language


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = language.identify(docs, language.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    tested = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert len(tested) > 50 and sum(tested) / len(tested) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_prediction_ignores_everything_but_the_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = language.learn(docs)
    hidden = docs.selectExpr("doc_id + 1 AS doc_id", "text", "'xx' AS lang", "'s' AS source")
    a = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, found).collect()}
    b = {r.doc_id - 1: (r.lang_pred, r.score) for r in language.identify(hidden, found).collect()}
    assert a == b


def test_odd_rows(spark):
    rows = frame(spark)
    found = language.learn(rows)
    got = language.identify(rows, found).collect()
    assert len(got) == len(ROWS)
    without_letters = {r[1] for r in ROWS if not any(c.isalpha() for c in r[1] or "")}
    assert without_letters == {None, "", " \t\n", "12 34 !!"}
    und = [r for r in got if r.lang_pred == language.UNDETERMINED]
    assert len(und) == sum(r[1] in without_letters for r in ROWS)
    assert all(r.score == 0 for r in und)
    kept = language.identified(rows, found, 0.0)
    assert kept.columns == rows.columns and kept.count() == len(ROWS) - len(und)


def test_nothing_to_learn_from(spark):
    found = language.learn(empty(spark))
    assert found.languages == ()
    assert {r.lang_pred for r in language.identify(frame(spark), found).collect()} == {language.UNDETERMINED}
    assert language.identify(empty(spark), found).collect() == []


def test_pieces_of_a_long_text_count_as_one(monkeypatch):
    text = "Die größte Überraschung, und noch 1 mehr. " * 50
    whole = [a.tolist() for a in language.trigrams(text)]
    monkeypatch.setattr(language, "_PIECE", 17)
    assert [a.tolist() for a in language.trigrams(text)] == whole
