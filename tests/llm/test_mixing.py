from __future__ import annotations

import pytest
from odd_rows import empty, frame
from pyspark.sql import functions as F

from reconlake.llm import mixing


def shared(sizes, weights=(3, 1, 2)):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[n] for n in full)
        free = [n for n in names if n not in full]
        level = {n: rest * weight[n] / sum(weight[m] for m in free) for n in free}
        above = [n for n in free if level[n] >= 2 * sizes[n]]
        if not above:
            return {n: 2.0 * sizes[n] if n in full else level[n] for n in names}
        full |= set(above)


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 10, "c": 7, None: 300},
        {"a": 1, "b": 1000, "c": 1},
        {"x": 50},
        {f"s{i}": (i * 37) % 11 + 1 for i in range(17)},
    ],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(shared(sizes))


def test_words(spark):
    texts = [None, "", " \n", "a", " a  b\tc\x0bd ", "a\xa0b\x1cc", "x" * 100]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in rows.select(mixing.word_count(F.col("t"))).collect()] == [0, 0, 0, 1, 4, 1, 1]


def test_sources_come_near_their_targets(spark):
    texts = [("w " * (1 + i % 40), f"s{i % 5}" if i % 3 else "hot", i) for i in range(3000)]
    docs = spark.createDataFrame(texts, "text string, source string, doc_id long")
    mix = mixing.Mix(docs)
    rows = mix.decisions().join(docs.select("doc_id", "source"), "doc_id").collect()
    taken, target = {}, {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= 40 for s in taken)
    again = mixing.Mix(docs).decisions()
    assert sorted(map(tuple, again.collect())) == sorted(tuple(r)[:-1] for r in rows)
    whole = mix.documents()
    assert whole.columns == docs.columns
    assert whole.count() == sum(r.copies for r in rows)


def test_odds_change_who_is_taken(spark):
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 1900, "a").otherwise("b").alias("source"),
        F.when(F.col("id") % 2 == 0, 20.0).otherwise(1.0).alias("odds"),
    )
    mix = mixing.Mix(docs, share=0.5, odds="odds")
    extra = mix.decisions().where("doc_id < 1900").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("copies").alias("n"))
    n = {r.odd: r.n for r in extra.collect()}
    assert n[0] > 2 * n[1]


def test_odd_rows(spark):
    rows = frame(spark)
    mix = mixing.Mix(rows)
    decided = mix.decisions().collect()
    assert len(decided) == rows.count()
    assert all(r.taken <= 2 * r.size and r.copies <= 2 for r in decided)
    assert mix.documents().columns == rows.columns
    assert mixing.Mix(empty(spark)).decisions().collect() == []
    assert mixing.Mix(empty(spark)).documents().collect() == []
