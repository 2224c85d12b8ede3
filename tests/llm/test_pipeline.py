"""The pipeline against plain Python, stage by stage, and the queries with SQL."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import compare
import numpy as np
import public_tokenizers
import pytest
from odd_rows import frame
from test_mixing import shared
from test_simhash import plain_components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from reconlake.llm import language, queries


def plain_language(docs):
    counts: dict[str, dict[int, int]] = {}
    for d in docs:
        if d.lang is not None and zlib.crc32(str(d.doc_id).encode()) % 3 != 1:
            own = counts.setdefault(d.lang, {})
            for code, n in zip(*[a.tolist() for a in language.trigrams(d.text)]):
                own[code] = own.get(code, 0) + n
    bundles = {
        lang: np.array([n[c] for c in sorted(n)], float) @ language.trigram_vectors(np.array(sorted(n))).astype(float)
        for lang, n in counts.items()
    }
    found = language.profiles(bundles)
    kept = []
    for d in docs:
        (name,), (score,) = found.predict([d.text])
        if name != "und" and score >= corpus_pipeline.LEAST_LANGUAGE_SCORE:
            kept.append(d)
    return kept


def plain_dedup(docs):
    prints = [(d.doc_id, plain_fingerprint(d.text)) for d in docs]
    stay = {c for _, _, c in plain_components(prints)}
    return [d for d in docs if d.doc_id in stay]


def plain_decontaminated(docs, items):
    words = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+")
    windows = {}
    for item in items:
        w = words.findall(item.text.lower())
        windows[item.item_id] = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    kept = []
    for d in docs:
        w = words.findall(d.text.lower())
        there = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        if not any(x and sum(y in there for y in x) >= 0.8 * len(x) - 1e-9 for x in windows.values()):
            kept.append(d)
    return kept


def plain_mix(docs):
    size = {d.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", d.text)) for d in docs}
    sources: dict[str, int] = {}
    for d in docs:
        sources[d.source] = sources.get(d.source, 0) + size[d.doc_id]
    target, mixed = shared(sources), []
    for name, total in sources.items():
        whole = int(target[name] / total)
        fraction = target[name] / total - whole
        own = [d for d in docs if d.source == name]
        mixed += own * whole
        if fraction > 0:
            def rank(d):
                u = (int(hashlib.md5(f"17:{d.doc_id}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
                return (u / (1 - u)) / (fraction / (1 - fraction)), d.doc_id

            so_far = 0
            for d in sorted(own, key=rank):
                so_far += size[d.doc_id]
                if so_far - size[d.doc_id] / 2 < target[name] - whole * total:
                    mixed.append(d)
    return mixed


def plain_tokens(docs):
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    rows, start = [], 0
    for d in sorted(docs, key=lambda d: d.doc_id):
        ids = [*library.encode(d.text, add_special_tokens=False).ids, 0]
        rows.append((d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return rows


def test_run_against_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    kept = plain_mix(plain_decontaminated(plain_dedup(plain_language(docs)), items))
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == plain_tokens(kept)


def test_letter_junk_and_an_unseen_language_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    choose = random.Random(5)
    junk = ["".join(choose.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)) for n in (200, 1000, 5000)]
    junk.append("Ez egy magyar szöveg, amelyet a modell nem ismer, és az időjárásról szól ma reggel")
    junk.append("Το ελληνικό αλφάβητο χρησιμοποιείται για τη γραφή της γλώσσας και έχει πολλά γράμματα")
    rows = [(10**9 + n, text) for n, text in enumerate(junk)]
    added = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(added, allowMissingColumns=True), sf_dir).collect()}
    assert got == {d.doc_id for d in plain_language(docs.collect())}


def test_stages_take_odd_rows(spark, sf_dir):
    rows = frame(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = spark.createDataFrame(stage(spark, rows, sf_dir).collect(), rows.schema)
        assert rows.columns == frame(spark).columns
    assert corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir).count() == rows.count() > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, sf_dir, name):
    columns, got = compare.spark_rows(queries.QUERIES[name](spark, sf_dir))
    wanted_columns, wanted = compare.oracle_rows(compare.oracle_connection(sf_dir), queries.ORACLES[name])
    assert (columns, got) == (wanted_columns, wanted)


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
