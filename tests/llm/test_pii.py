from __future__ import annotations

import random
import re

import numpy as np
import pytest
from odd_rows import ROWS, empty, frame

from reconlake.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(found)


@pytest.fixture(scope="module")
def weights():
    return pii.train(pii.examples([]))


def test_base_spans_are_those_of_the_patterns():
    choose = random.Random(1)
    for n in range(20000):
        letters = "aZ09.-@ +()%_1234\n" if n % 2 else "12@.a- "
        text = "".join(choose.choice(letters) for _ in range(choose.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text), repr(text)
    assert pii.base_spans("1" * 300_000 + " " + "a" * 300_000) == []
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_other_spellings_are_found_and_harmless_text_is_left_alone(weights):
    choose, found, added = random.Random(99), 0, 0
    values = [(0, "eva.lang@post.example.org"), (1, "10.20.30.40"), (2, "5500005555555559"), (3, "+44 (207) 946-0018")]
    for _ in range(200):
        kind, value = choose.choice(values)
        other = pii.respelled(kind, value, choose)
        text = f"it was given as {other} by mail."
        found += (16, kind, 16 + len(other)) in pii.all_spans(text, pii.base_spans(text), weights)
        text = f"it was given as {pii._harmless(choose)} by mail."
        added += len(pii.all_spans(text, pii.base_spans(text), weights)) - len(pii.base_spans(text))
    assert found >= 190 and added <= 4


def test_short_addresses_in_every_spelling(weights):
    for value in ("10.0.0.1", "8.8.8.8", "127.0.0.1", "1.1.1.1", "10.0.12.9", "192.168.10.21"):
        for form in ("[.]", " . ", "(.)"):
            other = value.replace(".", form)
            text = f"the host {other} is up"
            assert pii.windows(text)
            assert pii.all_spans(text, pii.base_spans(text), weights) == [(9, 1, 9 + len(other))], other
    for other in ("kate at example.com", "kate.lee at mail.example.org", "info at example.com", "fred at example.com", "billing at example.com", "kate (at) example.com", "kate at example dot com"):
        text = f"ask for {other}, please"
        assert pii.all_spans(text, pii.base_spans(text), weights) == [(8, 0, 8 + len(other))], other
    for text in ("look at example.com today", "it was bought at example.com", "1. 2. 3. 4. and 300 . 12 . 34 . 56", "see us at example.org"):
        assert pii.all_spans(text, pii.base_spans(text), weights) == [], text


def test_best_spans_and_probabilities_against_all_segmentations(weights):
    of = pii.lattice("at (212) 555-0147, or")
    scores = [float(weights[f].sum()) for *_, f in of.spans]
    totals: dict[tuple, float] = {}

    def grow(at, chosen, score):
        totals[tuple(chosen)] = score
        for c, (i, j, *_) in enumerate(of.spans):
            if i >= at:
                grow(j, [*chosen, c], score + scores[c])

    grow(0, [], 0.0)
    every = np.array(list(totals.values()))
    log_sum = every.max() + np.log(np.exp(every - every.max()).sum())
    got = pii.probabilities(of, weights)
    for c in range(len(of.spans)):
        mine = sum(np.exp(v - log_sum) for k, v in totals.items() if c in k)
        assert got[c] == pytest.approx(mine, abs=1e-6)
    best = max(totals, key=totals.get)
    wanted = [(of.bounds[of.spans[c][0]], of.spans[c][2], of.bounds[of.spans[c][1]]) for c in best if got[c] >= 0.9]
    assert pii.best_spans(of, weights, []) == sorted(wanted)


def test_base_spans_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pii.find_personal_data(docs, pii.fit(docs)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_spans(texts[r.doc_id])
        assert r.base == ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert [r[f"n_{kind}"] for kind in pii.KINDS] == [sum(k == n for _, k, _ in want) for n in range(4)]
        assert set(filter(None, r.base.split(","))) <= set(r.spans.split(","))


def test_odd_rows(spark, weights):
    got = pii.find_personal_data(frame(spark), weights).collect()
    assert len(got) == len(ROWS)
    assert all(r.base == r.spans == "" for r in got)
    assert pii.find_personal_data(empty(spark), pii.fit(empty(spark))).collect() == []
