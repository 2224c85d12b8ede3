from __future__ import annotations

import re

import pytest
from odd_rows import ROWS, empty, frame

from reconlake.llm import templates

ITEM = (
    "On Monday the farmer Tom has 25 apples in the big basket and Tom gives 7 apples to his sister Ann who"
    " walks 3 km home with the basket every day"
)


def benchmark(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def documents(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def found(spark, docs, items):
    pairs = templates.Leaks(documents(spark, *docs), benchmark(spark, *items)).pairs().collect()
    return {(r.doc_id, r.item_id): r.as_written for r in pairs}


def test_asked_anew_with_other_values(spark):
    around = "Some words come first. {} And some come later."
    docs = [
        around.format(ITEM),
        around.format(ITEM.upper()),
        around.format(ITEM.replace("25", "81").replace("Tom", "Jim").replace("7 ", "9 ").replace("Ann", "Eve").replace("3 km", "4 mi")),
        # Tom is Jim here and Bob there, and the two numbers are one
        around.format(re.sub("Tom gives", "Bob gives", ITEM).replace("Tom has", "Jim has").replace("7 ", "25 ")),
        around.format(ITEM[: len(ITEM) // 2]),
        "Nothing of the kind is said in this text, which has 25 apples and 7 pears as well.",
    ]
    got = found(spark, docs, [ITEM, "five words are not here", "too short"])
    assert got.pop((0, 0)) is True and got.pop((1, 0)) is True and got.pop((2, 0)) is False
    assert (4, 0) not in got and (5, 0) not in got


def plain_templates(docs, items):
    """Pairs by search of every document for every item, windows as tuples of words and placeholders."""

    def read(text):
        words, kinds, begins = [], [], True
        for m in re.finditer(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+|[.!?:]", text):
            t = m[0]
            if t in ".!?:":
                begins = True
                continue
            unit = t.lower() in templates.UNITS
            kind = "#" if t[0].isdigit() else "" if unit else "?" if t.istitle() and len(t) > 1 and begins else ""
            if unit and kinds and kinds[-1] == "#":
                kind = "u"
            if not kind and not unit and t.istitle() and len(t) > 1:
                kind = "N"
            words.append(t.lower())
            kinds.append(kind)
            begins = False
        made = []
        for at in range(len(words) - 4):
            part, kind = words[at : at + 5], kinds[at : at + 5]
            forms = {}
            for doubt in ("", "N"):
                k = [doubt if x == "?" else x for x in kind]
                filled = sum(map(bool, k))
                if filled and (doubt == "" or "?" in kind):
                    forms[tuple(x or w for x, w in zip(k, part))] = (tuple(w for x, w in zip(k, part) if x), filled > 3)
            made.append((tuple(part), forms))
        return words, made

    def holds(doc, item):
        (d_words, d), (i_words, i) = doc, item
        if len(i_words) < 5:
            return bool(i_words) and any(d_words[n : n + len(i_words)] == i_words for n in range(len(d_words)))
        written = {p for p, _ in d}
        if sum(p in written for p, _ in i) >= 0.8 * len(i) - 1e-9:
            return True
        if all(dense for _, forms in i for _, dense in forms.values()):
            return False
        fillings = {}
        for _, forms in d:
            for form, (slots, _) in forms.items():
                fillings.setdefault(form, set()).add(slots)
        met = [(n, (), ()) for n, (p, _) in enumerate(i) if p in written]
        for n, (_, forms) in enumerate(i):
            met += [(n, slots, theirs) for form, (slots, _) in forms.items() for theirs in fillings.get(form, ())]
        votes = {}
        for _, ours, theirs in met:
            for pair in zip(ours, theirs):
                votes[pair] = votes.get(pair, 0) + 1
        chosen = {}
        for ours, theirs in sorted(votes, key=lambda pair: -votes[pair]):
            if ours not in chosen and theirs not in chosen.values():
                chosen[ours] = theirs
        right = {n for n, ours, theirs in met if all(chosen.get(a) == b for a, b in zip(ours, theirs))}
        return len(right) >= 0.8 * len(i) - 1e-9

    docs, items = [read(t) for t in docs], [read(t) for t in items]
    return {(a, b) for a, d in enumerate(docs) for b, i in enumerate(items) if holds(d, i)}


QUESTIONS = [
    "{A} has {n} apples. {A} buys {m} more apples at the shop. How many apples does {A} have now?",
    "A train leaves {B} at {n} and reaches {A} after {m} hours. How fast is it if the way is {k} km long?",
    "{A}, {B} and {C} share {n} coins, {m} stones and {k} nuts. {A} takes {k} nuts. What is left for {B}?",
    "What is {n} {m} {k} {n} {m} {k} put in order? {A} says {k} {m} {n} {k} {m} {n} and {B} says no such thing.",
    "{C} reads {n} pages on the first day and {m} pages on each later day. When has {C} read {k} pages?",
]
VALUES = [
    dict(A="Tom", B="Paris", C="Ann", n=5, m=7, k=310),
    dict(A="Anna", B="Madrid", C="Bob", n=12, m=3, k=95),
    dict(A="Omar", B="Oslo", C="Wei", n=48, m=16, k=4),
]


def test_questions_asked_anew_against_plain_search(spark):
    items = [q.format(**VALUES[0]) for q in QUESTIONS]
    asked = [(n, f"Some words stand before it. {q.format(**v)} And some come later.") for n, q in enumerate(QUESTIONS) for v in VALUES]
    mixed = [q.format(**VALUES[1]).replace("Anna", "Tim", 1).replace("Bob", "Sue", 1).replace(" 3 ", " 8 ", 1) for q in QUESTIONS]
    clean = [
        "The shop sells apples. Anna has no time today. How many of us do have time now?",
        "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 and Tom Ann Eve Bob Sue Tim Jim Kim",
        "A train leaves at 5 and it is late. The way to the shop is 310 km long.",
    ]
    docs = [t for _, t in asked] + mixed + clean
    got = set(found(spark, docs, items))
    assert got == plain_templates(docs, items)
    planted = {(at, n) for at, (n, _) in enumerate(asked)}
    assert planted <= got and all(d < len(asked) + len(mixed) for d, _ in got)


def test_short_items_are_one_window(spark):
    docs = ["So who wrote Hamlet? Nobody knows.", "Who wrote it? Hamlet did.", "who WROTE hamlet", "wrote Hamlet", None, ""]
    assert set(found(spark, docs, ["Who wrote Hamlet?", "", "?!"])) == {(0, 0), (2, 0)}


def test_numbers_alone_are_no_template(spark):
    numbers = " ".join(str(n) for n in range(100, 140))
    docs = [" ".join(str(n) for n in range(500, 900)), f"see {numbers} there"]
    assert found(spark, docs, [numbers]) == {(1, 0): True}


def test_slots_must_agree():
    def match(place, slots, theirs):
        return {"place": place, "slots": slots, "d_slots": theirs}

    assert templates._consistent([match(0, [1, 2], [5, 6]), match(1, [2], [6]), match(2, [1], [5])], 3) == 3
    assert templates._consistent([match(0, [1, 2], [5, 6]), match(1, [2], [6]), match(2, [1], [7])], 3) == 2
    assert templates._consistent([match(0, [1], [5]), match(1, [2], [5])], 2) == 1


@pytest.mark.parametrize("shared", [0, 30])
def test_text_that_all_items_share_makes_no_pairs(spark, shared):
    common = " ".join(f"common{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(shared))
    items = [f"{common} " + " ".join(f"own{chr(97 + n)}{chr(97 + i)}" for i in range(20)) for n in range(12)]
    got = found(spark, [f"before {items[3]} after", common or "none"], items)
    assert got == {(0, 3): True}


def test_documents_against_plain_search(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    words = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+")

    def shares(text, item):
        a, b = (words.findall(t.lower()) for t in (text, item))
        there = {tuple(a[i : i + 5]) for i in range(len(a) - 4)}
        windows = [tuple(b[i : i + 5]) in there for i in range(len(b) - 4)]
        return sum(windows) >= 0.8 * len(windows) - 1e-9 and bool(windows)

    wanted = {
        (d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if shares(d.text, i.text)
    }
    leaks = templates.Leaks(docs, items)
    assert {(r.doc_id, r.item_id) for r in leaks.pairs().collect() if r.as_written} == wanted
    clean = leaks.clean()
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()}.isdisjoint({d for d, _ in wanted})
    assert clean.count() == docs.count() - len({d for d, _ in wanted})


def test_every_text_of_an_item_is_searched(spark):
    def text(letter):
        return " ".join(f"word{letter}{chr(97 + i)}" for i in range(12))

    longer = f"{text('x')} and five words more here"
    items = [(7, text("p")), (7, text("q")), (None, text("r")), (None, text("s")), (8, text("x")), (8, longer), (8, text("x"))]
    docs = documents(spark, *[f"before {text(c)} after" for c in "pqrs"], f"before {longer}", "nothing of the kind is said")
    leaks = templates.Leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    got = sorted(((r.doc_id, r.item_id, r.share) for r in leaks.pairs().collect()), key=repr)
    assert got == [(0, 7, 1.0), (1, 7, 1.0), (2, None, 1.0), (3, None, 1.0), (4, 8, 1.0)]
    assert [r.doc_id for r in leaks.clean().collect()] == [5]


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, None, 5), (2, "", 5), (None, ROWS[0][1], 5), (3, "a b", 5)], "item_id long, text string, hash int")
    leaks = templates.Leaks(frame(spark), items)
    got = sorted(((r.doc_id, r.item_id) for r in leaks.pairs().collect()), key=repr)
    assert got == sorted([(1, None), (2, None), (9, None), (None, None)], key=repr)
    assert leaks.clean().count() == len(ROWS) - 5
    assert templates.Leaks(empty(spark), items).pairs().collect() == []
    assert templates.Leaks(frame(spark), items.limit(0)).clean().count() == len(ROWS)
