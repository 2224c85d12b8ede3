from __future__ import annotations

import pytest
from odd_rows import ROWS, empty, frame

from reconlake.llm import line_chunks


def plain(docs):
    """The texts left, document after document by id, text hash aside."""
    seen, left = set(), {}
    for doc_id, text in sorted(docs):
        removed = set()
        for number, _, content in line_chunks.repeatable_chunks(text):
            removed |= {number} if content in seen else set()
            seen.add(content)
        left[doc_id] = (len(removed), line_chunks.without_chunks(text, removed)[0])
    return left


def test_chunks_do_not_move_with_lines_before_them():
    passage = [f"line number {i * i} of the passage" for i in range(40)]
    one = {c for _, _, c in line_chunks.repeatable_chunks("\n".join(["a", *passage, "z"]))}
    two = {c for _, _, c in line_chunks.repeatable_chunks("\n".join(["b", "c", "d", *passage, "y", "x"]))}
    assert len(one & two) >= len(one) - 3
    lines, chunks = line_chunks.chunk_lines("\n".join(passage))
    assert [b for _, b in chunks][:-1] == [a for a, _ in chunks][1:] and chunks[-1][1] == len(lines) == 40


def test_documents_against_plain_search(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    made = line_chunks.LineChunks(docs)
    got = {r.doc_id: (r.removed_chunks, r.text) for r in made.report().collect()}
    assert got == want
    assert sum(n for n, _ in want.values()) > 0
    clean = made.clean()
    assert clean.columns == docs.columns
    assert {r.doc_id: r.text for r in clean.collect()} == {d: t for d, (_, t) in want.items()}


def test_bytes_decide_where_digests_collide(spark, monkeypatch):
    class Short:
        xxh64_intdigest = staticmethod(line_chunks.xxhash.xxh64_intdigest)
        xxh3_128_digest = staticmethod(lambda content: bytes(16))

    monkeypatch.setattr(line_chunks, "xxhash", Short)
    texts = ["a one\na two\nend", "b one\nb two\nend", "a one\na two\nend"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = plain(list(enumerate(texts)))
    # the workers take the module as it is, so only the driver's part is exercised if digests differ there
    assert {r.doc_id: (r.removed_chunks, r.text) for r in line_chunks.LineChunks(docs).report().collect()} == want


@pytest.mark.parametrize("lines", [["x\ny\nz"], ["", "\n\n\n"]])
def test_odd_rows(spark, lines):
    extra = [(200 + i, t, *ROWS[0][2:]) for i, t in enumerate(lines)]
    rows = frame(spark, ROWS + extra)
    made = line_chunks.LineChunks(rows)
    got = made.report().collect()
    assert len(got) == len(ROWS) + len(extra)
    texts = {(r.doc_id, r.text) for r in got}
    assert (3, None) in texts and (4, "") in texts
    assert line_chunks.LineChunks(empty(spark)).report().collect() == []
