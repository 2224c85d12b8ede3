from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from odd_rows import ROWS, empty, frame
from tokenizers import Tokenizer

from reconlake.llm import bpe, token_counts, token_files
from reconlake.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_pieces_encode_as_the_library_does(library):
    choose = random.Random(5)
    marks = [*"aabcé ñ  \n\t.,'stlvemd123½²_-!?\U0001f600漢ՠ\x1c\x85　​́ʹ", "<|endoftext|>", "'ll", " the"]
    encoder = bpe.PieceEncoder(bpe.load_vocabulary(PATH), bpe.id_bytes("<u2"), b"".join)
    encoder.pre_tokens.entries = encoder.after_space.entries = 20
    for _ in range(3000):
        text = "".join(choose.choice(marks) for _ in range(choose.randint(0, 30)))
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == ids_of(library, text), repr(text)
    for _ in range(2000):
        points = [choose.choice([choose.randint(0, 0x7FF), choose.randint(0xE000, 0x10FFFF), 32]) for _ in range(12)]
        text = "".join(map(chr, points))
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == ids_of(library, text), repr(text)


def test_proven_tokens_are_whole(library):
    whole = bpe.load_vocabulary(PATH).whole
    assert len(whole) > 40_000
    assert all(ids_of(library, name) == [token] for name, token in list(whole.items())[:2000])


def test_another_kind_of_tokenizer_goes_to_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = bpe.PieceEncoder(bpe.load_vocabulary(path), len, sum)
    text = "The Quick, brown fox's 12"
    assert encoder.encode(text) == len(ids_of(Tokenizer.from_file(path), text))


def test_counts(spark, library):
    got = token_counts.count_tokens(frame(spark), PATH, 1024).collect()
    want = [
        (r[0], len((r[1] or "").encode()), n := len(ids_of(library, r[1])), n > 1024) for r in ROWS
    ]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts.count_tokens(empty(spark), PATH, 1024).collect() == []


def test_files_give_back_every_document(spark, library):
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(frame(spark), path, PATH)
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for r in rows:
        ids = [*ids_of(library, r[1]), 0]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, token_files.read_digests(spark, path).collect()), key=repr) == sorted(want, key=repr)
    some = token_files.read_documents(spark, path, spark.createDataFrame([(1,), (6,), (99,)], "doc_id long"))
    found = {r.doc_id: r.ids for r in some.collect()}
    assert found == {r[0]: [*ids_of(library, r[1]), 0] for r in ROWS if r[0] in (1, 6)}
    index = spark.read.parquet(f"{path}/index")
    assert index.count() == len(ROWS)


def test_files_of_an_empty_table(spark):
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(empty(spark), path, PATH)
    assert token_files.read_digests(spark, path).collect() == []


def test_a_wrong_dictionary_is_refused():
    frames = token_files.Frames(b"", 2)
    with pytest.raises(ValueError, match="dictionary"):
        frames.ids(b"", "other")
