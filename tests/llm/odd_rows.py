"""Documents with nulls everywhere, empty and long texts, repeated rows, and columns with clashing names."""

from __future__ import annotations

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row string, copies int, fp long, size int, rank double, t string, hash long, text_key long, kept boolean"
)
EXTRA = ("r", 7, 8, 9, 0.5, "tt", 1, 2, True)
PROSE = "the quick brown fox jumps over the lazy dog and runs away from it at once because it is late"


def _row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *EXTRA)


ROWS = [
    _row(1, PROSE),
    _row(2, PROSE),
    _row(2, PROSE),
    _row(3, None),
    _row(4, ""),
    _row(5, " \t\n", None, None),
    _row(None, PROSE + " again", "en", None),
    _row(None, None, None, None),
    _row(6, "größe früh <|endoftext|> 123 \U0001f600 don't  we\n\n x", "de", "b"),
    _row(7, " ".join(f"word{i} and" for i in range(4000)), "en", "b"),
    _row(8, "x" * 20000, "en", "c"),
    _row(9, PROSE.upper(), "en", "c"),
    _row(10, "12 34 !!", "en", ""),
    _row(11, "ՠ́²ʹ 漢字 　", "zz", "ü"),
]


def frame(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
