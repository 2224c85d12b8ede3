"""Expressions over SQL script text and table names.

These are the same plain patterns everywhere: two-part names after a keyword, and statements
cut at every semicolon. There is deliberately no SQL parser: a name in a comment counts, and a
semicolon inside a string ends a statement.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word characters and blanks are the Unicode ones.
WORD = r"[\p{L}\p{N}_]"
BLANK = r"[\s\p{Z}\x0B\x1C-\x1F\x{85}]"
SOURCE_KEYWORDS = "FROM|JOIN"
TARGET_KEYWORDS = "INTO|TABLE|UPDATE|MERGE INTO"
STRIPPED = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def table_pattern(keywords: str, allow_exists: bool = False) -> str:
    """Pattern whose first group is ``schema.table``."""
    exists = rf"(?:IF{BLANK}+(?:NOT{BLANK}+)?EXISTS{BLANK}+)?" if allow_exists else ""
    return rf"(?i)(?:{keywords}){BLANK}+{exists}({WORD}+\.{WORD}+)"


SOURCE_PATTERN = table_pattern(SOURCE_KEYWORDS)
TARGET_PATTERN = table_pattern(TARGET_KEYWORDS)


def table_references(text: Column, pattern: str) -> Column:
    """Sorted distinct ``schema.table`` names found by the pattern."""
    names = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.array_sort(F.array_distinct(names))


def statements_of(script: Column) -> Column:
    """Array of non-empty statements of a script."""
    pieces = F.transform(F.split(script, ";"), lambda s: F.btrim(s, F.lit(STRIPPED)))
    return F.filter(pieces, lambda s: s != "")


def name_part(name: Column, position: int) -> Column:
    """Part of a dotted name, counted from 1, or from the end when negative; NULL if absent."""
    return F.try_element_at(F.split(name, r"\."), F.lit(position))


def without_prefix(name: Column, catalog: str) -> Column:
    """The name without a leading ``catalog.``"""
    pattern = "^" + "".join("\\" + ch if not ch.isalnum() and ch != "_" else ch for ch in catalog) + r"\."
    return F.regexp_replace(name, pattern, "")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def short_error(message: Column, limit: int = 200) -> Column:
    return F.substring(message, 1, limit)
