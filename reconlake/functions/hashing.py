"""Row fingerprints.

``safe`` encodes each value as ``length:value`` and NULL as ``N``, joined by a pipe, so that
different rows never share an encoding. ``compat`` is the plain ``concat_ws`` form, which
skips NULLs and lets separators inside values collide; it is kept for comparing with hashes
that were made that way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reconlake.functions.columns import quoted

_NESTED = (T.ArrayType, T.MapType, T.StructType)


def _value_text(field: T.StructField) -> str:
    """SQL of a one-to-one text form of a value."""
    c, kind = quoted(field.name), field.dataType
    if isinstance(kind, T.MapType):
        # equal maps may keep their entries in another order
        entries = f"array_sort(map_entries({c}), (a, b) -> CASE WHEN a.key < b.key THEN -1 ELSE 1 END)"
        return f"IF({c} IS NULL, NULL, to_json(struct({entries} AS v), map('ignoreNullFields', 'false')))"
    if isinstance(kind, _NESTED):
        # NULL itself stays NULL, NULLs inside are written out
        json = f"to_json(struct({c} AS v), map('ignoreNullFields', 'false'))"
        return f"IF({c} IS NULL, NULL, {json})"
    if isinstance(kind, T.BinaryType):
        return f"hex({c})"
    if isinstance(kind, T.TimestampType):
        # an instant: its printed form repeats when clocks go back
        return f"CAST(unix_micros({c}) AS string)"
    return f"CAST({c} AS string)"


def _length_prefixed(field: T.StructField) -> str:
    """Arguments for ``concat``: length, colon and text, or a lone N for NULL.

    They are left apart so that one ``concat`` over the whole row copies each text once. Every
    use of a text is always evaluated, which lets the generated code compute it once.
    """
    text = _value_text(field)
    colon = f"IF({quoted(field.name)} IS NULL, '', ':')"
    return f"coalesce(CAST(length({text}) AS string), 'N'), {colon}, coalesce({text}, '')"


def _fields(df: DataFrame, columns: Sequence[str] | None) -> list[T.StructField]:
    if columns is None:
        return list(df.schema.fields)
    by_name = {f.name.lower(): f for f in df.schema.fields}
    return [by_name[c.lower()] for c in columns]


def _row_hash(
    df: DataFrame, columns: Sequence[str] | None, mode: str, separator: str
) -> str:
    fields = _fields(df, columns)
    if mode == "safe":
        row = ", '|', ".join(_length_prefixed(f) for f in fields)
        return f"sha2(concat({row}), 256)"
    if mode == "compat":
        escaped = separator.replace("\\", "\\\\").replace("'", "\\'")
        row = ", ".join(f"CAST({quoted(f.name)} AS string)" for f in fields)
        return f"sha2(concat_ws('{escaped}', {row}), 256)"
    raise ValueError(f"unknown hash mode {mode!r}")


def row_hash(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    mode: str = "safe",
    separator: str = "||",
) -> Column:
    """SHA-256 of a row as 64 hex digits.

    The expression is handed to Spark as SQL text: a wide table would need thousands of calls
    into the JVM to build it piece by piece.
    """
    return F.expr(_row_hash(df, columns, mode, separator))


def hash_key(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    mode: str = "safe",
    separator: str = "||",
) -> Column:
    """The same fingerprint as 32 bytes: half of what a shuffle on the hex text would move."""
    return F.expr(f"unhex({_row_hash(df, columns, mode, separator)})")


def quick_key(
    fields: Sequence[T.StructField], names: Sequence[str], kinds: Mapping[str, T.DataType] | None = None
) -> list[Column]:
    """Two independent 64-bit hashes of a row, cheaper than a fingerprint and half its size.

    Which values are NULL is part of the row; nested values are hashed by their text. ``kinds`` gives types to
    cast to first.
    """
    values, nulls = [], []
    for field in fields:
        c = quoted(field.name)
        kind = (kinds or {}).get(field.name, field.dataType)
        if isinstance(field.dataType, _NESTED):
            values.append(_value_text(field))
        else:
            values.append(c if kind == field.dataType else f"CAST({c} AS {kind.simpleString()})")
        nulls.append(f"IF({c} IS NULL, '1', '0')")
    mask = f"concat({', '.join(nulls)})"
    made = (f"xxhash64({mask}, {', '.join(values)})", f"xxhash64({', '.join(reversed(values))}, 'row', {mask})")
    return [F.expr(sql).alias(name) for sql, name in zip(made, names)]


def value_key(field: T.StructField, kind: T.DataType | None = None) -> Column:
    """A value in a form that can be compared: nested ones by their text, others in the wanted type."""
    if isinstance(field.dataType, _NESTED):
        return F.expr(_value_text(field))
    c = F.col(quoted(field.name))
    return c if kind is None or kind == field.dataType else c.cast(kind)
