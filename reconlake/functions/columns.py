"""Safe column references and small predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """Back-quoted identifier, so that dots, spaces and keywords are plain names."""
    return "`" + name.replace("`", "``") + "`"


def qualified(*parts: str) -> str:
    """Back-quoted multi-part name, ``catalog.schema.table``."""
    return ".".join(quoted(p) for p in parts)


def col(name: str) -> Column:
    return F.col(quoted(name))


def select_all(df: DataFrame) -> DataFrame:
    """Explicit quoted projection of every column (no ``SELECT *``)."""
    return df.select(*[col(c) for c in df.columns])


def align_to(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns in the given order, found by name without regard to case.

    Raises ``ValueError`` when a name is missing or additional, because a positional
    insert or a row hash over different columns would be silently wrong.
    """
    have = {c.lower(): c for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    wanted = {c.lower() for c in columns}
    extra = [c for c in df.columns if c.lower() not in wanted]
    if missing or extra:
        raise ValueError(f"columns differ: missing {missing}, additional {extra}")
    return df.select(*[col(have[c.lower()]).alias(c) for c in columns])


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a fixed result schema, by name, cast to its types."""
    return df.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def same_text(a: Column, b: Column) -> Column:
    return F.lower(a) == F.lower(b)


def zero_if_null(df: DataFrame, *names: str) -> DataFrame:
    return df.fillna(0, subset=list(names))


def non_empty(array: Column) -> Column:
    """True for an array with at least one element; NULL arrays count as empty."""
    return F.coalesce(F.size(array) > 0, F.lit(False))


def any_null(df: DataFrame) -> Column:
    """True when at least one column is NULL."""
    return F.expr(" OR ".join(f"{quoted(c)} IS NULL" for c in df.columns))


_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_CLOCKS = (T.DateType, T.TimestampNTZType)


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of an exact number."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    whole = _WHOLE.get(type(kind))
    return None if whole is None else (whole, 0)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """A type that holds the values of both without loss, or None if there is none."""
    if a == b:
        return a
    left, right = _digits(a), _digits(b)
    if left and right:
        before, after = max(left[0], right[0]), max(left[1], right[1])
        if before + after <= 38:
            return T.DecimalType(before + after, after)
        # a wide and nearly empty type: what does not fit would be an error, not a difference
        return T.DecimalType(38, after)
    if {type(a), type(b)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if isinstance(a, _CLOCKS) and isinstance(b, _CLOCKS):
        return T.TimestampNTZType()
    return None


def same_types(source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the types that hold the values of either; columns are matched by place.

    Equal values of a table whose types were repaired are then equal as text, too.
    """
    pairs = [
        (s.name, common_type(s.dataType, t.dataType), s.dataType != t.dataType)
        for s, t in zip(source.schema.fields, target.schema.fields)
    ]
    casts = {name: kind for name, kind, differs in pairs if differs and kind is not None}
    if not casts:
        return source, target

    def cast(df: DataFrame) -> DataFrame:
        return df.select(
            *[col(c).cast(casts[n]).alias(c) if n in casts else col(c) for c, (n, _, _) in zip(df.columns, pairs)]
        )

    return cast(source), cast(target)
