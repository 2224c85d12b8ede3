"""Rows of a newer copy that the target does not hold yet."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reconlake.functions import dates
from reconlake.functions.columns import align_to, any_null, col, same_types
from reconlake.functions.hashing import quick_key, value_key

_KEYS, _ROW, _OLD = ["__row_key_1", "__row_key_2"], "__row", "__old"
_FLOATS = (T.FloatType, T.DoubleType)


def _one_zero(df: DataFrame) -> DataFrame:
    """Negative zero as zero, which it equals."""
    zeros = [F.lit(0.0).cast(f.dataType) for f in df.schema.fields]
    return df.select(
        *[
            (col(f.name) + z).alias(f.name) if isinstance(f.dataType, _FLOATS) else col(f.name)
            for f, z in zip(df.schema.fields, zeros)
        ]
    )


def incremental_rows(
    new: DataFrame,
    existing: DataFrame,
    date_column: str | None = None,
    cutoff: str | dt.date | None = None,
    null_safe: bool = True,
    dedupe: bool = False,
) -> DataFrame:
    """Rows of ``new`` after the cutoff with no equal row in ``existing``, copies included.

    ``null_safe=False`` reproduces plain ``=`` over all columns: a row with any NULL never
    matches, so it comes back on every run. ``dedupe`` returns each row once. As in SQL, -0.0
    equals 0.0 and comes back as 0.0. Rows are equal if their keys are (two hashes of 64 bits, over types
    that hold the values of both sides), so columns of any type will do, maps included.

    Of the existing side only keys are moved, each once per task. New rows are moved once, to the
    keys; adaptive execution splits a row that repeats too often for one task.
    """
    existing = align_to(existing, new.columns)
    if date_column is not None and cutoff is not None:
        new = dates.after(new, date_column, cutoff)
        existing = dates.after(existing, date_column, cutoff)
    if not null_safe:
        existing = existing.filter(~any_null(existing))
    new, existing = _one_zero(new), _one_zero(existing)
    wide, wide_existing = same_types(new, existing)
    known = wide_existing.select(*quick_key(wide_existing.schema.fields, _KEYS))
    # the key is taken of the widened columns, the rows keep their own types
    kinds = {f.name: f.dataType for f in wide.schema.fields}
    keyed = new.select(*[col(c) for c in new.columns], *quick_key(new.schema.fields, _KEYS, kinds))
    if dedupe:
        # copies merge before they are moved
        rows = keyed.select(*_KEYS, F.struct(*[col(c) for c in new.columns]).alias(_ROW))
        grouped = (
            rows.unionByName(known, allowMissingColumns=True)
            .groupBy(*_KEYS)
            .agg(F.first(_ROW, ignorenulls=True).alias(_ROW), F.count_if(F.col(_ROW).isNull()).alias(_OLD))
        )
        return grouped.where(F.col(_OLD) == 0).select(f"{_ROW}.*")
    missing = keyed.join(known.distinct(), _KEYS, "left_anti")
    return missing.select(*[col(c) for c in new.columns])


def rows_not_in(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of ``new`` with no equal row in ``existing``, copies included; NULLs are equal.

    Rows meet by their keys and are then compared value by value, so two rows whose hashes agree by chance
    stay two rows. Both sides move whole rows: meant for an ``existing`` that was narrowed down first.
    """
    existing = align_to(existing, new.columns)
    new, existing = _one_zero(new), _one_zero(existing)
    wide, wide_existing = same_types(new, existing)
    kinds = {f.name: f.dataType for f in wide.schema.fields}
    values = [f"__value_{i}" for i in range(len(new.columns))]

    def compared(df: DataFrame, prefix: str) -> list[Column]:
        return [
            value_key(f, kinds.get(f.name)).alias(f"{prefix}{v}") for v, f in zip(values, df.schema.fields)
        ]

    known = wide_existing.select(
        *quick_key(wide_existing.schema.fields, [f"__old{k}" for k in _KEYS]), *compared(wide_existing, "__old")
    ).distinct()
    keyed = new.select(
        *[col(c) for c in new.columns], *quick_key(new.schema.fields, _KEYS, kinds), *compared(new, "__new")
    )
    same = F.lit(True)
    for k in _KEYS:
        same = same & (F.col(k) == F.col(f"__old{k}"))
    for v in values:
        same = same & F.col(f"__new{v}").eqNullSafe(F.col(f"__old{v}"))
    return keyed.join(known, same, "left_anti").select(*[col(c) for c in new.columns])
