"""Repair of dates that arrived as text or integers, and of decimals and intervals.

Only columns that the sheet declares ``date`` or ``timestamp`` are looked at. What a column
holds is decided from one aggregate over all candidate columns, not from a single sample row:
the digit count or text form that most of its values have. The repair itself is one projection, which
reads each value only if it has that form.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reconlake.functions import dates
from reconlake.functions.columns import col

_INTEGERS = (T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Decision:
    """What a column was found to hold: values in all, values of that form, values it can be read from."""

    column: str
    declared: str
    kind: str
    values: int
    matching: int
    readable: int = 0


@dataclass(frozen=True)
class Form:
    """A way to write a date: which values show it, and what such a value says.

    ``also`` widens what is read once a column has the form: epochs before 2001 have a digit less.
    """

    kind: str
    fits: Callable[[Column], Column]
    read: Callable[[Column], Column]
    also: Callable[[Column], Column] | None = None

    def accepts(self, c: Column) -> Column:
        return (self.also or self.fits)(c)


def _digits(*n: int) -> Callable[[Column], Column]:
    return lambda c: dates.digits_of(c).isin(*n)


def _all_digits(n: int) -> Callable[[Column], Column]:
    return lambda c: c.rlike(rf"^\d{{{n}}}$")


def _in_days(c: Column) -> Column:
    return (c > -dates.EPOCH_DAY_LIMIT) & (c < dates.EPOCH_DAY_LIMIT)


def _compact(c: Column) -> Column:
    return F.try_to_timestamp(c.cast("string"), F.lit("yyyyMMddHHmmss"))


def _compact_day(c: Column) -> Column:
    return F.try_to_timestamp(c.cast("string"), F.lit("yyyyMMdd"))


_TEXT_FORMS = (
    Form("timestamp_text", lambda c: c.rlike(dates.TIMESTAMP_PATTERN), dates.from_timestamp_text),
    Form("time_text", lambda c: c.rlike(dates.TIME_PATTERN), dates.from_time_text),
)
_INTEGER_FORMS = (
    Form("epoch_seconds", _digits(10), dates.from_epoch_seconds, _digits(9, 10)),
    Form("epoch_millis", _digits(13), dates.from_epoch_millis, _digits(12, 13)),
    Form("yyyymmdd", _digits(8), dates.from_yyyymmdd),
)
_DAY_FORM = Form("epoch_days", _in_days, dates.from_epoch_days)

# Forms that may stand side by side in one column; the first that fits decides. All are told
# apart by their digits, but for day numbers, which stop at 36,500.
_MIXED_TEXT = (
    _TEXT_FORMS[0],
    Form("compact", _all_digits(14), _compact),
    Form("epoch_millis", _all_digits(13), lambda c: dates.from_epoch_millis(c.try_cast("bigint"))),
    Form("epoch_seconds", _all_digits(10), lambda c: dates.from_epoch_seconds(c.try_cast("bigint"))),
    Form("yyyymmdd", _all_digits(8), _compact_day),
)
_MIXED_INTEGER = (
    *_INTEGER_FORMS[:2],
    Form("compact", _digits(14), _compact),
    Form("epoch_days", lambda c: c.between(0, 36500), dates.from_epoch_days),
    Form("yyyymmdd", _digits(8), _compact_day),
)
_READERS = {form.kind: form for form in (*_TEXT_FORMS, *_INTEGER_FORMS, _DAY_FORM)}


def _text_forms(c: Column) -> dict[str, Column]:
    return {form.kind: form.fits(c) for form in _TEXT_FORMS}


def _integer_forms(c: Column, declared: str) -> dict[str, Column]:
    forms = (*_INTEGER_FORMS, _DAY_FORM) if declared == "date" else _INTEGER_FORMS
    return {form.kind: form.fits(c) for form in forms}


def _forms(field: T.StructField, declared: str) -> dict[str, Column]:
    c = col(field.name)
    if isinstance(field.dataType, T.StringType):
        return _text_forms(c)
    if isinstance(field.dataType, _INTEGERS):
        return _integer_forms(c, declared)
    return {}


def profile(df: DataFrame, declared: Mapping[str, str]) -> list[Decision]:
    """What each declared date column holds. One Spark job over the candidate columns only."""
    candidates = [
        (f, declared[f.name], _forms(f, declared[f.name]))
        for f in df.schema.fields
        if declared.get(f.name) in ("date", "timestamp") and _forms(f, declared[f.name])
    ]
    if not candidates:
        return []
    counters = []
    for i, (f, _, forms) in enumerate(candidates):
        counters.append(F.count(col(f.name)).alias(f"n{i}"))
        counters += [F.count_if(test).alias(f"n{i}_{kind}") for kind, test in forms.items()]
        # a value is readable if its text says a day, not only if it has the digits
        counters += [
            F.count(repaired_column(col(f.name), kind, "timestamp")).alias(f"r{i}_{kind}") for kind in forms
        ]
    found = df.agg(*counters).first()
    out = []
    for i, (f, kind_declared, forms) in enumerate(candidates):
        total = found[f"n{i}"]
        if total == 0:
            empty = "all_null" if isinstance(f.dataType, _INTEGERS) else "as_is"
            out.append(Decision(f.name, kind_declared, empty, 0, 0))
            continue
        best = max(forms, key=lambda k: found[f"n{i}_{k}"])
        matching = found[f"n{i}_{best}"]
        kind = best if matching * 2 > total else "as_is"
        readable = total if kind == "as_is" else found[f"r{i}_{kind}"]
        out.append(Decision(f.name, kind_declared, kind, total, matching, readable))
    return out


def repaired_column(c: Column, kind: str, declared: str) -> Column:
    """Each value by its own test: one that does not have the form becomes NULL.

    How many that are is in the decision. Text of a timestamp stays a timestamp in a column that is
    declared a date.
    """
    if kind == "all_null":
        return F.lit(None).cast(declared)
    form = _READERS.get(kind)
    return c if form is None else F.when(form.accepts(c), form.read(c))


def misfits(decisions: list[Decision]) -> dict[str, int]:
    """Values per declared column that no date was read from: those without the form of the others, and all of
    a column that is left as it is, because no form has the majority."""
    found = {d.column: d.values - (d.readable if d.kind in _READERS else 0) for d in decisions if d.kind != "all_null"}
    return {name: n for name, n in found.items() if n}


def apply_decisions(df: DataFrame, decisions: list[Decision]) -> DataFrame:
    """The repaired frame; columns without a decision pass through. Lazy."""
    by_name = {d.column: d for d in decisions}
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        d = by_name.get(f.name)
        if d is not None:
            c = repaired_column(c, d.kind, d.declared)
        out.append(c.alias(f.name))
    return df.select(*out)


def repair(df: DataFrame, declared: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Profile, then repair. ``declared`` maps column names to ``date`` or ``timestamp``.

    ``strict`` refuses columns in which some values do not have the form of the others.
    """
    decisions = profile(df, declared)
    if strict and misfits(decisions):
        raise ValueError(f"values that do not fit: {misfits(decisions)}")
    return apply_decisions(df, decisions)


def mixed_column(c: Column, kind: T.DataType) -> Column:
    """Value-by-value reading of text or integers; NULL where no form fits."""
    forms = _MIXED_TEXT if isinstance(kind, T.StringType) else _MIXED_INTEGER
    return F.coalesce(*[F.when(f.fits(c), f.read(c).cast("timestamp")) for f in forms])


def repair_mixed(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Value-by-value repair of columns that mix several forms; no profile needed."""
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        if f.name in declared and isinstance(f.dataType, (T.StringType, *_INTEGERS)):
            c = mixed_column(c, f.dataType)
        out.append(c.alias(f.name))
    return df.select(*out)


def repair_numbers(df: DataFrame, to: str = "decimal") -> DataFrame:
    """Decimals to DECIMAL(38,18), or to DOUBLE; intervals to text."""
    target = {"decimal": "decimal(38,18)", "double": "double"}[to]
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast(target)
        elif isinstance(f.dataType, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)
