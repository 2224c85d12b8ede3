"""Reconciliation reports over very many tables, appended to a result table."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from reconlake.errors import ENGINE_ERRORS
from reconlake.operators.counts import TablePair

Report = Callable[[Sequence[TablePair]], DataFrame]


def unreadable(pair: TablePair, error: str) -> TablePair:
    return dataclasses.replace(pair, source=None, source_error=error)


def write_report(
    pairs: Sequence[TablePair], report: Report, table: str, tables_per_plan: int = 100
) -> None:
    """Append the report of all pairs, one plan and one append per ``tables_per_plan`` tables.

    Batches keep the plan at a size that is quick to optimize. When one fails while running, it is
    halved until the table at fault stands alone; that one is reported as unreadable
    and the others as usual.
    """
    in_batches(pairs, report, lambda df: df.write.mode("append").saveAsTable(table), tables_per_plan)


def in_batches(
    pairs: Sequence[TablePair],
    report: Report,
    write: Callable[[DataFrame], None],
    tables_per_plan: int = 100,
) -> None:
    """The same with any way of writing."""
    for i in range(0, len(pairs), tables_per_plan):
        _one_batch(pairs[i : i + tables_per_plan], report, write)


def _one_batch(
    part: Sequence[TablePair], report: Report, write: Callable[[DataFrame], None]
) -> None:
    try:
        write(report(part))
    except ENGINE_ERRORS as e:
        if len(part) > 1:
            half = len(part) // 2
            _one_batch(part[:half], report, write)
            _one_batch(part[half:], report, write)
        elif part[0].source is not None:
            _one_batch([unreadable(part[0], str(e))], report, write)
        else:
            raise
