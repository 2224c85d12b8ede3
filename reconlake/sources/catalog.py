"""Catalog tables and existence probes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from reconlake.errors import ENGINE_ERRORS
from reconlake.operators.counts import TablePair

Reader = Callable[[str], DataFrame]


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def catalog_reader(spark: SparkSession, prefix: str = "") -> Reader:
    """Reader of ``schema.table`` names inside a catalog or with any other prefix."""
    return lambda name: spark.table(f"{prefix}.{name}" if prefix else name)


def open_or_error(read: Reader, name: str) -> DataFrame | str:
    """The table's frame, or the error text when it cannot be resolved."""
    try:
        df = read(name)
        df.schema  # resolves the table now
        return df
    except ENGINE_ERRORS as e:
        return str(e)


def open_pairs(
    names: Iterable[str],
    read_source: Reader,
    read_target: Reader,
    date_columns: Mapping[str, str | None] | None = None,
) -> list[TablePair]:
    """Both sides of each table; a side that cannot be opened carries its error instead."""
    out = []
    for name in names:
        s, t = open_or_error(read_source, name), open_or_error(read_target, name)
        out.append(
            TablePair(
                name,
                None if isinstance(s, str) else s,
                None if isinstance(t, str) else t,
                (date_columns or {}).get(name),
                s if isinstance(s, str) else None,
                t if isinstance(t, str) else None,
            )
        )
    return out
