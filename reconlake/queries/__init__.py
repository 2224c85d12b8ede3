"""Registry of named queries and their SQL oracles.

A query takes (spark, folder of Parquet tables) and returns a DataFrame. The oracle is the same
question in plain SQL over the same tables, written independently of the operators: it uses
joins and window functions where the operators stack and group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load_all() -> None:
    """Import the modules that register queries."""
    from reconlake.queries import (  # noqa: F401
        audits,
        discovery,
        extraction,
        incremental,
        metadata,
        own_dates,
        reconciliation,
        repairs,
        scripts,
        soundness,
    )
