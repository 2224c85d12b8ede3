"""Operators of a training-data pipeline: counting, mixing, scanning, deduplicating, writing.

Nothing else in the library imports this package. Every operator takes DataFrames and returns
DataFrames; the thin queries over the test tables are in ``llm.queries``.
"""
