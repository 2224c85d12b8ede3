"""Every registered query against its SQL oracle, on the whole tables."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry
from reconlake import queries as registry

# the registry's own; the llm subpackage has its tests in tests/llm
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return compare.oracle_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf_dir, oracle, name):
    columns, got = compare.spark_rows(QUERIES[name](spark, sf_dir))
    wanted_columns, wanted = compare.oracle_rows(oracle, ORACLES[name])
    assert columns == wanted_columns
    assert sum(got.values()) > 0
    assert got == wanted


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["dpYear", "dpMonth", "dpDay", "source_count", "target_count", "validation_status"]
    assert df.count() > 0
