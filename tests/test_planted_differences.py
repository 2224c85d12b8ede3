"""Known defects planted in the orders pair are found in exact numbers, at sf0.01."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reconlake.operators import counts as C
from reconlake.operators import row_hashes as H
from reconlake.operators.incremental import incremental_rows
from reconlake.queries import fixtures as fx

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pair(spark):
    return fx.orders_pair(spark, SF)


@pytest.mark.parametrize("mode", ["safe", "compat"])
def test_hashes(pair, mode):
    r = H.compare_rows(*pair, mode=mode).first()
    assert (r.source_hash_count + r.target_hash_count - r.matched_hash_count) == 15316
    assert (r.matched_hash_count, r.source_only, r.target_only, r.uneven_copies) == (14699, 301, 316, 71)
    assert (r.validation_status, r.multiset_status) == ("Not Match", "Not Match")


def test_days(pair):
    days = C.day_counts(*pair, "o_orderdate")
    s, t = F.col("source_count"), F.col("target_count")
    r = days.agg(
        F.count_if((s == t)), F.count_if((s != t) & (s > 0) & (t > 0)), F.count_if(t == 0), F.count_if(s == 0)
    ).first()
    assert tuple(r) == (2184, 214, 1, 166)


def test_incremental(pair):
    source, target = pair
    assert incremental_rows(target, source).count() == 316
    assert incremental_rows(target, source, null_safe=False).count() == 597
