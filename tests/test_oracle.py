"""Every query with a DuckDB text agrees with it (sf0.001; the driver checks sf0.01)."""

import pytest

import __spark_entry__ as entry
from twinreach.plans.compare import compare

from conftest import SF_SMALL

ORACLE = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck_small, name):
    df = entry.queries()[name](spark, SF_SMALL)
    assert compare(df, duck_small, ORACLE[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.columns == ["churned_users", "sub_revenue", "ad_revenue"]
