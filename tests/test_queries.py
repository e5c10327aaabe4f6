"""Every query of the core package against its SQL."""

import pytest
from oracle import from_duckdb, from_spark

from ambermill import queries as core


def test_each_has_sql():
    assert core.queries().keys() == core.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_matches_sql(spark, sf, name):
    got = from_spark(core.queries()[name](spark, sf))
    want = from_duckdb(core.oracle_sql()[name], sf)
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
