import os

import pytest

import __spark_entry__ as driver
from checks import oracle, registry
from checks.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert registry.queries().keys() == oracle.oracle_sql().keys()
    assert registry.queries().keys() <= driver.queries().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test data")
@pytest.mark.parametrize("name", ["obs_dedup", "closest_per_route", "match_tiers", "observations", "event_rollup", "maximal_species"])
def test_against_duckdb(spark, name):
    mine = driver.queries()[name](spark, SF_DIR).toPandas()
    assert len(mine) > 0
    assert difference(mine, connect(SF_DIR).execute(driver.oracle_sql()[name]).fetchdf()) is None
