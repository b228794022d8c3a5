"""Every registered query of the engine against its comparison SQL in DuckDB."""

import pytest

from brindle import catalog
from tests.compare import differences

SMALL = "/root/testdata/sf0.001"
NO_SQL = {"crosswalk_surrogates", "scan_feed_inventory"}


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_matches_sql(spark, name):
    said = differences(spark, SMALL, name, catalog.QUERIES[name], catalog.ORACLE_SQL[name])
    assert not said or said.startswith(f"{name}: empty"), said


def test_all_others_are_named():
    assert set(catalog.QUERIES) - set(catalog.ORACLE_SQL) == NO_SQL


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_has_rows(spark, name):
    assert catalog.QUERIES[name](spark, SMALL).count() > 0
