"""Every registered query against its DuckDB oracle on the driver tables (sf0.001), and the
driver's entry smoke check."""

import os

import pytest

import __spark_entry__ as E
from oracle_harness import digest, duck
from sluice.plans import catalog

SF = os.environ.get("SLUICE_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = digest(E.queries()[name](spark, SF).toPandas())
    want = digest(con.sql(E.oracle_sql()[name]).df())
    assert got == want


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1 and df.columns == ["month", "gallons", "minutes", "avg_gpm", "acre_feet"]
