"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as contract
import compare
from conftest import SF
from martloom.plans import catalog, oracle


@pytest.fixture(scope="module")
def con():
    return compare.database(SF)


def test_every_query_has_a_twin():
    assert set(catalog.QUERIES) == set(oracle.ORACLE)
    assert catalog.QUERIES.items() <= contract.queries().items()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_same_rows(spark, con, name):
    assert compare.differences(contract.queries()[name](spark, SF), con, contract.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["year", "month_name", "category", "revenue", "profit"]
    assert not df.isEmpty()


def test_star_and_flat_agree(spark, folder):
    star, flat = (contract.queries()[k](spark, folder) for k in ("star_month_category", "flat_month_category"))
    assert star.exceptAll(flat).isEmpty() and flat.exceptAll(star).isEmpty()
