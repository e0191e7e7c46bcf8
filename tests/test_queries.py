"""Every registered query against its SQL on a second engine."""

import pytest

import __spark_entry__ as entry
import check
from opinara.plans.oracle import statements
from opinara.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check.database(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(statements())
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert check.compare(spark, db, SF, name) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 3
