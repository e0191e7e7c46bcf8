"""The text queries that SQL can express, against their SQL on a second engine."""

import pytest

import check
from opinara.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert check.compare(spark, check.database(SF), SF, name) == ""


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in QUERIES
