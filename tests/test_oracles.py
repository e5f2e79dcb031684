"""Registered plans against their SQL on the smallest test tables."""

from pathlib import Path

import pytest

from checks.compare import database, difference
from checks.oracles import ORACLES
from checks.registry import QUERIES

DATA = "/root/testdata/sf0.001"
CHOSEN = [n for n in QUERIES if n.split("_")[0].rstrip("0123456789") in ("q", "kpi", "a", "e2a", "e3a", "x", "v")
          and not n.startswith(("x9", "x10", "x11", "x12", "v6"))] + ["dq_all_rules", "m2_product_performance"]


@pytest.fixture(scope="module")
def con():
    if not Path(DATA).exists():
        pytest.skip("test tables are not there")
    return database(DATA)


@pytest.mark.parametrize("name", CHOSEN)
def test_equal_to_sql(spark, con, name):
    problem, _ = difference(spark, con, name, DATA)
    assert not problem


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == set()
    assert set(ORACLES) <= set(QUERIES)
