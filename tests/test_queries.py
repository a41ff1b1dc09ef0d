"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
import compare
from turnloom.plans.oracles import ORACLES
from turnloom.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry_has_the_percentiles(spark):
    assert driver.entry(spark).count() == 7


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    assert {c: TYPES[t] for c, t in df.dtypes} == {c[0]: str(c[1]) for c in expected.description}
    assert compare.differences(df.toPandas(), expected.df()) == ""
