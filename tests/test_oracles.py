"""Every registered query against its SQL, on the smallest test tables."""

import os

import pytest

from suite.check import compare, connect
from suite.oracles import ORACLES
from suite.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal(spark, con, name):
    problem, _ = compare(spark, con, SF_DIR, QUERIES[name], ORACLES[name])
    assert problem == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
