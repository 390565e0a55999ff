"""Every named query against its SQL twin on the smallest tables."""

import os

import pytest

import oracle
from millrace.plans import catalog

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = catalog.load()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert oracle.compare(df, con, ORACLES[name]) == ""
    else:
        assert df.count() > 0


def test_names():
    assert set(ORACLES) <= set(QUERIES)
