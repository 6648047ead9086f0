"""Every query of the library against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import check
from workload import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Many rounds of small jobs; their parts are covered by the operator tests.
SLOW = {"kmeans_fit", "auto_k"}


@pytest.fixture(scope="module")
def con():
    connection = check.connect(SF_DIR)
    yield connection
    connection.close()


def test_every_check_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - SLOW))
def test_query(spark, con, name):
    ok, message = check.compare(spark, con, name, SF_DIR)
    assert ok, message


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "heavy_atom_weight" in df.columns
