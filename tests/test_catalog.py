"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import compare
from __spark_entry__ import entry
from tallyloom import catalog

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF)


def test_every_query_has_its_sql():
    assert set(catalog.SQL) == set(catalog.QUERIES)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["person_id", "provider", "cut", "site"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    assert compare.compare(spark, db, name, SF) is None
