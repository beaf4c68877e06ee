import os

import pytest

import __spark_entry__ as entry
from compare import connect, oracle_rows, spark_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


def test_entry(spark):
    assert entry.entry(spark).count() == 5


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, oracle, name):
    names, rows = spark_rows(entry.queries()[name](spark, SF_DIR))
    assert rows
    if name in entry.oracle_sql():
        expected_names, expected = oracle_rows(oracle, entry.oracle_sql()[name])
        assert names == expected_names
        assert len(rows) == len(expected)
        different = [pair for pair in zip(rows, expected) if pair[0] != pair[1]]
        assert not different, different[:3]
