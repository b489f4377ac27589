"""Every named query against its SQL answer on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry_points
from stockflow.oracle import ORACLE_SQL as ORACLE
from stockflow.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return compare.connect(sf_dir)


def test_each_query_has_an_answer():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, connection):
    assert compare.differences(QUERIES[name](spark, sf_dir), connection, ORACLE[name]) is None


def test_entry_is_the_readiness_table(spark):
    result = entry_points.entry(spark)
    assert result.columns[0] == "shipment_id" and len(result.columns) == 11
    assert result.count() > 0
