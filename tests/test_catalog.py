"""Every registered query gives the rows of its SQL equivalent."""

import oracle
import pytest

from starfold.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert oracle.difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
             "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_types(spark, sf_dir, con, name):
    relation = con.sql(ORACLES[name])
    expected = dict(zip(relation.columns, [str(t) for t in relation.types]))
    got = {c: SQL_TYPES.get(t, t.upper()) for c, t in QUERIES[name](spark, sf_dir).dtypes}
    assert got == expected


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
