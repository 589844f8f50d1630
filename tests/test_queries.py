"""Every registered query against its SQL."""

import pytest
from oracle import compare, duck

import __spark_entry__ as contract

TYPES = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "double": "DOUBLE",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    got = df.toPandas()
    if name in ORACLES:
        compare(got, con.execute(ORACLES[name]).df())
        described = con.execute(f"DESCRIBE {ORACLES[name].strip()}").fetchall()
        assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == {r[0]: r[1] for r in described}
    else:
        assert len(got) > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
