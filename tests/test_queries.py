"""Every registered query against its SQL on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as contract
from riskstream.oracles import ORACLES
from riskstream.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def cell(value):
        return round(value, 9) if isinstance(value, float) else value

    return sorted([tuple(cell(row[i]) for i in order) for row in rows], key=repr)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert set(contract.queries()) >= set(REGISTRY)
    assert set(contract.queries()) >= set(contract.oracle_sql()) >= set(ORACLES)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = contract.queries()[name](spark, SF), duck.sql(contract.oracle_sql()[name])
    rows = ours.collect()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(rows) > 0
    assert canonical(ours.columns, rows) == canonical(theirs.columns, theirs.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
