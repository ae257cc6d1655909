import os

import pytest

import __spark_entry__ as contract
from tests.oracle_check import compare, connect

SF_DIR = os.environ.get("GALLEY_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_statements_need_no_file_of_the_installation(spark, monkeypatch):
    monkeypatch.setattr("pathlib.Path.glob", lambda *_: iter(()))
    monkeypatch.setattr("zipfile.ZipFile", None)
    assert set(contract.oracle.oracle_sql()) <= set(SQL)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    if name in SQL:
        result, _ = compare(spark, connection, SF_DIR, QUERIES[name], SQL[name])
        assert result == "ok"
    else:
        assert QUERIES[name](spark, SF_DIR).count() > 0
