"""Every registered query against its SQL twin on the smallest tables."""

import pathlib

import pytest

FOLDER = "/root/testdata/sf0.001"

pytest.importorskip("duckdb")
if not pathlib.Path(FOLDER).exists():
    pytest.skip("no test tables", allow_module_level=True)

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check import compare, connect  # noqa: E402
from tabq.plans.registry import QUERIES as OWN  # noqa: E402

REGISTERED, STATEMENTS = queries(), oracle_sql()
QUERIES = {name: REGISTERED[name] for name in OWN}
#: Answers whose keys must be real values; a single NULL row would prove little.
LIVE = ["mq01", "mq02", "mq03", "mq04", "mq05", "mq06", "mq12", "fr21", "fr22", "fr24", "fr25"]


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_a_statement():
    assert set(QUERIES) <= set(STATEMENTS) <= set(REGISTERED)


@pytest.mark.parametrize("name", LIVE)
def test_answers_have_no_column_of_nulls(name, spark):
    found = [r.asDict() for r in QUERIES[name](spark, FOLDER).collect()]
    assert found and all(any(r[c] is not None for r in found) for c in found[0])


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, connection):
    assert compare(spark, connection, FOLDER, name, QUERIES[name], STATEMENTS[name]) is None


def test_entry(spark):
    assert entry(spark).count() == 1
