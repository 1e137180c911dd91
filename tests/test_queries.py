"""Every registered query against its SQL on DuckDB."""

import pytest

import __spark_entry__ as entry
from bridge import load_registry
from tests.oracle import connect, mismatch

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    registry = load_registry()
    assert set(registry.QUERIES) == set(registry.ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(load_registry().ORACLES))
def test_query(spark, con, name):
    sql = entry.oracle_sql()[name]
    assert mismatch(spark, con, name, entry.queries()[name], sql, SF) is None


@pytest.mark.parametrize(
    "name",
    ["decision_table", "agg_user_policy", "history_reanchor", "conform_bureau", "decision_documents"],
)
def test_types(spark, con, name):
    got = {c: TYPES.get(t, t) for c, t in entry.queries()[name](spark, SF).dtypes}
    want = {r[0]: r[1] for r in con.execute("DESCRIBE " + entry.oracle_sql()[name]).fetchall()}
    assert got == want


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["request_id", "accept_ind", "bureau_history_status", "bnpl_limit", "error_reason"]
