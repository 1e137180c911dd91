import pytest

from tests.oracle import connect, mismatch
from tradeline.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_its_sql(spark, name, sf):
    assert mismatch(spark, connect(sf), name, queries.QUERIES[name], queries.ORACLES[name], sf) is None
