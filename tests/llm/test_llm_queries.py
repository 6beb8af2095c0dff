import pytest

from oracle import DATA, same
from seqloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    if name in queries.SQL:
        same(queries.QUERIES[name], queries.SQL[name], spark)
    else:
        assert queries.QUERIES[name](spark, str(DATA / "sf0.001")).count() > 0
