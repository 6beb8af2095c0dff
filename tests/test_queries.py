import pytest

import __spark_entry__ as entry
from oracle import DATA, same

NAMES = sorted(n for n in entry.queries() if not n.startswith("p") or not n[1:2].isdigit() or n.startswith(("p3", "p4")))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    sql = entry.oracle_sql().get(name)
    if sql:
        same(entry.queries()[name], sql, spark)
    else:
        assert entry.queries()[name](spark, str(DATA / "sf0.001")).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
