"""Each query against its DuckDB SQL, on the smallest tables."""

import pytest

from tessera.plans.registry import ORACLE_SQL, QUERIES

from .oracle import connection, differences


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    if name in ORACLE_SQL:
        assert differences(spark, connection(sf), QUERIES[name], ORACLE_SQL[name], sf) is None
    else:
        assert QUERIES[name](spark, sf).columns
