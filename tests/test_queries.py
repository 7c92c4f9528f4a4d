"""Every registered query runs; those with SQL agree with DuckDB."""

import oracle
import pytest

from quiremill.plans import queries  # noqa: F401
from quiremill.plans.registry import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLE_SQL:
        oracle.same(df, ORACLE_SQL[name], sf)
    else:
        assert df.count() > 0
