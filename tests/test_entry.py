"""The driver contract in __spark_entry__.py."""
import os

import pytest

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_entry_runs_on_smoke_data_with_stable_schema(spark):
    import __spark_entry__ as E
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema
    assert a.count() > 0
    assert {"entity", "date", "confirmed", "new_confirmed", "base_day", "most_recent"} <= set(a.columns)


def test_contract_shapes():
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    assert qs and set(sql) <= set(qs)
    assert all(callable(f) for f in qs.values()) and all(isinstance(q, str) and q.strip() for q in sql.values())
