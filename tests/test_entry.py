"""Driver contract."""

import __spark_entry__ as E


def test_contract_keys():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 139


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"hour", "target", "split"} <= set(df.columns)
