"""Driver contract: every oracle key is a registered query; entry runs."""

import __spark_entry__ as E


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "retrain_needed" in df.columns
