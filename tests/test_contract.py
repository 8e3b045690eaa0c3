"""Driver contract: entry runs; every oracle key is a registered query."""
import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"profile", "id", "received", "outcome"}
    assert df.count() >= 0


def test_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
