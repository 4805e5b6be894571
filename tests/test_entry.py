"""The driver contract: entry runs on sf0.001, registry keys are consistent."""
import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and set(df.columns) == {"class", "precision", "recall", "f1", "support"}


def test_registry_names():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
