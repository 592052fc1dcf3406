import __spark_entry__ as E


def test_registry_consistent():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 80


def test_entry_runs_on_smallest_scale(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "variable" in df.columns
