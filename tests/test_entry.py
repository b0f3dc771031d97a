"""Driver contract smoke test."""
import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "aqi_day1" in df.columns and "city" in df.columns


def test_every_query_has_a_name_and_most_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60
