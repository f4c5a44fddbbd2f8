import __spark_entry__ as entry


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_sql_has_a_query_for_each_name():
    assert set(entry.oracle_sql()) <= set(entry.queries())
