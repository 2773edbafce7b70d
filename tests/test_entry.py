import __spark_entry__ as entry


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    row = entry.entry(spark).first()
    assert row["total"] > 0 and row["chatml"] == row["total"]
