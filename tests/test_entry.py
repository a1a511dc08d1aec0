import __spark_entry__ as driver


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0
