import pytest


@pytest.fixture(scope="session")
def make(spark):
    """A DataFrame of rows by DDL."""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)
