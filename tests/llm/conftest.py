import pytest


@pytest.fixture(autouse=True)
def own_batches(spark):
    """The pipeline bounds Arrow's batches for its session, which all tests share: each test starts with the session's own bound."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    yield
    spark.conf.set(name, before)
