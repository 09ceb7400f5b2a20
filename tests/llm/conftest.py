import pytest


@pytest.fixture
def small_batches(spark):
    """Few rows per Arrow batch, so that work meets across batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
