import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sentilake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Apply a column function to a list of texts and return the results in order."""
    def run(fn, values, type_="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"row_id bigint, x {type_}")
        from pyspark.sql import functions as F
        got = rows.select("row_id", fn(F.col("x")).alias("y")).collect()
        return [r["y"] for r in sorted(got, key=lambda r: r["row_id"])]
    return run


@pytest.fixture(scope="session")
def reviews(spark):
    def make(values):
        return spark.createDataFrame(list(enumerate(values)), "row_id bigint, review_text string")
    return make
