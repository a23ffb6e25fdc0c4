import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dayprints import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session.build("tests", master="local[4]", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def table(spark):
    """Rows of tuples or dicts as a DataFrame, with text cast to timestamps for ``ts``."""
    def make(rows, schema):
        text = schema.replace("ts timestamp_ntz", "ts string")
        df = spark.createDataFrame(rows, text)
        if text != schema:
            df = df.withColumn("ts", df["ts"].cast("timestamp_ntz"))
        return df
    return make
