import pytest
from pyspark.sql import functions as F


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with a clashing extra column or two."""
    def make(rows):
        df = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string")
        return df.withColumns({"n": F.lit(1), "sig": F.lit("x"), "score": F.lit("y"),
                               "label": F.lit(2), "lang_": F.lit(None).cast("string")})
    return make


LONG = "ab c" * 60_000 + "x" * 50_000
EDGE = [(1, None), (2, ""), (3, "  \n\t "), (4, LONG), (4, LONG), (None, "some words here"),
        (5, "\U0001f600 é中文 a'll  b\r\n")]
