import pytest


@pytest.fixture
def texts(spark):
    """Documents (doc_id, text) with nulls, empty and long texts, ties, a repeated row, and extra columns with clashing names."""
    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        from pyspark.sql import functions as F

        return df.select("*", F.lit("x").alias("score"), F.lit(1).alias("n_chars"), F.lit("y").alias("component_id"), F.lit("z").alias("key"), F.lit("w").alias("mark"))

    return make


AWKWARD = [(1, None), (2, ""), (3, "   \n\n "), (4, "word"), (4, "word"), (None, "no id here at all"), (5, "a " * 30_000), (6, "日本語 \U0001f389 é̀ ½"), (7, "...!?"), (8, "12 34")]


@pytest.fixture
def awkward():
    return AWKWARD
