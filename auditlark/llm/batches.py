"""Whole texts in Arrow batches: few rows at a time, each text once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches hold at most ``ROWS`` rows: a batch of 10,000 whole texts costs
    every task some hundred megabytes on both sides of the pipe. A smaller setting stays."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(KEY)) <= ROWS:
        conf.set(KEY, str(ROWS))
    return df


def with_text(df: DataFrame, others: list[str], text_col: str) -> tuple[DataFrame, int]:
    """The columns ``others`` and the place of the text among them; one that is no string is added in its string form."""
    if text_col in others and dict(df.dtypes)[text_col] == "string":
        return small_batches(df).select(*(F.col(f"`{c}`") for c in others)), others.index(text_col)
    return small_batches(df).select(*(F.col(f"`{c}`") for c in others), F.col(f"`{text_col}`").cast("string").alias("__text")), len(others)
