"""Policies and statutes: whole documents, markup, and documents per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditlark.functions import text as X
from auditlark.rulepack import NEXT_DOCUMENT


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``doc_id`` (file name) and its whole text."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("doc_id"), F.col("value").alias("text"))


def html_documents(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Plain text of marked-up pages."""
    return pages.select(F.col(key).alias("doc_id"), X.html_to_text(F.col(html)).alias("text"))


def ordered_documents(docs: DataFrame, entity: str, order: str, text: str) -> DataFrame:
    """An entity's documents as rows in reading order: ``entity_id, position, text``, the form for entities of any size."""
    place = F.row_number().over(Window.partitionBy(F.col(entity)).orderBy(F.col(order)))
    return docs.select(F.col(entity).alias("entity_id"), place.alias("position"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def assemble(docs: DataFrame, entity: str, order: str, text: str, separator: str = NEXT_DOCUMENT) -> DataFrame:
    """An entity's documents as one text, in the order of ``order``: one row per entity, always.

    For texts a reader takes whole. The operators accept the rows of ``ordered_documents`` alike and never need the joined form.
    """
    rows = docs.select(F.col(entity).alias("entity_id"), F.struct(F.col(order).alias("o"), F.coalesce(F.col(text), F.lit("")).alias("t")).alias("doc"))
    return rows.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.array_join(F.transform(F.array_sort(F.collect_list("doc")), lambda d: d["t"]), separator).alias("text"),
    )
