"""Business tables: one DataFrame per table, and error rows for unreadable ones."""

from __future__ import annotations

import os
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlark.operators.forensics import REPORT_SCHEMA

def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows over ``partitions`` tasks before costly per-row work, where the caller asks for it.

    A file is split by row group only, so a small one is a single task; large inputs have row groups enough.
    """
    return df.repartition(partitions) if partitions else df


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """One table by file ending: parquet, orc, json or CSV with header.

    CSV columns stay strings unless a schema is given, so zip codes keep their
    zeros and no extra pass infers types; malformed lines keep what parses.
    """
    ending = os.path.splitext(path.rstrip("/"))[1].lower()
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if ending == ".csv":
        return reader.option("header", True).option("mode", "PERMISSIVE").csv(path)
    if ending in (".json", ".orc"):
        return reader.format(ending[1:]).load(path)
    return reader.parquet(path)


def read_tables(spark: SparkSession, paths: list[str], schemas: dict | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Readable tables by file name, and report rows with ``error`` for the others."""
    tables, errors = {}, []
    for path in paths:
        name = os.path.basename(path.rstrip("/"))
        try:
            tables[name] = read_table(spark, path, (schemas or {}).get(name))
        except (PySparkException, Py4JJavaError) as problem:
            # Only the kind of problem is kept: messages may quote file contents.
            kind = (problem.getCondition() if isinstance(problem, PySparkException) else None) or "UNREADABLE_FILE"
            errors.append((name, "File not found" if kind == "PATH_NOT_FOUND" else f"Could not read table: {kind}"))
    failed = spark.createDataFrame(errors, "source string, error string")
    return tables, _as_report(failed)


def _as_report(failed: DataFrame) -> DataFrame:
    fields = failed.sparkSession.createDataFrame([], REPORT_SCHEMA).schema.fields
    return failed.select(*[
        F.col(f.name) if f.name in ("source", "error") else F.lit(None).cast(f.dataType).alias(f.name) for f in fields
    ])


def table_catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table; counts need no column data."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("source"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_cols"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def read_many_csv(spark: SparkSession, folder: str, schema) -> DataFrame:
    """All CSV files of one layout in a single scan, with the file name as source."""
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(folder)
    return df.withColumn("source", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
