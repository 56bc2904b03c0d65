"""Consumer request logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlark.functions import text as X
from auditlark.operators.sla import date_columns
from auditlark.rulepack import DEFAULT_PACK, RulePack
from auditlark.sources.files import Files, read_csv_files
from auditlark.sources.tables import read_table


def read_request_log(spark: SparkSession, path: str, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """A log with its date columns renamed to ``request_date`` and ``response_date``."""
    return canonical_log(read_table(spark, path), pack)


def read_request_logs(spark: SparkSession, folder: str, expected: list[str] | None = None, pack: RulePack = DEFAULT_PACK) -> Files:
    """All CSV logs below a folder, whatever their headers, in one scan.

    ``rows``: ``source, cells, request_date, response_date``, the dates as written. ``status`` has an error for every file that is missing, unreadable, or without two date columns.
    Each file's header decides which of its cells are the dates; of several candidates the rightmost, as for a single log.
    """
    files = read_csv_files(spark, folder, expected)
    role = {n: "request" for n in pack.request_date_names} | {n: "response" for n in pack.response_date_names if n not in pack.request_date_names}

    def rightmost(kind: str) -> Column:
        names = [n for n, r in role.items() if r == kind]
        places = F.filter(F.sequence(F.lit(0), F.size("header") - 1), lambda i: F.lower(X.strip(F.get("header", i))).isin(*names))
        return F.when(F.size("header") > 0, F.array_max(places))

    status = files.status.withColumns({"request_at": rightmost("request"), "response_at": rightmost("response")})
    no_dates = F.col("error").isNull() & (F.col("request_at").isNull() | F.col("response_at").isNull())
    problem = F.concat(F.lit("Could not identify date columns. Found: "), F.array_join("header", ", "))
    status = status.withColumn("error", F.when(no_dates, problem).otherwise(F.col("error")))
    usable = status.where(F.col("error").isNull()).select("source", "request_at", "response_at")
    rows = files.rows.join(usable, "source").select(
        "source", "cells", F.get("cells", F.col("request_at")).alias("request_date"), F.get("cells", F.col("response_at")).alias("response_date"))
    return Files(rows, status.drop("request_at", "response_at"))


def canonical_log(log: DataFrame, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    request, response = date_columns(log.columns, pack)
    chosen = {request: "request_date", response: "response_date"}
    rest = [c for c in log.columns if c not in chosen and c not in chosen.values()]
    return log.select(*[F.col(f"`{c}`") for c in rest], *[F.col(f"`{c}`").alias(n) for c, n in chosen.items()])
