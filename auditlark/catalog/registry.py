"""Registration of queries, shared inputs and SQL building helpers."""

from __future__ import annotations

import dataclasses
import importlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlark.rulepack import DEFAULT_PACK
from auditlark.sources.tables import spread


@dataclasses.dataclass(frozen=True)
class Query:
    name: str
    covers: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}
MODULES = ("forensics", "documents", "requests", "rules", "policy", "findings", "evaluation", "texts", "learning", "generated", "audit")


def query(covers: str, sql: str | None = None):
    """Register ``f(spark, folder)`` under its own name."""
    def register(f):
        QUERIES[f.__name__] = Query(f.__name__, covers, f, sql)
        return f

    return register


def load_all() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"auditlark.catalog.{module}")
    return QUERIES


def table(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None, heavy: bool = False) -> DataFrame:
    """A standard table; ``heavy`` ones are dealt over ``spark.auditlark.partitions`` tasks if that is set."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    df = df.select(*columns) if columns else df
    asked = spark.conf.get("spark.auditlark.partitions", None) if heavy else None
    return spread(df, int(asked) if asked else None)


# --- SQL text helpers ------------------------------------------------------

def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_count(column: str, pattern: str) -> str:
    return f"len(regexp_extract_all({column}, {quoted(pattern)}))"


def sql_any(column: str, terms) -> str:
    return "(" + " OR ".join(f"contains({column}, {quoted(t)})" for t in terms) + ")"


def sql_first(column: str, terms) -> str:
    return "CASE " + " ".join(f"WHEN contains({column}, {quoted(t)}) THEN {quoted(t)}" for t in terms) + " END"


def sql_kept(items) -> str:
    """A list of CASE results without the nulls."""
    return "list_filter([" + ", ".join(items) + "], lambda x: x IS NOT NULL)"


def sql_round(value: str, digits: int) -> str:
    """Rounding of the exact binary value."""
    return f"CAST(format('{{:.{digits}f}}', CAST({value} AS DOUBLE)) AS DOUBLE)"


def sql_uniform(key: str, salt: str, seed: int = 42) -> str:
    return f"CAST(('0x' || substr(md5(concat_ws('|', CAST({key} AS VARCHAR), '{salt}', '{seed}')), 1, 8)) AS BIGINT)"


def sql_pick(key: str, salt: str, values) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + f"][1 + {sql_uniform(key, salt)} % {len(values)}]"


def sql_between(key: str, salt: str, low: int, high: int) -> str:
    return f"({sql_uniform(key, salt)} % {high - low + 1} + {low})"


def joined(column: str | Column) -> Column:
    """An array as one comma-separated string."""
    return F.array_join(column, ",")


# --- A rule pack of terms that occur in the standard tables ---------------------

DATA_PACK = DEFAULT_PACK.replace(
    keywords=DEFAULT_PACK.keywords + (
        ("license_terms", ("license", "licensed under", "released under", "public license")),
        ("secret_marks", ("token",)),
        ("reservations", ("all rights reserved", "reserved")),
        ("word_endings", ("ción", "keit", "eaux", "ation", "ouelle")),
    ),
    statute_rights=(
        ("use", ("licensed under", "released under")),
        ("modify", ("general public license", "version 3")),
        ("share", ("apache license", "mit license")),
        ("reserve", ("all rights reserved",)),
        ("hold", ("token", "secret")),
    ),
    categories=("license", "worthless", "token", "all rights reserved", "personal data of a known child"),
    exemptions=(
        ("permissive", ("mit license", "apache license")),
        ("copyleft", ("gnu general public", "copyleft")),
        ("closed", ("rights reserved",)),
        ("unseen", ("no text holds these words",)),
    ),
    threshold_levels=(
        (100000, 0.95, (r"public\s+license,\s+version\s+3", r"gnu.*?version")),
        (35000, 0.90, (r"version\s+2\.0", r"mit\s+license")),
    ),
    timelines=(
        ("consumer_request_response_days", (r"license,\s+version\s+(\d+)", r"public\s+license.*?(\d+)")),
        ("cure_period_days", (r"token\s*=\s*\W?(\d+)",)),
        ("appeal_response_days", (r"(\d{1,6})\.\d",)),
    ),
    policy_rights=(
        ("use", "This work is licensed under the GNU General Public License, version 3.", ("license", "licensed")),
        ("share", "Licensed under the Apache License, Version 2.0.", ("apache", "mit license")),
        ("reserve", "All rights reserved.", ("reserved",)),
        ("repeat", "The and attion to thanedble the, anea. Eriner thanea.", ("thanedble", "no such word")),
    ),
    high_severity_rights=("use", "reserve"),
    appeal_terms=("license", "reserved", "worthless", "appeal"),
    appeal_detail_terms=("public license", "apache license", "submit an appeal"),
    disclosure_terms=(
        ("license_terms", ("ción", "lizenz")),
        ("secret_marks", ("keit",)),
        ("reservations", ("eaux", "ouelle")),
        ("word_endings", ("sch ", "que")),
        ("health_data", ("the ",)),
    ),
)
