"""Violations of every kind in one schema, and what follows from their severities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlark.functions import text as X
from auditlark.functions.literals import constant
from auditlark.operators.ranking import ordered_position
from auditlark.rulepack import APPEAL_VIOLATIONS, DEFAULT_PACK, VIOLATION_ORDER, RulePack

VIOLATION_COLUMNS = {
    "entity_id": "string", "type": "string", "right": "string", "data_category": "string", "source_file": "string",
    "severity": "string", "confidence": "double", "similarity_score": "double", "late_count": "bigint",
    "total_count": "bigint", "late_percentage": "double", "total_unique": "bigint", "threshold": "bigint",
    "description": "string",
}


def conform(rows: DataFrame) -> DataFrame:
    """Any violation rows in the common schema; absent fields are null."""
    return rows.select(*[
        (F.col(n) if n in rows.columns else F.lit(None)).cast(t).alias(n) for n, t in VIOLATION_COLUMNS.items()
    ])


def union_violations(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [conform(p) for p in parts])


def disclosed_categories(policies: DataFrame, entity: str, text: str, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """Per entity: categories its policies mention. Texts stay where they are read."""
    tables = {
        f"mask_{start}": constant([{"name": c, "terms": list(terms), "bit": 1 << i} for i, (c, terms) in enumerate(pack.disclosure_terms[start:start + X.TERMS_PER_MASK])])
        for start in range(0, len(pack.disclosure_terms), X.TERMS_PER_MASK)
    }

    def mask(table: Column, t: Column) -> Column:
        return F.aggregate(table, F.lit(0).cast("bigint"), lambda acc, c: F.when(
            F.exists(c["terms"], lambda k: F.contains(t, k)), acc.bitwiseOR(c["bit"])).otherwise(acc))

    masks = X.let(F.lower(F.coalesce(F.col(text), F.lit(""))), lambda t: F.struct(*[mask(table, t).alias(n) for n, table in tables.items()]))
    grouped = policies.select(F.col(entity).alias("entity_id"), X.once(masks)).groupBy("entity_id").agg(*[F.bit_or(n).alias(n) for n in tables])
    def seen(name: str, table: Column) -> Column:
        return F.filter(table, lambda c: F.col(name).bitwiseAND(c["bit"]) != 0)

    named = F.concat(*[seen(n, table) for n, table in tables.items()])
    return grouped.select("entity_id", F.transform(named, lambda c: c["name"]).alias("disclosed"))


def undisclosed_data(
    detected: DataFrame, policies: DataFrame, entity: str, text: str, pack: RulePack = DEFAULT_PACK
) -> DataFrame:
    """Detected sensitive categories that the entity's policy does not mention.

    ``detected`` has ``entity_id, source, type``. Categories without disclosure
    terms are skipped; an entity without any policy discloses nothing.
    """
    known = [c for c, _ in pack.disclosure_terms]
    disclosed = disclosed_categories(policies, entity, text, pack)
    open_rows = (
        detected.where(F.col("type").isin(*known))
        .join(disclosed, "entity_id", "left")
        .where(~F.coalesce(F.array_contains("disclosed", F.col("type")), F.lit(False)))
    )
    return open_rows.select(
        "entity_id",
        F.lit("UNDISCLOSED_SENSITIVE_DATA").alias("type"),
        F.col("type").alias("data_category"),
        F.col("source").alias("source_file"),
        F.lit("CRITICAL").alias("severity"),
        F.lit(0.9).alias("confidence"),
        F.format_string("Detected '%s' in business data but privacy policy does not disclose processing of this category.",
                        F.col("type")).alias("description"),
    )


def threshold_violations(consumers: DataFrame, rules: DataFrame, key: str = "entity_id") -> DataFrame:
    """Entities whose consumer total reaches the statute's threshold.

    ``consumers``: key and ``total_unique_consumers``; ``rules``: key, ``value``
    and ``confidence``. A missing or zero value never fires.
    """
    total, limit = F.col("total_unique_consumers"), F.col("value")
    return (
        consumers.join(rules, key)
        .where((limit != 0) & (total >= limit))
        .select(
            F.col(key).alias("entity_id"),
            F.lit("THRESHOLD_TRIGGERED").alias("type"),
            F.lit("INFO").alias("severity"),
            F.coalesce("confidence", F.lit(0.8)).alias("confidence"),
            total.alias("total_unique"),
            limit.alias("threshold"),
            F.concat(F.lit("Business processes data of "), F.format_number(total, 0),
                     F.lit(" unique consumers, exceeding the CTDPA threshold of "), F.format_number(limit, 0),
                     F.lit(". Full CTDPA compliance is required.")).alias("description"),
        )
    )


def in_order(violations: DataFrame, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """Violations with their ``position`` in an entity's list: by type in the order of the audit's steps, then by right in the pack's order, category and file.

    Types and rights that the pack doesn't name come last, by name.
    """
    def rank(column: str, names) -> Column:
        place = F.array_position(F.array(*(F.lit(n) for n in names)), F.coalesce(F.col(column), F.lit("")))
        return F.when(place > 0, place).otherwise(len(names) + 1)

    keyed = violations.withColumns({
        "__type": rank("type", VIOLATION_ORDER), "__right": rank("right", [r for r, _, _ in pack.described_rights]),
        **{f"__{c}": F.coalesce(c, F.lit("")) for c in ("data_category", "source_file")}})
    order = ["__type", "type", "__right", "right", "__data_category", "__source_file"]
    return ordered_position(keyed, ["entity_id"], order).drop("__type", "__right", "__data_category", "__source_file")


def found_by_appeals() -> Column:
    """Violations of the appeals step; the others are those of the compliance check."""
    return F.col("type").isin(*APPEAL_VIOLATIONS)


def severity_count(severity: str) -> Column:
    return F.count_if(F.col("severity") == severity)


def severity_summary(violations: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """Counts per severity with status and risk level; clean entities too when ``entities`` is given."""
    counted = violations.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("total_violations"),
        *[severity_count(s.upper()).alias(s) for s in ("critical", "high", "medium", "info")],
    )
    if entities is not None:
        counted = entities.select("entity_id").distinct().join(counted, "entity_id", "left").na.fill(0)
    return counted.withColumns({"status": compliance_status(), "risk_level": risk_level()})


def compliance_status() -> Column:
    return (
        F.when((F.col("critical") > 0) | (F.col("high") > 0), "Non-Compliant")
        .when(F.col("total_violations") > 0, "Needs Review")
        .otherwise("Compliant")
    )


def risk_level() -> Column:
    return (
        F.when(F.col("critical") > 0, "CRITICAL")
        .when(F.col("high") > 0, "HIGH")
        .when(F.col("total_violations") > 0, "MEDIUM")
        .otherwise("LOW")
    )
