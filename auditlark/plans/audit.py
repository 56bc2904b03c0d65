"""The whole audit of many entities as one set of lazy DataFrames."""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlark.operators import evaluate as E
from auditlark.operators import forensics, policy, report, rules, sla, violations
from auditlark.operators.ranking import ordered_position
from auditlark.rulepack import DEFAULT_PACK, REPORT_FRAMEWORK, REPORT_SCOPE, REPORT_TITLE, RulePack
from auditlark.session import materialize


@dataclasses.dataclass
class Audit:
    entities: DataFrame
    rules: DataFrame
    pii_report: DataFrame
    coverage: DataFrame
    appeals: DataFrame
    sla: DataFrame | None
    violations: DataFrame
    severity: DataFrame
    scores: DataFrame
    recommendations: DataFrame


def run_audit(
    policies: DataFrame,
    pii_report: DataFrame,
    statutes: DataFrame,
    requests: DataFrame | None = None,
    pack: RulePack = DEFAULT_PACK,
    keep: bool = True,
) -> Audit:
    """Audit every entity.

    policies: ``entity_id, jurisdiction, text`` (any number of rows per entity)
    pii_report: report rows of ``forensics`` plus ``entity_id``
    statutes: ``jurisdiction, doc_id, text``
    requests: request log rows plus ``entity_id``

    ``keep`` materialises what several results read, each one row per source,
    entity or right, so no text or table is scanned twice.
    """
    hold = materialize if keep else (lambda df: df)
    extracted = hold(rules.extract_rules(statutes, "jurisdiction", "doc_id", "text", pack))
    found = hold(pii_report)
    entities = hold(policies.groupBy("entity_id").agg(F.min("jurisdiction").alias("jurisdiction")))
    by_entity = entities.join(
        extracted.select(F.col("corpus_id").alias("jurisdiction"), "threshold", F.col("consumer_rights.rights").alias("rights")),
        "jurisdiction", "left",
    )

    described = pack.replace(policy_rights=pack.described_rights)
    coverage = hold(policy.coverage_from_text(policies, "entity_id", "text", described))
    required = by_entity.where(F.size("rights") > 0).select("entity_id", F.explode("rights").alias("right"))
    missing = policy.missing_rights(coverage, required, pack)

    clean = found.where(F.col("error").isNull())
    types = clean.select("entity_id", "source", F.explode("pii_detected").alias("type"))
    undisclosed = violations.undisclosed_data(types, policies, "entity_id", "text", pack)

    consumers = forensics.total_consumers(found, ["entity_id"])
    threshold = violations.threshold_violations(
        consumers, by_entity.select("entity_id", "threshold.value", "threshold.confidence"))

    appeals = hold(policy.appeal_quality(policies, "entity_id", "text", pack))
    summary = hold(sla.sla_summary(requests, "entity_id", pack)) if requests is not None else None
    late = sla.appeal_violations(appeals, summary, pack)

    every = hold(violations.in_order(violations.union_violations(missing, undisclosed, threshold, late), pack))
    return Audit(
        entities=by_entity,
        rules=extracted,
        pii_report=found,
        coverage=coverage,
        appeals=appeals,
        sla=summary,
        violations=every,
        severity=violations.severity_summary(every, entities),
        scores=report.risk_scores(every, entities, pack),
        recommendations=report.recommendations(every, pack),
    )


def report_items(audit: Audit) -> DataFrame:
    """What a report lists, one row each: ``entity_id, kind, position, row`` with the row as JSON. Nothing is grouped, so no entity is too large.

    Kinds are ``detail`` (a source of the PII report), ``compliance`` and ``appeals`` (violations by the step that found them), ``violation`` (all) and
    ``recommendation``; positions count from 1 in each list.
    """
    def items(rows: DataFrame, kind: str, columns: list[str], order: Column) -> DataFrame:
        return rows.select("entity_id", F.lit(kind).alias("kind"), order.cast("string").alias("order"), F.to_json(F.struct(*columns)).alias("row"))

    details = [c for c in audit.pii_report.columns if c != "entity_id"]
    found = [c for c in audit.violations.columns if c not in ("entity_id", "position")]
    place = F.lpad(F.col("position").cast("string"), 19, "0")
    lists = [
        items(audit.pii_report, "detail", details, F.col("source")),
        items(audit.violations.where(~violations.found_by_appeals()), "compliance", found, place),
        items(audit.violations.where(violations.found_by_appeals()), "appeals", found, place),
        items(audit.violations, "violation", found, place),
        items(audit.recommendations, "recommendation", ["for_violation", "right", "data_category", "priority", "recommendation"], place),
    ]
    return ordered_position(reduce(DataFrame.unionByName, lists), ["entity_id", "kind"], ["order", "row"]).drop("order")


def report_rows(audit: Audit, generated_at=None, usage: DataFrame | None = None) -> DataFrame:
    """The blocks of a report that have one value per entity, ready for the JSON sink; ``report_items`` has the lists.

    ``usage`` (``entity_id, agent, input_tokens, output_tokens, total_cost_usd, duration_ms``) fills the cost block, which is zero without.
    """
    stamp = F.lit(generated_at).cast("timestamp") if generated_at else F.current_timestamp()
    clean = F.col("error").isNull()
    totals = audit.pii_report.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("files_analyzed"),
        F.coalesce(F.sum(F.when(clean, F.col("unique_consumers"))), F.lit(0)).alias("total_unique_consumers"),
    )
    # Types are those of the rule pack and the model, so a set of them is small.
    types = audit.pii_report.where(clean).select("entity_id", F.explode("pii_detected").alias("t")).groupBy("entity_id").agg(
        F.array_sort(F.collect_set("t")).alias("pii_types_detected"))

    appeals = audit.appeals.select("entity_id", F.struct("has_appeal", "quality", "matched_terms", "confidence").alias("appeal_procedure"))
    summary = audit.scores.select("entity_id", F.struct(
        "overall_status", "risk_score", "risk_grade", "risk_label", "total_violations", "critical_violations", "high_violations",
    ).alias("executive_summary"))
    rules = audit.entities.select("entity_id", F.struct(F.struct(*[c for c in audit.entities.columns if c != "entity_id"]).alias("applicable_rules")).alias("regulatory_analysis"))

    def step(rows: DataFrame, name: str) -> DataFrame:
        counted = violations.severity_summary(rows, audit.entities)
        counts = F.struct("total_violations", "critical", "high", "medium", "info").alias("summary")
        return counted.select("entity_id", F.struct("status", "risk_level", counts).alias(name))

    compliance = step(audit.violations.where(~violations.found_by_appeals()), "compliance_findings")
    by_appeals = step(audit.violations.where(violations.found_by_appeals()), "__appeals")
    singles = [totals, types, appeals, rules, compliance, by_appeals]
    if audit.sla is not None:
        singles.append(audit.sla.select("entity_id", F.struct(*[c for c in audit.sla.columns if c != "entity_id"]).alias("timeline_analysis")))
    cost = report.empty_cost()
    if usage is not None:
        singles.append(report.cost_blocks(usage))
        cost = F.coalesce("_cost_summary", cost)
    heads = reduce(lambda a, b: a.join(b, "entity_id", "left"), singles, summary)
    findings = F.struct("files_analyzed", "total_unique_consumers", "pii_types_detected").alias("pii_findings")
    timeline = ["timeline_analysis"] if audit.sla is not None else []
    appeal_block = F.struct("appeal_procedure", *timeline, F.col("__appeals.risk_level").alias("risk")).alias("appeals_findings")
    metadata = F.struct(F.lit(REPORT_TITLE).alias("report_title"), stamp.alias("generated_at"), F.lit(REPORT_FRAMEWORK).alias("framework"), F.lit(REPORT_SCOPE).alias("scope"))
    return heads.select("entity_id", stamp.alias("generated_at"), metadata.alias("metadata"), "executive_summary", "regulatory_analysis", findings, "compliance_findings",
                        appeal_block, cost.alias("_cost_summary"))


def report_documents(audit: Audit, generated_at=None, usage: DataFrame | None = None) -> DataFrame:
    """Whole reports as lines ``entity_id, section, position, line``: in that order the lines of an entity are one JSON document.

    Lists stay rows, however long, so nothing is gathered per entity.
    """
    heads = report_rows(audit, generated_at, usage)

    def inner(*fields: Column | str) -> Column:
        """The members of a JSON object without its braces."""
        whole = F.to_json(F.struct(*fields))
        return F.substring(whole, F.lit(2), F.length(whole) - 2)

    def at(section: int, line: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), line.alias("line"))

    frame = heads.select("entity_id", F.inline(F.array(
        at(0, F.concat(F.lit("{"), inner("metadata", "executive_summary", "regulatory_analysis"), F.lit(',"pii_findings":{'), inner("pii_findings.*"), F.lit(',"details":['))),
        at(2, F.concat(F.lit(']},"compliance_findings":{'), inner("compliance_findings.*"), F.lit(',"violations":['))),
        at(4, F.concat(F.lit(']},"appeals_findings":{'), inner("appeals_findings.*"), F.lit(',"violations":['))),
        at(6, F.lit(']},"violations":[')), at(8, F.lit('],"recommendations":[')), at(10, F.concat(F.lit('],"_cost_summary":'), F.to_json("_cost_summary"), F.lit("}"))),
    ))).withColumn("position", F.lit(0).cast("bigint"))
    section = F.array_position(F.lit(["detail", "compliance", "appeals", "violation", "recommendation"]), F.col("kind")) * 2 - 1
    listed = report_items(audit).select("entity_id", section.cast("int").alias("section"), "position",
                                        F.concat(F.when(F.col("position") > 1, ",").otherwise(""), F.col("row")).alias("line"))
    return frame.unionByName(listed)


def evaluate_audit(audit: Audit, expected: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The audit scored per entity against expected violations, non-violations,
    PII types and right coverage (each with ``entity_id``)."""
    key = ["entity_id"]
    accuracy = E.violation_accuracy(audit.violations, expected["violations"], expected["non_violations"], key)
    detected = audit.pii_report.where(F.col("error").isNull()).select("entity_id", F.explode("pii_detected").alias("type"))
    pii = E.precision_recall(E.pii_type_sets(detected, expected["pii_types"], key), key)
    checked = E.coverage_check(expected["coverage"], audit.violations, key)
    score = E.coverage_score(checked, key)
    metrics = (
        audit.scores.select("entity_id", F.lit(True).alias("has_summary"), (F.col("total_violations") > 0).alias("has_violations"))
        .join(accuracy.select("entity_id", F.col("accuracy").alias("violation_accuracy")), "entity_id", "left")
        .join(pii.select("entity_id", F.col("f1").alias("pii_f1")), "entity_id", "left")
        .join(score.select("entity_id", F.col("score").alias("coverage_score")), "entity_id", "left")
        .join(audit.appeals.select("entity_id", F.lit(True).alias("has_appeal")), "entity_id", "left")
        .join(audit.entities.select("entity_id", (F.size("rights") > 0).alias("has_rules")), "entity_id", "left")
    )
    return {"violation_accuracy": accuracy, "pii": pii, "coverage": checked, "score": score,
            "stages": E.stage_status(metrics, key)}
