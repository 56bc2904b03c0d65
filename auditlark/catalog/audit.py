"""A whole audit: market segments are businesses, their customers hold generated personal data and have made one request each.

The SQL follows the same steps from the same tables: detection, rules, coverage, disclosure, deadlines, violations in order, scores.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from auditlark.catalog.findings import SQL_COUNTS, SQL_PLACED, sql_advice, sql_scores
from auditlark.catalog.forensics import sql_detections, sql_scan
from auditlark.catalog.generated import sql_customers, sql_policies, sql_requests
from auditlark.catalog.policy import sql_coverage
from auditlark.catalog.registry import query, quoted, sql_any, sql_kept, sql_round, table
from auditlark.catalog.rules import sql_rules
from auditlark.operators import forensics as FO
from auditlark.operators import synth as S
from auditlark.plans.audit import evaluate_audit, report_documents, report_items, report_rows, run_audit
from auditlark.rulepack import APPEAL_VIOLATIONS, DEFAULT_PACK
from auditlark.session import scratch_folder
from auditlark.sources import reports as store

STAMP = "2024-06-01 00:00:00"


def audit_inputs(spark, folder):
    """Policies, PII report, statutes and request log; every segment has a policy."""
    customer = table(spark, folder, "customer", ["c_custkey", "c_mktsegment"], heavy=True)
    rows = S.customers(customer, "c_custkey", keep=("c_mktsegment",)).withColumnRenamed("c_mktsegment", "entity_id")
    columns = [c for c in rows.columns if c != "entity_id"]
    scanned = FO.scan(rows, FO.row_text(rows, columns), ["entity_id"]).withColumnRenamed("entity_id", "source")
    found = FO.report_from_scan(scanned, columns).withColumn("entity_id", F.col("source"))
    policies = S.policies(customer.select("c_mktsegment").distinct(), "c_mktsegment").select(
        "entity_id", F.lit("CT").alias("jurisdiction"), "text")
    statutes = table(spark, folder, "documents", ["doc_id", "text"], heavy=True).select(F.lit("CT").alias("jurisdiction"), "doc_id", "text")
    requests = S.request_log(customer, 1000, "c_custkey", keep=("c_mktsegment",)).withColumnRenamed("c_mktsegment", "entity_id")
    return policies, found, statutes, requests


def usage(spark, folder):
    """What the agents of each audit used: events of the customers' numbers, by segment."""
    events = table(spark, folder, "events", ["event_id", "user_id", "event_type"])
    customer = table(spark, folder, "customer", ["c_custkey", "c_mktsegment"])
    joined = events.join(customer, F.col("user_id") == F.col("c_custkey"))
    return joined.select(F.col("c_mktsegment").alias("entity_id"), F.col("event_type").alias("agent"), F.pmod("event_id", F.lit(97)).alias("input_tokens"),
                         F.pmod("event_id", F.lit(31)).alias("output_tokens"), F.lit(0.0).alias("total_cost_usd"), F.pmod("event_id", F.lit(1009)).alias("duration_ms"))


_PACK = DEFAULT_PACK.replace(policy_rights=DEFAULT_PACK.described_rights)
_NULLS = {"right": "VARCHAR", "data_category": "VARCHAR", "source_file": "VARCHAR", "similarity_score": "DOUBLE", "late_count": "BIGINT", "total_count": "BIGINT",
          "late_percentage": "DOUBLE", "total_unique": "BIGINT", "threshold": "BIGINT"}


def _violation(kind: str, severity: str, confidence: str, relation: str, **known: str) -> str:
    """A SELECT of violations in the common columns."""
    cells = ", ".join(f"CAST({known.get(c, 'NULL')} AS {t}) AS \"{c}\"" for c, t in _NULLS.items())
    return f"SELECT entity_id, {quoted(kind)} AS type, {severity} AS severity, CAST({confidence} AS DOUBLE) AS confidence, {cells} FROM {relation}"


def _sql_audit() -> str:
    """CTEs up to ``v``, the violations, ``placed``, the same with their positions, and ``entities``."""
    cells = "customer_id, first_name, last_name, email, phone, ssn, address, city, state, zip, date_of_birth, diagnosis, treatment_plan, racial_ethnic_origin, religion, notes, account_status"
    standard = ", ".join(quoted(r) for r, _, _ in DEFAULT_PACK.policy_rights)
    high = ", ".join(quoted(r) for r in DEFAULT_PACK.high_severity_rights)
    disclosed = ", ".join(f"bool_or({sql_any('lower(text)', ts)}) AS d{i}" for i, (_, ts) in enumerate(DEFAULT_PACK.disclosure_terms))
    undisclosed = " ".join(f"WHEN {quoted(c)} THEN NOT coalesce(d{i}, false)" for i, (c, _) in enumerate(DEFAULT_PACK.disclosure_terms))
    basic, detailed = DEFAULT_PACK.appeal_terms, DEFAULT_PACK.appeal_detail_terms
    terms = ", ".join(f"bool_or(contains(lower(text), {quoted(t)})) AS a{i}" for i, t in enumerate((*basic, *detailed)))
    listed = [sql_kept([f"CASE WHEN a{i + at} THEN {quoted(t)} END" for i, t in enumerate(ts)]) for at, ts in ((0, basic), (len(basic), detailed))]
    branches = [
        _violation("MISSING_RIGHT", f"CASE WHEN \"right\" IN ({high}) THEN 'HIGH' ELSE 'MEDIUM' END", sql_round("1 - best_score", 4), "missing", right='"right"',
                   similarity_score=sql_round("best_score", 4)),
        _violation("UNDISCLOSED_SENSITIVE_DATA", "'CRITICAL'", "0.9", "undisclosed", data_category="category", source_file="entity_id"),
        _violation("THRESHOLD_TRIGGERED", "'INFO'", "coalesce(confidence, 0.8)", "over", total_unique="n_rows", threshold="value"),
        _violation("CRITICAL_NO_APPEAL", "'CRITICAL'", "0.9", "appeals WHERE quality = 'MISSING'"),
        _violation("WEAK_APPEAL_PROCESS", "'MEDIUM'", "0.75", "appeals WHERE quality = 'BASIC'"),
        _violation("LATE_RESPONSE", "'HIGH'", "0.95", "late WHERE late > 0", late_count="late", total_count="total", late_percentage="late_percentage"),
        _violation("EXTREME_LATE_RESPONSE", "'CRITICAL'", "0.98", "late WHERE extreme > 0"),
    ]
    return f"""
people AS ({sql_customers('c_mktsegment AS entity_id, ')}),
cells AS (SELECT entity_id, concat_ws(chr(1), {cells}) AS text FROM people),
scanned AS ({sql_scan('cells', 'text', 'entity_id', DEFAULT_PACK)}),
detected AS ({sql_detections('scanned', 'entity_id', DEFAULT_PACK)}),
entities AS (SELECT DISTINCT c_mktsegment AS entity_id FROM customer),
policies AS (SELECT entity_id, entity_id AS doc_id, text FROM ({sql_policies('c_mktsegment', 'customer')})),
statutes AS (SELECT 'CT' AS source, doc_id, text FROM documents),
law AS (SELECT * FROM ({sql_rules(DEFAULT_PACK, 'statutes')})),
{sql_coverage(_PACK, 'policies', 'entity_id').replace('docs AS', 'policy_docs AS').replace('FROM docs', 'FROM policy_docs')},
missing AS (SELECT c.* FROM coverage c, law WHERE NOT covered AND (list_contains(string_split(law.rights, ','), "right") OR "right" IN ({standard}))),
disclosed AS (SELECT entity_id, {disclosed} FROM policies GROUP BY entity_id),
undisclosed AS (SELECT f.entity_id, f.type AS category FROM detected f LEFT JOIN disclosed d USING (entity_id) WHERE CASE f.type {undisclosed} ELSE false END),
over AS (SELECT s.entity_id, n_rows, law.threshold AS value, law.threshold_confidence AS confidence FROM scanned s, law WHERE law.threshold <> 0 AND n_rows >= law.threshold),
clauses AS (SELECT entity_id, {terms} FROM policies GROUP BY entity_id),
appeals AS (SELECT entity_id, list_concat({listed[0]}, {listed[1]}) AS matched,
    CASE WHEN len({listed[1]}) > 0 THEN 'DETAILED' WHEN len({listed[0]}) > 0 THEN 'BASIC' ELSE 'MISSING' END AS quality FROM clauses),
late AS (SELECT entity_id, count(days) AS total, count(*) FILTER (WHERE days > 45) AS late, count(*) FILTER (WHERE days > 90) AS extreme,
    {sql_round('count(*) FILTER (WHERE days > 45)::DOUBLE / count(days) * 100', 1)} AS late_percentage FROM ({sql_requests('c_custkey', 'customer', 'c_mktsegment AS entity_id, ')}) GROUP BY entity_id),
v AS ({' UNION ALL '.join(branches)}), {SQL_PLACED}"""


_COUNTED = f"{SQL_COUNTS}, counted AS (SELECT e.entity_id, coalesce(total_violations, 0) AS total_violations, coalesce(critical, 0) AS critical, coalesce(high, 0) AS high, " \
           "coalesce(medium, 0) AS medium, coalesce(info, 0) AS info FROM entities e LEFT JOIN c ON c.entity_id = e.entity_id)"
_STATUS = "CASE WHEN critical > 0 OR high > 0 THEN 'Non-Compliant' WHEN total_violations > 0 THEN 'Needs Review' ELSE 'Compliant' END"
_RISK = "CASE WHEN critical > 0 THEN 'CRITICAL' WHEN high > 0 THEN 'HIGH' WHEN total_violations > 0 THEN 'MEDIUM' ELSE 'LOW' END"


@query("§3.1: rules, detection, coverage, deadlines, violations, scores in one audit", f"""WITH {_sql_audit()}, {_COUNTED}, sc AS (SELECT * FROM (WITH {sql_scores('entity_id')})),
levels AS (SELECT entity_id, {_STATUS} AS status, {_RISK} AS risk_level FROM counted) SELECT sc.*, status, risk_level FROM sc JOIN levels USING (entity_id)""")
def full_audit(spark, folder):
    audit = run_audit(*audit_inputs(spark, folder))
    return audit.scores.join(audit.severity.select("entity_id", "status", "risk_level"), "entity_id")


@query("U2 §3.1: the violations of all five branches in list order", f"WITH {_sql_audit()} SELECT entity_id, position, type, \"right\", data_category, source_file, severity, confidence, "
       "similarity_score, late_count, total_count, late_percentage, total_unique, threshold FROM placed")
def audit_violations(spark, folder):
    return run_audit(*audit_inputs(spark, folder)).violations.drop("description")


_APPEALS = "(" + ", ".join(quoted(t) for t in APPEAL_VIOLATIONS) + ")"


def _step(condition: str, prefix: str) -> str:
    """Counts of the violations of one step."""
    return (f"{prefix} AS (SELECT e.entity_id, count(type) AS total_violations, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical, count(*) FILTER (WHERE severity = 'HIGH') AS high, "
            f"count(*) FILTER (WHERE severity = 'MEDIUM') AS medium, count(*) FILTER (WHERE severity = 'INFO') AS info FROM entities e LEFT JOIN (SELECT * FROM v WHERE type {condition} {_APPEALS}) v "
            "ON v.entity_id = e.entity_id GROUP BY e.entity_id)")


SQL_USAGE_BLOCK = """used AS (SELECT c_mktsegment AS entity_id, event_type AS agent, sum(event_id % 97) AS i, sum(event_id % 31) AS o, sum(event_id % 1009) AS d
    FROM events JOIN customer ON user_id = c_custkey GROUP BY ALL),
cost AS (SELECT entity_id, sum(i + o)::BIGINT AS tokens, sum(d)::BIGINT AS duration, count(*) AS agents, arg_min(agent, agent) AS first_agent, arg_min(i, agent)::BIGINT AS first_input FROM used GROUP BY entity_id)"""

_SQL_BLOCKS = f"""{_sql_audit()}, {_step('NOT IN', 'by_check')}, {_step('IN', 'by_appeals')}, {SQL_USAGE_BLOCK}, sc AS (SELECT * FROM (WITH {sql_scores('entity_id')})),
kinds AS (SELECT entity_id, string_agg(type, ',' ORDER BY type) AS kinds FROM (SELECT DISTINCT entity_id, type FROM detected) GROUP BY entity_id),
blocks AS (SELECT e.entity_id, sc.overall_status, sc.risk_score, sc.risk_grade, sc.total_violations, law.threshold, law.rights AS statute_rights, 1::BIGINT AS files_analyzed,
    s.n_rows AS total_unique_consumers, coalesce(kinds, '') AS pii_types, {_STATUS.replace('critical', 'b.critical').replace('high', 'b.high').replace('total_violations', 'b.total_violations')} AS compliance_status,
    b.medium AS compliance_medium, {_RISK.replace('critical', 'a.critical').replace('high', 'a.high').replace('total_violations', 'a.total_violations')} AS appeals_risk,
    p.quality AS appeal_quality, late.late AS late_responses, coalesce(cost.tokens, 0) AS total_tokens, coalesce(cost.duration, 0) AS total_duration_ms, coalesce(cost.agents, 0) AS n_agents, cost.first_agent, cost.first_input
FROM entities e JOIN sc USING (entity_id) JOIN scanned s USING (entity_id) JOIN by_check b USING (entity_id) JOIN by_appeals a USING (entity_id) JOIN appeals p USING (entity_id)
JOIN late USING (entity_id) LEFT JOIN cost USING (entity_id) LEFT JOIN kinds USING (entity_id), law)"""


def _flat(rows):
    """The fields of report blocks that the SQL computes too."""
    return rows.select(
        "entity_id", "executive_summary.overall_status", "executive_summary.risk_score", "executive_summary.risk_grade", "executive_summary.total_violations",
        F.col("regulatory_analysis.applicable_rules.threshold.value").alias("threshold"), F.coalesce(F.array_join("regulatory_analysis.applicable_rules.rights", ","), F.lit("")).alias("statute_rights"),
        "pii_findings.files_analyzed", "pii_findings.total_unique_consumers", F.array_join("pii_findings.pii_types_detected", ",").alias("pii_types"),
        F.col("compliance_findings.status").alias("compliance_status"), F.col("compliance_findings.summary.medium").alias("compliance_medium"),
        F.col("appeals_findings.risk").alias("appeals_risk"), F.col("appeals_findings.appeal_procedure.quality").alias("appeal_quality"),
        F.col("appeals_findings.timeline_analysis.late_responses").alias("late_responses"), F.col("_cost_summary.total_tokens").alias("total_tokens"),
        F.col("_cost_summary.total_duration_ms").alias("total_duration_ms"), F.size("_cost_summary.per_agent").cast("bigint").alias("n_agents"),
        F.get("_cost_summary.per_agent", F.lit(0))["agent"].alias("first_agent"), F.get("_cost_summary.per_agent", F.lit(0))["input_tokens"].alias("first_input"))


@query("K1 F14 A17 §3.1: the blocks of every report", f"WITH {_SQL_BLOCKS} SELECT * FROM blocks")
def audit_report_rows(spark, folder):
    return _flat(report_rows(run_audit(*audit_inputs(spark, folder)), STAMP, usage(spark, folder)))


_SQL_ITEMS = f"""{_sql_audit()}, {sql_advice('placed', 'position, ')},
items AS (SELECT entity_id, 'detail' AS kind, 1::BIGINT AS position, NULL AS type, NULL AS subject, NULL AS level FROM entities
    UNION ALL SELECT entity_id, 'violation', position, type, coalesce("right", data_category), severity FROM placed
    UNION ALL SELECT entity_id, CASE WHEN type IN {_APPEALS} THEN 'appeals' ELSE 'compliance' END, row_number() OVER (PARTITION BY entity_id, type IN {_APPEALS} ORDER BY position),
        type, coalesce("right", data_category), severity FROM placed
    UNION ALL SELECT entity_id, 'recommendation', row_number() OVER (PARTITION BY entity_id ORDER BY position), for_violation, coalesce("right", data_category), priority
        FROM advice WHERE recommendation IS NOT NULL)"""


@query("K1 P11 §3.1: what the reports list, one row each", f"WITH {_SQL_ITEMS} SELECT * FROM items")
def audit_report_items(spark, folder):
    items = report_items(run_audit(*audit_inputs(spark, folder)))
    item = F.from_json("row", "type string, for_violation string, `right` string, data_category string, severity string, priority string")
    return items.select("entity_id", "kind", "position", F.inline(F.array(item))).select(
        "entity_id", "kind", "position", F.coalesce("type", "for_violation").alias("type"), F.coalesce("right", "data_category").alias("subject"), F.coalesce("severity", "priority").alias("level"))


def _stored(spark, folder):
    """Two runs of the audit written as documents and read back; the older one has no cost records."""
    audit = run_audit(*audit_inputs(spark, folder))
    path = f"{scratch_folder(spark)}/audit-reports-{uuid.uuid4().hex}"
    store.write_documents(report_documents(audit, "2024-05-01 00:00:00"), path, "20240501_000000")
    store.write_documents(report_documents(audit, STAMP, usage(spark, folder)), path, "20240601_000000")
    return store.read_documents_store(spark, path)


@query("K1 S7 W4 §3.1: whole reports as documents, written, read back, the newest of each business", f"""WITH {_SQL_BLOCKS}, {sql_advice('placed', 'position, ')},
lists AS (SELECT e.entity_id, count(type) AS listed, string_agg(type, ',' ORDER BY position) AS types, count(*) FILTER (WHERE type IN {_APPEALS}) AS by_appeals FROM entities e LEFT JOIN placed USING (entity_id) GROUP BY 1),
advised AS (SELECT entity_id, count(*) AS advised, arg_min(recommendation, position) AS first_advice FROM advice WHERE recommendation IS NOT NULL GROUP BY 1)
SELECT blocks.*, listed, coalesce(types, '') AS types, by_appeals, coalesce(advised, 0) AS advised, first_advice, '20240601_000000' AS run, 1::BIGINT AS details FROM blocks JOIN lists USING (entity_id) LEFT JOIN advised USING (entity_id)""")
def audit_report_documents(spark, folder):
    saved = store.newest_of_each(_stored(spark, folder))
    lists = saved.select("entity_id", F.size("violations").cast("bigint").alias("listed"), F.array_join(F.transform("violations", lambda v: v["type"]), ",").alias("types"),
                         F.size("appeals_findings.violations").cast("bigint").alias("by_appeals"), F.size("recommendations").cast("bigint").alias("advised"),
                         F.get("recommendations", F.lit(0))["recommendation"].alias("first_advice"), "run", F.size("pii_findings.details").cast("bigint").alias("details"))
    return _flat(saved).join(lists, "entity_id")


@query("S7 W4: stored reports by file name, newest first, cost defaults", f"""WITH {SQL_USAGE_BLOCK}
SELECT '20240601_000000' AS run, e.entity_id, coalesce(tokens, 0) AS total_tokens, coalesce(agents, 0) AS n_agents, 'unknown' AS model
FROM (SELECT DISTINCT c_mktsegment AS entity_id FROM customer) e LEFT JOIN cost USING (entity_id)
UNION ALL SELECT DISTINCT '20240501_000000', c_mktsegment, 0, 0, 'unknown' FROM customer""")
def stored_report_costs(spark, folder):
    saved = store.newest_first(_stored(spark, folder))
    return saved.select("run", "entity_id", "_cost_summary.total_tokens", F.size("_cost_summary.per_agent").cast("bigint").alias("n_agents"), "_cost_summary.model")


def expected_results(spark, folder) -> dict:
    """What each audit should find: the clauses its generated policy lacks, and four types of personal data."""
    made = S.policies(table(spark, folder, "customer", ["c_mktsegment"]).distinct(), "c_mktsegment")
    rights = F.array(*[F.lit(r) for r, _ in S.CLAUSES])
    return {
        "violations": made.select("entity_id", F.lit("MISSING_RIGHT").alias("type"), F.explode(F.array_except(rights, "covered_rights")).alias("right")),
        "non_violations": made.select("entity_id", F.lit("MISSING_RIGHT").alias("type"), F.explode("covered_rights").alias("right")),
        "pii_types": made.select("entity_id", F.explode(F.array(*[F.lit(t) for t in EXPECTED_TYPES])).alias("type")),
        "coverage": made.select("entity_id", F.explode(rights).alias("right"), "covered_rights").withColumn("covered", F.expr("array_contains(covered_rights, right)")),
    }


EXPECTED_TYPES = ("email", "ssn", "phone", "date_of_birth", "neural_data")


def _sql_evaluation() -> str:
    rights = " UNION ALL ".join(f"SELECT entity_id, {quoted(r)} AS \"right\", list_contains(string_split(covered_rights, ','), {quoted(r)}) AS covered FROM truth" for r, _ in S.CLAUSES)
    types = "[" + ", ".join(quoted(t) for t in EXPECTED_TYPES) + "]"
    ratio = lambda a, b: f"CASE WHEN {b} > 0 THEN {a}::DOUBLE / ({b}) ELSE 0 END"
    return f"""{_sql_audit()}, truth AS ({sql_policies('c_mktsegment', 'customer')}), clauses_truth AS ({rights}),
hits AS (SELECT DISTINCT entity_id, type, coalesce(nullif("right", ''), data_category, '') AS subject FROM v),
wanted AS (SELECT entity_id, 'MISSING_RIGHT' AS type, "right" AS subject FROM clauses_truth WHERE NOT covered),
m AS (SELECT coalesce(h.entity_id, w.entity_id) AS entity_id, h.type IS NOT NULL AS d, w.type IS NOT NULL AS e FROM hits h FULL JOIN wanted w ON h.entity_id = w.entity_id AND h.type = w.type AND h.subject = w.subject),
tn AS (SELECT c.entity_id, count(*) AS tn FROM clauses_truth c WHERE covered AND NOT EXISTS (SELECT 1 FROM hits h WHERE h.entity_id = c.entity_id AND h.type = 'MISSING_RIGHT' AND h.subject = c."right") GROUP BY 1),
acc AS (SELECT m.entity_id, (count(*) FILTER (WHERE d AND e) + coalesce(min(tn), 0))::DOUBLE / (count(*) + coalesce(min(tn), 0)) AS accuracy FROM m LEFT JOIN tn ON tn.entity_id = m.entity_id GROUP BY 1),
p AS (SELECT entity_id, count(*) FILTER (WHERE list_contains({types}, type)) AS tp, count(*) AS found FROM (SELECT DISTINCT entity_id, type FROM detected) GROUP BY 1),
f AS (SELECT entity_id, {ratio('tp', 'found')} AS pr, {ratio('tp', str(len(EXPECTED_TYPES)))} AS re FROM p),
cov AS (SELECT c.entity_id, count(*) FILTER (WHERE covered <> (h.subject IS NOT NULL)) / 6.0 AS score FROM clauses_truth c LEFT JOIN hits h ON h.entity_id = c.entity_id AND h.type = 'MISSING_RIGHT' AND h.subject = c."right" GROUP BY 1),
metrics AS (SELECT e.entity_id, {sql_round('accuracy', 4)} AS accuracy, {sql_round(ratio('2 * pr * re', 'pr + re'), 4)} AS f1, {sql_round('score', 4)} AS score,
    law.rights <> '' AS has_rules, (SELECT count(*) FROM v WHERE v.entity_id = e.entity_id) > 0 AS has_violations FROM entities e JOIN acc USING (entity_id) JOIN f USING (entity_id) JOIN cov USING (entity_id), law)"""


@query("§3.3: the audit scored against expected results, one row per business and stage", f"""WITH {_sql_evaluation()}
SELECT entity_id, 'Regulatory Analyst' AS stage, CASE WHEN has_rules THEN 'PASS' ELSE 'PARTIAL' END AS status, NULL::DOUBLE AS score FROM metrics
UNION ALL SELECT entity_id, 'Data Forensics', CASE WHEN f1 >= 0.7 THEN 'PASS' ELSE 'NEEDS_IMPROVEMENT' END, f1 FROM metrics
UNION ALL SELECT entity_id, 'Compliance Auditor', CASE WHEN accuracy >= 0.7 AND score >= 0.7 THEN 'PASS' ELSE 'NEEDS_IMPROVEMENT' END, least(accuracy, score) FROM metrics
UNION ALL SELECT entity_id, 'Appeals Processor', 'PASS', NULL FROM metrics
UNION ALL SELECT entity_id, 'Report Generator', CASE WHEN has_violations THEN 'PASS' ELSE 'PARTIAL' END, NULL FROM metrics""")
def audit_evaluation(spark, folder):
    return evaluate_audit(run_audit(*audit_inputs(spark, folder)), expected_results(spark, folder))["stages"]
