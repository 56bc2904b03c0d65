"""Findings and JSON read out of free text. The texts are built by Spark from
the event rows, one per event."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlark.catalog.registry import query, quoted, table
from auditlark.functions import jsontext as J
from auditlark.functions import text as X
from auditlark.operators import report as RP
from auditlark.rulepack import NARRATIVE_GRADE, NARRATIVE_SUMMARY, NARRATIVE_VIOLATION

NARRATIVE_KEYS = "event_id % 3"


def _narratives(spark, folder):
    e = table(spark, folder, "events", ["event_id", "event_type", "user_id"], heavy=True)
    third = F.pmod("event_id", F.lit(3))
    status = F.when(third == 0, "NON-COMPLIANT").when(third == 1, "Compliant").otherwise("pending")
    head = F.concat(F.lit("Status: "), status, F.lit("\n"), F.when(third < 2, F.concat(F.lit("Risk Grade: **"), F.get(F.array(*[F.lit(g) for g in "abcdf"]), F.pmod("user_id", F.lit(5)).cast("int")), F.lit("**\n"))).otherwise(""))
    summary = F.concat(F.lit("## Executive Summary\n\n User **"), F.col("user_id").cast("string"), F.lit("** did "), F.col("event_type"), F.lit(".\nMore text.\n\n"))
    first = F.concat(F.lit("VIOLATION 1: **Missing right** (HIGH)\nuser "), F.col("user_id").cast("string"), F.lit(" was *not* told.\n\n"))
    second = F.when(third == 0, F.concat(F.lit("Violation 2 critical "), F.col("event_type"), F.lit("\nlast line"))).otherwise("")
    return e.select("event_id", F.concat(head, summary, first, second).alias("raw"))


SQL_NARRATIVE = """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'NON_COMPLIANT' WHEN 1 THEN 'COMPLIANT' ELSE 'UNKNOWN' END AS status,
CASE WHEN event_id % 3 < 2 THEN ['A', 'B', 'C', 'D', 'F'][1 + user_id % 5] ELSE '?' END AS risk_grade,
'User ' || user_id || ' did ' || event_type || '.' || chr(10) || 'More text.' AS summary FROM events"""


@query("F21", SQL_NARRATIVE)
def narrative_summaries(spark, folder):
    return RP.parse_narratives(_narratives(spark, folder), ["event_id"], "raw").drop("violations")


@query("F21", """SELECT event_id, 0::BIGINT AS position, 'Missing right (HIGH)' AS type, 'HIGH' AS severity,
'Missing right (HIGH)' || chr(10) || 'user ' || user_id || ' was not told.' AS finding FROM events
UNION ALL SELECT event_id, 1, 'critical ' || event_type, 'CRITICAL', 'critical ' || event_type || chr(10) || 'last line' FROM events WHERE event_id % 3 = 0""")
def narrative_violations(spark, folder):
    parsed = RP.parse_narratives(_narratives(spark, folder), ["event_id"], "raw")
    return parsed.select("event_id", F.posexplode("violations").alias("position", "v")).select(
        "event_id", F.col("position").cast("bigint").alias("position"), "v.*")


def _reports_of_any_shape(spark, folder):
    """Documents as the texts that audits gave: a structured report, a failure, prose inside JSON, or mere prose."""
    docs = table(spark, folder, "documents", ["doc_id", "text", "lang", "source"], heavy=True)
    grade = F.get(F.array(*[F.lit(g) for g in "ABCDF"]), F.pmod("doc_id", F.lit(5)).cast("int"))
    prose = F.concat(F.lit("Result: "), F.when(F.pmod("doc_id", F.lit(3)) == 0, "non-compliant").when(F.pmod("doc_id", F.lit(3)) == 1, "Compliant").otherwise("open"), F.lit("\nRisk Grade: **"), grade,
                     F.lit("**\n\n## EXECUTIVE SUMMARY\n\n"), F.col("text"), F.lit("\n\nVIOLATION 1: **"), F.col("lang"), F.lit("** HIGH\n"), F.col("text"), F.lit("\n\nviolation 2: critical "),
                     F.col("source"), F.lit("\n*end*"))
    kind = F.pmod("doc_id", F.lit(4))
    structured = F.to_json(F.struct(
        F.struct(F.lit("PARTIAL").alias("overall_compliance_status"), grade.alias("risk_grade"), F.col("text").alias("summary")).alias("executive_summary"),
        F.array(F.struct(F.col("lang").alias("type"), F.lit("MEDIUM").alias("severity"), F.col("text").alias("description"))).alias("violations")))
    failed = F.to_json(F.struct(F.lit("FAILED").alias("status"), F.col("source").alias("error"), F.col("text").alias("message")))
    return docs.select("doc_id", F.when(kind == 0, structured).when(kind == 1, failed).when(kind == 2, F.to_json(F.struct(prose.alias("raw_response")))).otherwise(prose).alias("document"))


def _sql_shapes() -> str:
    """The same texts, read back with JSON functions and patterns."""
    blank = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
    prose = ("'Result: ' || CASE doc_id % 3 WHEN 0 THEN 'non-compliant' WHEN 1 THEN 'Compliant' ELSE 'open' END || chr(10) || 'Risk Grade: **' || grade || '**' || chr(10) || chr(10) || '## EXECUTIVE SUMMARY' || chr(10) || chr(10) || text "
             "|| chr(10) || chr(10) || 'VIOLATION 1: **' || lang || '** HIGH' || chr(10) || text || chr(10) || chr(10) || 'violation 2: critical ' || source || chr(10) || '*end*'")
    structured = ("json_object('executive_summary', json_object('overall_compliance_status', 'PARTIAL', 'risk_grade', grade, 'summary', text), "
                  "'violations', json_array(json_object('type', lang, 'severity', 'MEDIUM', 'description', text)))")
    body = blank.format("block")
    title = blank.format(f"replace(string_split({body}, chr(10))[1], '*', '')")
    return f"""
graded AS (SELECT *, ['A', 'B', 'C', 'D', 'F'][1 + doc_id % 5] AS grade FROM documents),
texts AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN {structured}::VARCHAR WHEN 1 THEN json_object('status', 'FAILED', 'error', source, 'message', text)::VARCHAR
    WHEN 2 THEN json_object('raw_response', {prose})::VARCHAR ELSE {prose} END AS document FROM graded),
parsed AS (SELECT doc_id, document, CASE WHEN json_valid(document) THEN document END AS j FROM texts),
fields AS (SELECT doc_id, j, json_extract_string(j, '$.status') = 'FAILED' OR coalesce(json_extract_string(j, '$.error'), '') <> '' AS failed,
    json_extract(j, '$.executive_summary') IS NOT NULL AND json_array_length(j, '$.violations') > 0 AS structured,
    CASE WHEN j IS NULL THEN document ELSE json_extract_string(j, '$.raw_response') END AS raw FROM parsed),
branches AS (SELECT *, CASE WHEN structured THEN 'structured' WHEN failed THEN 'failed' WHEN coalesce(raw, '') <> '' THEN 'narrative' ELSE 'plain' END AS branch FROM fields),
blocks AS (SELECT doc_id, unnest(regexp_extract_all(raw, {quoted(NARRATIVE_VIOLATION)}, 1)) AS block, generate_subscripts(regexp_extract_all(raw, {quoted(NARRATIVE_VIOLATION)}, 1), 1) AS i FROM branches WHERE branch = 'narrative'),
titled AS (SELECT doc_id, i, {title} AS type, replace({body}, '*', '') AS finding FROM blocks),
found AS (SELECT doc_id, i, type, CASE WHEN contains(upper(type), 'CRITICAL') THEN 'CRITICAL' WHEN contains(upper(type), 'HIGH') THEN 'HIGH' ELSE 'MEDIUM' END AS severity, finding FROM titled
  UNION ALL SELECT doc_id, 1, json_extract_string(j, '$.violations[0].type'), json_extract_string(j, '$.violations[0].severity'), json_extract_string(j, '$.violations[0].description') FROM branches WHERE branch = 'structured'),
counted AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical, count(*) FILTER (WHERE severity = 'HIGH') AS high, string_agg(type, '|' ORDER BY i) AS types, md5(string_agg(finding, '|' ORDER BY i)) AS findings FROM found GROUP BY doc_id)"""


@query("F21 (every branch)", f"""WITH {_sql_shapes()}
SELECT b.doc_id, branch, CASE branch WHEN 'structured' THEN json_extract_string(j, '$.executive_summary.overall_compliance_status') WHEN 'failed' THEN 'ERROR'
    ELSE CASE WHEN contains(upper(raw), 'NON-COMPLIANT') OR contains(upper(raw), 'NON_COMPLIANT') THEN 'NON_COMPLIANT' WHEN contains(upper(raw), 'COMPLIANT') THEN 'COMPLIANT' ELSE 'UNKNOWN' END END AS status,
  CASE branch WHEN 'structured' THEN json_extract_string(j, '$.executive_summary.risk_grade') WHEN 'failed' THEN '?' ELSE upper(regexp_extract(raw, {quoted(NARRATIVE_GRADE)}, 1)) END AS risk_grade,
  md5(CASE branch WHEN 'structured' THEN json_extract_string(j, '$.executive_summary.summary') WHEN 'failed' THEN 'Pipeline error: ' || json_extract_string(j, '$.error') || '. ' || json_extract_string(j, '$.message')
    ELSE replace(regexp_replace(regexp_extract(raw, {quoted(NARRATIVE_SUMMARY)}, 1), '^\\s+|\\s+$', '', 'g'), '*', '') END) AS summary_md5,
  coalesce(n, 0) AS total_violations, coalesce(critical, 0) AS critical_violations, coalesce(high, 0) AS high_violations, coalesce(types, '') AS types, md5(coalesce(findings, '')) AS findings_md5
FROM branches b LEFT JOIN counted c ON c.doc_id = b.doc_id""")
def reports_of_any_shape(spark, folder):
    shown = RP.normalize_reports(_reports_of_any_shape(spark, folder), ["doc_id"], "document")
    findings = F.md5(F.array_join(F.transform("violations", lambda v: v["finding"]), "|"))
    return shown.select("doc_id", "branch", "status", "risk_grade", F.md5("summary").alias("summary_md5"), "total_violations", "critical_violations", "high_violations",
                        F.array_join(F.transform("violations", lambda v: v["type"]), "|").alias("types"), F.md5(F.when(F.size("violations") > 0, findings).otherwise("")).alias("findings_md5"))


def _payload_texts(spark, folder):
    e = table(spark, folder, "events", ["event_id", "event_type", "props"], heavy=True)
    sixth = F.pmod("event_id", F.lit(6))
    nested = F.concat(F.lit('{"a": {"b": ['), F.col("event_id").cast("string"), F.lit(", 2]}, \"p\": "), F.col("props"), F.lit("}"))
    return e.select("event_id", F.when(sixth == 0, F.col("props"))
                    .when(sixth == 1, F.concat(F.lit("Here:\n```json\n"), F.col("props"), F.lit("\n```\nbye {not json}")))
                    .when(sixth == 2, F.concat(F.lit("Result "), nested, F.lit(" as asked {x}")))
                    .when(sixth == 3, F.concat(F.lit("list ["), F.col("event_id").cast("string"), F.lit(", 1] end")))
                    .when(sixth == 4, F.concat(F.lit("```\noops\n```\n```json\n"), nested, F.lit("\n```")))
                    .otherwise(F.concat(F.lit("nothing {here: "), F.col("event_type"))).alias("raw"))


@query("F22", """WITH e AS (SELECT event_id, event_type, props, '{"a": {"b": [' || event_id || ', 2]}, "p": ' || props || '}' AS nested FROM events)
SELECT event_id, CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN props WHEN 2 THEN nested WHEN 3 THEN '[' || event_id || ', 1]' WHEN 4 THEN nested END AS payload,
CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN props WHEN 2 THEN nested WHEN 3 THEN '[' || event_id || ', 1]' WHEN 4 THEN nested
     ELSE 'nothing {here: ' || event_type END AS payload_or_text FROM e""")
def json_payloads(spark, folder):
    texts = _payload_texts(spark, folder)
    found = texts.select("event_id", X.once(X.let(F.col("raw"), lambda t: F.struct(
        t.alias("raw"), J.json_payload(t).alias("payload")))))
    return found.select("event_id", "payload", F.coalesce("payload", F.nullif("raw", F.lit("")), F.lit("{}")).alias("payload_or_text"))


@query("F23 F24", """SELECT event_id, CASE event_id % 4 WHEN 3 THEN '{"raw":"' || event_type || '"}' ELSE props END AS document FROM events""")
def double_encoded_json(spark, folder):
    e = table(spark, folder, "events", ["event_id", "event_type", "props"], heavy=True)
    quote = lambda c: F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    once, kind = quote(F.col("props")), F.pmod("event_id", F.lit(4))
    raw = F.when(kind == 0, F.col("props")).when(kind == 1, once).when(kind == 2, quote(once)).otherwise(quote(F.col("event_type")))
    return e.select("event_id", J.unwrap_json(raw).alias("document"))


@query("F24", "SELECT event_type, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS total_k, count(DISTINCT json_extract_string(props, '$.k')) AS n_k FROM events GROUP BY event_type")
def json_decoding(spark, folder):
    e = table(spark, folder, "events", ["event_type", "props"]).select("event_type", F.from_json("props", "k bigint").alias("p"))
    return e.groupBy("event_type").agg(F.sum("p.k").alias("total_k"), F.count_distinct(F.col("p.k")).alias("n_k"))
