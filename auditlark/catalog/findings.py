"""Violations, scores, advice, overrides and usage.

The personal data found in documents stands in for violations: the document
source is the entity, and pattern type and language decide type and subject.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlark.catalog.registry import query, quoted, sql_round, table
from auditlark.operators import forensics as FO
from auditlark.operators import report as RP
from auditlark.operators import violations as V
from auditlark.operators.ranking import ordered_position
from auditlark.rulepack import (
    DEFAULT_PACK, GRADE_BELOW_LADDER, GRADE_LADDER, GRADE_NO_FINDINGS, LAW_CITATIONS, RECOMMENDATIONS, SEVERITY_WEIGHTS, VIOLATION_ORDER,
)
from auditlark.session import materialize
from auditlark.sources.reports import summary_line

KINDS = {
    "email": ("MISSING_RIGHT", "HIGH"),
    "phone": ("LATE_RESPONSE", "MEDIUM"),
    "credit_card": ("UNDISCLOSED_SENSITIVE_DATA", "CRITICAL"),
    "ip_address": ("THRESHOLD_TRIGGERED", "INFO"),
    "ssn": ("UNKNOWN_KIND", "SEVERE"),
    "date_of_birth": ("UNKNOWN_KIND", "SEVERE"),
}
RIGHTS = {"en": "access", "fr": "delete", "de": "appeal"}
OTHER_RIGHT = "object"


def document_violations(spark, folder):
    docs = table(spark, folder, "documents", ["doc_id", "source", "lang", "text"], heavy=True)
    flagged = FO.row_flags(docs, F.col("text"))
    rows = flagged.select("doc_id", "source", "lang", F.explode("pii_types").alias("kind"))
    lookup = lambda part: F.element_at(F.create_map(*[x for k, v in KINDS.items() for x in (F.lit(k), F.lit(v[part]))]), F.col("kind"))
    right = F.coalesce(F.try_element_at(F.create_map(*[x for k, v in RIGHTS.items() for x in (F.lit(k), F.lit(v))]), F.col("lang")), F.lit(OTHER_RIGHT))
    return rows.select(
        F.col("source").alias("entity_id"), lookup(0).alias("type"), lookup(1).alias("severity"),
        F.when(F.col("kind") == "email", right).alias("right"),
        F.when(F.col("kind") == "credit_card", F.col("lang")).alias("data_category"),
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("source_file"),
    )


def _case(column: str, pairs) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in pairs) + " END"


SQL_VIOLATIONS = (
    "hits AS (" + " UNION ALL ".join(
        f"SELECT doc_id, source, lang, {quoted(k)} AS kind FROM documents WHERE regexp_matches(text, {quoted(p)})"
        for k, p in DEFAULT_PACK.patterns) + "), "
    "v AS (SELECT source AS entity_id, " + _case("kind", [(k, t) for k, (t, _) in KINDS.items()]) + " AS type, "
    + _case("kind", [(k, s) for k, (_, s) in KINDS.items()]) + " AS severity, "
    f"CASE WHEN kind = 'email' THEN coalesce({_case('lang', RIGHTS.items())}, {quoted(OTHER_RIGHT)}) END AS \"right\", "
    "CASE WHEN kind = 'credit_card' THEN lang END AS data_category, 'doc' || doc_id AS source_file FROM hits)"
)
SQL_COUNTS = """
c AS (SELECT entity_id, count(*) AS total_violations, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical,
             count(*) FILTER (WHERE severity = 'HIGH') AS high, count(*) FILTER (WHERE severity = 'MEDIUM') AS medium,
             count(*) FILTER (WHERE severity = 'INFO') AS info FROM v GROUP BY entity_id)"""


@query("U2", f"WITH {SQL_VIOLATIONS} SELECT type, severity, count(*) AS n, count(\"right\") AS n_right, count(data_category) AS n_category, "
       "0::BIGINT AS n_threshold FROM v GROUP BY ALL")
def violation_union(spark, folder):
    found = materialize(document_violations(spark, folder))
    parts = [found.where(F.col("type") == t).drop(*drop) for t, drop in (
        ("MISSING_RIGHT", ("data_category",)), ("UNDISCLOSED_SENSITIVE_DATA", ("right",)),
        ("THRESHOLD_TRIGGERED", ("right", "data_category")), ("LATE_RESPONSE", ("right", "data_category", "source_file")),
        ("UNKNOWN_KIND", ()))]
    return V.union_violations(*parts).groupBy("type", "severity").agg(
        F.count(F.lit(1)).alias("n"), F.count("right").alias("n_right"), F.count("data_category").alias("n_category"),
        F.count("threshold").alias("n_threshold"))


@query("A9 F14 P7", f"""WITH {SQL_VIOLATIONS}, {SQL_COUNTS}
SELECT e.source AS entity_id, coalesce(total_violations, 0) AS total_violations, coalesce(critical, 0) AS critical, coalesce(high, 0) AS high,
       coalesce(medium, 0) AS medium, coalesce(info, 0) AS info,
       CASE WHEN critical > 0 OR high > 0 THEN 'Non-Compliant' WHEN total_violations > 0 THEN 'Needs Review' ELSE 'Compliant' END AS status,
       CASE WHEN critical > 0 THEN 'CRITICAL' WHEN high > 0 THEN 'HIGH' WHEN total_violations > 0 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM (SELECT DISTINCT source FROM documents) e LEFT JOIN c ON e.source = c.entity_id""")
def severity_summary(spark, folder):
    entities = table(spark, folder, "documents", ["source"]).select(F.col("source").alias("entity_id"))
    return V.severity_summary(document_violations(spark, folder), entities)


def sql_scores(key: str) -> str:
    weight = "CASE severity " + " ".join(f"WHEN '{s}' THEN {w}" for s, w in SEVERITY_WEIGHTS) + " ELSE 4 END"
    ladder = lambda i: "CASE WHEN n = 0 THEN '" + GRADE_NO_FINDINGS[i] + "' " + " ".join(
        f"WHEN score >= {step[0]} THEN '{step[i + 1]}'" for step in GRADE_LADDER) + f" ELSE '{GRADE_BELOW_LADDER[i]}' END"
    return f"""
w AS (SELECT {key} AS entity_id, count(*) AS n, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical, count(*) FILTER (WHERE severity = 'HIGH') AS high,
             least(sum({weight}), 100) AS score FROM v GROUP BY {key}),
s AS (SELECT e.entity_id, coalesce(n, 0) AS n, coalesce(critical, 0) AS critical, coalesce(high, 0) AS high, coalesce(score, 0) AS score
      FROM entities e LEFT JOIN w ON e.entity_id = w.entity_id)
SELECT entity_id, n AS total_violations, critical AS critical_violations, high AS high_violations, score::BIGINT AS risk_score,
       {ladder(0)} AS risk_grade, {ladder(1)} AS risk_label, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS overall_status FROM s"""


@query("A10 J5 F15 F16", f"WITH {SQL_VIOLATIONS}, entities AS (SELECT DISTINCT source AS entity_id FROM documents), {sql_scores('entity_id')}")
def risk_scores(spark, folder):
    entities = table(spark, folder, "documents", ["source"]).select(F.col("source").alias("entity_id"))
    return RP.risk_scores(document_violations(spark, folder), entities)


@query("A10 F15 (per document: every rung)", f"WITH {SQL_VIOLATIONS}, entities AS (SELECT 'doc' || doc_id AS entity_id FROM documents), {sql_scores('source_file')}")
def document_risk_scores(spark, folder):
    entities = table(spark, folder, "documents", ["doc_id"]).select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("entity_id"))
    found = document_violations(spark, folder).drop("entity_id").withColumnRenamed("source_file", "entity_id")
    return RP.risk_scores(found, entities)


def sql_advice(relation: str = "v", more: str = "") -> str:
    rights = [(r, t) for k, r, t in RECOMMENDATIONS if k == "MISSING_RIGHT"]
    others = [(k, t) for k, r, t in RECOMMENDATIONS if not r]
    return f"""
advice AS (SELECT {more}entity_id, type AS for_violation, CASE WHEN type = 'MISSING_RIGHT' THEN "right" END AS "right",
       CASE WHEN type = 'UNDISCLOSED_SENSITIVE_DATA' THEN data_category END AS data_category,
       CASE WHEN type = 'MISSING_RIGHT' THEN CASE WHEN "right" IN ('access', 'delete', 'opt-out') THEN 'HIGH' ELSE 'MEDIUM' END
            WHEN type = 'UNDISCLOSED_SENSITIVE_DATA' THEN 'CRITICAL' ELSE severity END AS priority,
       CASE WHEN type = 'MISSING_RIGHT' THEN coalesce({_case('"right"', rights)}, 'Add the ''' || "right" || ''' right to your privacy policy.')
            WHEN type = 'UNDISCLOSED_SENSITIVE_DATA' THEN replace({_case('type', others)}, '{{data_category}}', data_category)
            ELSE {_case('type', others)} END AS recommendation FROM {relation})"""


@query("J4", f"WITH {SQL_VIOLATIONS}, {sql_advice()} SELECT * FROM advice WHERE recommendation IS NOT NULL")
def recommendations(spark, folder):
    return RP.recommendations(document_violations(spark, folder))


@query("J6", f"""WITH {SQL_VIOLATIONS}, laws(k, section, quote) AS (VALUES {', '.join(f'({quoted(k)}, {quoted(s)}, {quoted(q)})' for k, s, q in LAW_CITATIONS)})
SELECT entity_id, type, "right", source_file, section, quote FROM v LEFT JOIN laws ON k = coalesce(nullif("right", ''), type)""")
def law_citations(spark, folder):
    return RP.with_citations(document_violations(spark, folder)).select("entity_id", "type", "right", "source_file", "section", "quote")


def _sql_rank(column: str, names) -> str:
    return f"coalesce(list_position([{', '.join(quoted(n) for n in names)}], {column}), {len(names) + 1})"


SQL_PLACED = f"""placed AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY {_sql_rank('type', VIOLATION_ORDER)}, type,
    {_sql_rank('"right"', [r for r, _, _ in DEFAULT_PACK.described_rights])}, "right" NULLS FIRST, coalesce(data_category, ''), coalesce(source_file, '')) AS position FROM v)"""


@query("J7 (list order)", f"""WITH {SQL_VIOLATIONS}, {SQL_PLACED} SELECT entity_id, position, type, "right", data_category, source_file FROM placed""")
def violation_positions(spark, folder):
    return V.in_order(document_violations(spark, folder)).select("entity_id", "position", "type", "right", "data_category", "source_file")


@query("J7", f"""WITH {SQL_VIOLATIONS}, {SQL_PLACED}, {sql_advice('placed', 'position, ')},
ranked AS (SELECT v.entity_id, v.type, v."right", v.source_file, v.severity, a.priority, a.recommendation,
           row_number() OVER (PARTITION BY v.entity_id, v.type, v.source_file ORDER BY a.position NULLS LAST) AS rn
           FROM v LEFT JOIN (SELECT * FROM advice WHERE recommendation IS NOT NULL) a ON a.entity_id = v.entity_id AND a.for_violation = v.type
            AND (v."right" IS NULL OR a."right" = v."right"))
SELECT entity_id, type, "right", source_file, coalesce(priority, severity) AS action_priority, recommendation AS action FROM ranked WHERE rn = 1""")
def first_matching_recommendation(spark, folder):
    found = materialize(V.in_order(document_violations(spark, folder)))
    return RP.with_first_recommendation(found, RP.recommendations(found)).select(
        "entity_id", "type", "right", "source_file", "action_priority", "action")


SQL_ID = "md5(concat_ws('|', length(entity_id) || ':' || entity_id, length(type) || ':' || type, length(coalesce(\"right\", '')) || ':' || coalesce(\"right\", ''), length(coalesce(data_category, '')) || ':' || coalesce(data_category, ''), length(coalesce(source_file, '')) || ':' || coalesce(source_file, '')))"


def _overrides(spark, folder):
    """Reviewers overrode the findings of documents labelled toxic."""
    toxic = table(spark, folder, "labels", ["doc_id", "toxic"]).where(F.col("toxic") == 1).select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("source_file"))
    found = materialize(document_violations(spark, folder).withColumn("violation_id", RP.violation_id()))
    return found, found.join(toxic, "source_file", "left_semi").select("violation_id")


SQL_TOXIC = "toxic AS (SELECT DISTINCT 'doc' || doc_id AS source_file FROM labels WHERE toxic = 1)"


@query("J8", f"WITH {SQL_VIOLATIONS}, {SQL_TOXIC} SELECT {SQL_ID} AS violation_id, entity_id, type, severity FROM v WHERE source_file NOT IN (SELECT source_file FROM toxic)")
def active_violations(spark, folder):
    found, overrides = _overrides(spark, folder)
    return RP.apply_overrides(found, overrides).select("violation_id", "entity_id", "type", "severity")


@query("J8", f"""WITH {SQL_VIOLATIONS}, {SQL_TOXIC} SELECT entity_id, count(*) AS total, count(*) FILTER (WHERE t.source_file IS NOT NULL) AS overridden,
count(*) FILTER (WHERE t.source_file IS NULL) AS active FROM v LEFT JOIN toxic t ON v.source_file = t.source_file GROUP BY entity_id""")
def override_summary(spark, folder):
    return RP.override_summary(*_overrides(spark, folder))


@query("F27", f"""WITH {SQL_VIOLATIONS} SELECT type || coalesce(' - ' || "right", '') || coalesce(' (' || data_category || ')', '') AS title, count(*) AS n FROM v GROUP BY 1""")
def display_titles(spark, folder):
    return document_violations(spark, folder).groupBy(RP.display_title().alias("title")).agg(F.count(F.lit(1)).alias("n"))


@query("F26", f"""WITH {SQL_VIOLATIONS}, {SQL_PLACED}, {sql_advice('placed', 'position, ')}, entities AS (SELECT DISTINCT source AS entity_id FROM documents), sc AS (SELECT * FROM (WITH {sql_scores('entity_id')})),
lines AS (SELECT entity_id, 0 AS section, 0 AS k, 'Compliance Status: ' || overall_status || chr(10) || 'Risk Grade: ' || risk_grade || chr(10) || 'Summary: ' || total_violations || ' findings' AS line FROM sc WHERE total_violations <> 1
  UNION ALL SELECT entity_id, 1, position, 'Violation: ' || type || ' - ' || coalesce("right", '') || ' (' || severity || ')' FROM placed
  UNION ALL SELECT entity_id, 2, position, 'Recommendation: ' || recommendation FROM advice WHERE recommendation IS NOT NULL),
told AS (SELECT entity_id, string_agg(line, chr(10) ORDER BY section, k, line) AS answer FROM lines WHERE entity_id IN (SELECT entity_id FROM sc WHERE total_violations <> 1) GROUP BY entity_id)
SELECT e.entity_id, coalesce(answer, 'No structured data found in report.') AS answer FROM entities e LEFT JOIN told ON told.entity_id = e.entity_id""")
def evidence_text(spark, folder):
    """Sources with one finding stand in for entities without a report."""
    entities = table(spark, folder, "documents", ["source"]).select(F.col("source").alias("entity_id"))
    found = materialize(V.in_order(document_violations(spark, folder)))
    scores = materialize(RP.risk_scores(found, entities).where("total_violations <> 1").withColumn("summary", F.concat(F.col("total_violations").cast("string"), F.lit(" findings"))))
    kept = found.join(scores.select("entity_id"), "entity_id", "left_semi")
    return RP.evidence_text(kept, scores, RP.recommendations(kept), entities)


@query("F26 (three labels, cut, fallback)", """
WITH e AS (SELECT source, count(*) AS n, min(lang) AS lang FROM documents GROUP BY source),
listed AS (SELECT source, string_agg('{"doc":' || doc_id || ',"lang":"' || lang || '"}', ',' ORDER BY doc_id) AS rows FROM documents GROUP BY source),
c AS (SELECT source, CASE WHEN n % 3 <> 0 THEN 'Regulatory Analysis: ' || left('{"lang":"' || lang || '","n_docs":' || n || '}', 2000) END AS a,
    CASE WHEN n % 3 <> 0 THEN 'PII Findings: ' || left('{"files":' || n || ',"details":[' || rows || ']}', 2000) END AS b,
    CASE WHEN n % 3 = 1 THEN 'Appeals Findings: ' || left('{"risk":"LOW"}', 2000) END AS d FROM e JOIN listed USING (source)),
l AS (SELECT source, list_filter([a, b, d], lambda x: x IS NOT NULL) AS l FROM c)
SELECT source AS entity_id, 1 AS position, 'No context available' AS context FROM l WHERE len(l) = 0
UNION ALL SELECT source, i::INTEGER, l[i] FROM l, unnest(range(1, len(l) + 1)) AS u(i)""")
def report_contexts(spark, folder):
    docs = table(spark, folder, "documents", ["doc_id", "source", "lang"])
    blocks = docs.groupBy(F.col("source").alias("entity_id")).agg(F.count(F.lit(1)).alias("n"), F.min("lang").alias("lang"))
    some = F.col("n") % 3 != 0
    blocks = blocks.select("entity_id", F.when(some, F.struct("lang", F.col("n").alias("n_docs"))).alias("regulatory_analysis"), F.when(some, F.struct(F.col("n").alias("files"))).alias("pii_findings"),
                           F.when(F.col("n") % 3 == 1, F.struct(F.lit("LOW").alias("risk"))).alias("appeals_findings"))
    details = ordered_position(docs.withColumnRenamed("source", "entity_id"), ["entity_id"], ["doc_id"]).select(
        "entity_id", "position", F.to_json(F.struct(F.col("doc_id").alias("doc"), "lang")).alias("row"))
    return RP.contexts(blocks, details)


@query("F26 (contexts)", """SELECT event_id, 'PII Findings: ' || '{"type":"' || event_type || '","user":' || user_id || '}' AS context FROM events""")
def evidence_contexts(spark, folder):
    events = table(spark, folder, "events", ["event_id", "event_type", "user_id"])
    return events.select("event_id", RP.context_text("PII Findings", F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"))).alias("context"))


@query("K2", f"""WITH {SQL_VIOLATIONS}, entities AS (SELECT DISTINCT source AS entity_id FROM documents), sc AS (SELECT * FROM (WITH {sql_scores('entity_id')}))
SELECT '## ' || entity_id || chr(10) || '- Status: ' || overall_status || chr(10) || '- Risk grade: ' || risk_grade || ' (' || risk_label || ')' || chr(10) ||
'- Risk score: ' || risk_score || chr(10) || '- Violations: ' || total_violations AS value FROM sc""")
def summary_export_lines(spark, folder):
    entities = table(spark, folder, "documents", ["source"]).select(F.col("source").alias("entity_id"))
    return RP.risk_scores(document_violations(spark, folder), entities).select(summary_line().alias("value"))


def _json_part(column: str, comma: str = ",") -> str:
    name = column.strip('"')
    return f"coalesce('{comma}\"{name}\":\"' || {column} || '\"', '')"


@query("K1 F24", f"""WITH {SQL_VIOLATIONS} SELECT entity_id, '{{' || {_json_part('type', '')} || {_json_part('severity')} || {_json_part('"right"')} ||
{_json_part('data_category')} || {_json_part('source_file')} || '}}' AS document FROM v""")
def report_json_rows(spark, folder):
    found = document_violations(spark, folder)
    return found.select("entity_id", F.to_json(F.struct("type", "severity", "right", "data_category", "source_file")).alias("document"))


def _usage(spark, folder):
    e = table(spark, folder, "events", ["event_id", "event_type", "value", "props"])
    return e.select(
        F.when(F.col("event_id") % 17 != 0, F.col("event_type")).alias("agent"), F.get_json_object("props", "$.k").cast("bigint").alias("input_tokens"),
        F.pmod("event_id", F.lit(101)).alias("output_tokens"), F.round(F.col("value") * 100).cast("bigint").alias("total_cost_usd"),
        F.pmod("event_id", F.lit(1009)).alias("duration_ms"))


SQL_USAGE = """u AS (SELECT CASE WHEN event_id % 17 <> 0 THEN event_type END AS agent, CAST(json_extract_string(props, '$.k') AS BIGINT) AS i, event_id % 101 AS o, round(value * 100)::BIGINT AS c, event_id % 1009 AS d FROM events)"""


@query("A17", f"""WITH {SQL_USAGE} SELECT grouping(agent) = 1 AS is_total, agent, count(*) AS n_calls, sum(i)::BIGINT AS total_input_tokens, sum(o)::BIGINT AS total_output_tokens,
(sum(i) + sum(o))::BIGINT AS total_tokens, sum(c)::BIGINT AS total_cost_usd, sum(d)::BIGINT AS total_duration_ms FROM u GROUP BY ROLLUP (agent)""")
def usage_rollup(spark, folder):
    return RP.usage_rollup(_usage(spark, folder))


@query("W6", f"WITH {SQL_USAGE} SELECT agent, sum(c)::BIGINT AS total_cost_usd, rank() OVER (ORDER BY sum(c) DESC) AS cost_rank FROM u GROUP BY agent")
def cost_ranking(spark, folder):
    return RP.cost_ranking(_usage(spark, folder)).withColumn("cost_rank", F.col("cost_rank").cast("bigint"))


@query("F20", f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, {sql_round('l_extendedprice * l_discount', 1)} AS r1, {sql_round('l_extendedprice / l_quantity', 3)} AS r3,
{sql_round('l_quantity / 4', 0)} AS r0 FROM lineitem""")
def exact_rounding(spark, folder):
    from auditlark.functions.numbers import round_exact

    items = table(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_quantity"])
    return items.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
                        round_exact(F.col("l_extendedprice") * F.col("l_discount"), 1).alias("r1"),
                        round_exact(F.col("l_extendedprice") / F.col("l_quantity"), 3).alias("r3"),
                        round_exact(F.col("l_quantity") / 4, 0).alias("r0"))
