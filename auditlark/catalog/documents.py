"""Documents, markup, assembly and saved reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlark.catalog.registry import query, quoted, table
from auditlark.functions import text as X
from auditlark.operators import report as RP
from auditlark.operators import rules as R
from auditlark.sources import documents as D


@query("S2", "SELECT source, lang, count(*) AS n_docs, sum(length(text))::BIGINT AS n_chars FROM documents GROUP BY source, lang")
def document_catalog(spark, folder):
    docs = table(spark, folder, "documents", ["source", "lang", "text"])
    return docs.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.length("text")).cast("bigint").alias("n_chars"))


HOST = r"^https?://([^/]+)"


@query("S3 A19", f"""
SELECT regexp_extract(url, {quoted(HOST)}, 1) AS file, count(page_id) AS pages, coalesce(sum(length(html)), 0)::BIGINT AS chars_extracted,
       CASE WHEN count(html) = 0 THEN 'no text could be extracted' END AS error
FROM pages GROUP BY 1""")
def statute_file_metadata(spark, folder):
    pages = table(spark, folder, "pages").withColumn("file", F.regexp_extract("url", HOST, 1))
    return R.file_metadata(pages, "file", "html", "page_id")


def sql_html_text(column: str) -> str:
    text = column
    for pattern in X.MARKUP_BLOCKS:
        text = f"regexp_replace({text}, {quoted(pattern)}, ' ', 'g')"
    for entity, plain in X.ENTITIES:
        text = f"replace({text}, {quoted(entity)}, {quoted(plain)})"
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


@query("S4", f"SELECT page_id AS doc_id, length(t) AS n_chars, md5(t) AS text_md5 FROM (SELECT page_id, {sql_html_text('html')} AS t FROM pages)")
def html_text(spark, folder):
    pages = table(spark, folder, "pages", ["page_id", "html"], heavy=True)
    plain = D.html_documents(pages, "page_id", "html")
    return plain.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"))


@query("S6", f"""
SELECT conv_id AS entity_id, count(*) AS n_docs, md5(string_agg(text, {quoted(D.NEXT_DOCUMENT)} ORDER BY turn)) AS text_md5,
       length(string_agg(text, {quoted(D.NEXT_DOCUMENT)} ORDER BY turn)) AS n_chars
FROM conversations GROUP BY conv_id""")
def assembled_policies(spark, folder):
    turns = table(spark, folder, "conversations", ["conv_id", "turn", "text"])
    whole = D.assemble(turns, "conv_id", "turn", "text")
    return whole.select("entity_id", "n_docs", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("n_chars"))


@query("S7 W4", """
SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
FROM events) WHERE rn = 1""")
def latest_reports(spark, folder):
    reports = table(spark, folder, "events", ["user_id", "ts", "event_id", "event_type", "value"])
    return RP.latest_reports(reports, "user_id", "ts").select("user_id", "event_id", "event_type", "value")


def _saved_reports(spark, folder):
    """Events as saved reports, in the newer or the older layout by event id."""
    e = table(spark, folder, "events", ["event_id", "event_type", "value", "props"])
    k = F.get_json_object("props", "$.k").cast("bigint")
    status = F.when(F.col("event_type") == "error", "FAIL").otherwise("PASS")
    grade = F.get(F.array(*[F.lit(g) for g in "ABCDF"]), F.pmod(F.col("event_id"), F.lit(5)).cast("int"))
    newer = F.to_json(F.struct(
        F.struct(status.alias("overall_compliance_status"), grade.alias("risk_grade"), F.lit("High").alias("risk_level")).alias("executive_summary"),
        F.struct(k.alias("total_violations"), F.lit(1).alias("critical"), F.lit(2).alias("high")).alias("violations_summary"),
        F.struct(F.col("value").alias("total_cost_usd"), F.lit("m1").alias("model")).alias("_cost_summary"),
        F.struct(F.array(F.struct(
            F.concat(F.col("event_type"), F.lit(".csv")).alias("file"),
            F.array(F.struct(F.lit("email").alias("type"), F.lit("regex").alias("method"), k.alias("count"), F.lit(0.95).alias("confidence"))).alias("detection_details"),
            F.array(F.struct(F.lit("c_name").alias("column"), F.lit("name").alias("likely_pii_type"))).alias("column_pii_indicators"),
        ), F.struct(
            F.lit("broken.csv").alias("file"), F.lit(None).cast("array<struct<type:string,method:string,count:bigint,confidence:double>>").alias("detection_details"),
            F.lit(None).cast("array<struct<column:string,likely_pii_type:string>>").alias("column_pii_indicators"),
        )).alias("details")).alias("pii_findings"),
    ))
    older = F.to_json(F.struct(
        F.struct(status.alias("overall_status"), F.struct(grade.alias("grade"), F.lit("Low").alias("label")).alias("risk_assessment"),
                 k.alias("total_violations"), F.lit(3).alias("critical_violations"), F.lit(4).alias("high_violations")).alias("executive_summary"),
        F.struct(F.struct(F.struct(k.alias("count"), F.lit(0.5).alias("confidence")).alias("phone")).alias("pii_detected")).alias("pii_findings"),
    ))
    return e.select("event_id", F.when(F.pmod("event_id", F.lit(2)) == 0, newer).otherwise(older).alias("document"))


@query("P9 S7 F24", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END AS status, ['A','B','C','D','F'][1 + event_id % 5] AS risk_grade,
       CASE WHEN event_id % 2 = 0 THEN 'High' ELSE 'Low' END AS risk_level, CAST(json_extract_string(props, '$.k') AS BIGINT) AS total_violations,
       CASE WHEN event_id % 2 = 0 THEN 1 ELSE 3 END::BIGINT AS critical, CASE WHEN event_id % 2 = 0 THEN 2 ELSE 4 END::BIGINT AS high,
       CASE WHEN event_id % 2 = 0 THEN value ELSE 0.0 END AS total_cost_usd, CASE WHEN event_id % 2 = 0 THEN 'm1' ELSE 'unknown' END AS model
FROM events""")
def saved_report_fields(spark, folder):
    return RP.report_fields(_saved_reports(spark, folder), ["event_id"], "document")


@query("P11", """
WITH e AS (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_id, 'detection' AS kind, event_type || '.csv' AS file, CAST(NULL AS VARCHAR) AS "column", 'email' AS type, 'regex' AS method,
       k AS match_count, 0.95::DOUBLE AS confidence FROM e WHERE event_id % 2 = 0
UNION ALL SELECT event_id, 'column', event_type || '.csv', 'c_name', 'name', NULL, NULL, NULL FROM e WHERE event_id % 2 = 0
UNION ALL SELECT event_id, 'detection', NULL, NULL, NULL, NULL, NULL, NULL FROM e WHERE false
UNION ALL SELECT event_id, 'map_entry', NULL, NULL, 'phone', NULL, k, 0.5 FROM e WHERE event_id % 2 = 1""")
def flattened_findings(spark, folder):
    return RP.flatten_findings(_saved_reports(spark, folder), ["event_id"], "document").withColumnRenamed("count", "match_count")
