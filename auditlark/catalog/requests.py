"""Request logs and response deadlines. Orders and their shipments stand in for
requests and responses; the order priority is the entity."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from auditlark.catalog.registry import query, quoted, sql_round, table
from auditlark.operators import sla
from auditlark.session import scratch_folder
from auditlark.sources.requests import canonical_log, read_request_logs


def request_log(spark, folder):
    """Shipments as a log whose date columns carry accepted alias names, as
    text; returned items have an unreadable response date."""
    orders = table(spark, folder, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority"])
    items = table(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag"], heavy=True)
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderpriority").alias("entity_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("request_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date_Requested"),
        F.when(F.col("l_returnflag") == "R", "n/a").otherwise(shipped).alias(" completed "),
    )


SQL_LOG = """
log AS (SELECT o_orderpriority AS entity_id, concat_ws('-', l_orderkey, l_linenumber) AS request_id,
               CAST(o_orderdate AS DATE) AS request_date,
               CASE WHEN l_returnflag <> 'R' THEN CAST(l_shipdate AS DATE) END AS response_date,
               CASE WHEN l_returnflag <> 'R' THEN date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) END AS days
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

SQL_SUMMARY = f"""
summary AS (SELECT entity_id, count(days) AS total_requests, count(*) - count(days) AS dropped_requests, count(*) FILTER (WHERE days > 45) AS late_responses,
                   count(*) FILTER (WHERE days > 90) AS extreme_late_responses,
                   {sql_round('count(*) FILTER (WHERE days > 45)::DOUBLE / count(days) * 100', 1)} AS late_percentage,
                   {sql_round('sum(days)::DOUBLE / count(days)', 1)} AS average_response_days, max(days) AS max_response_days
            FROM log GROUP BY entity_id)"""


@query("S5 P1", f"WITH {SQL_LOG} SELECT entity_id, count(*) AS n_rows, count(request_date) AS n_requests, count(response_date) AS n_responses"
       " FROM log GROUP BY entity_id")
def request_log_columns(spark, folder):
    log = canonical_log(request_log(spark, folder))
    return log.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("request_date").alias("n_requests"),
        F.count(F.col("response_date").try_cast("date")).alias("n_responses"))


@query("P1 F19", f"WITH {SQL_LOG} SELECT request_id, entity_id, days FROM log WHERE days IS NOT NULL")
def valid_response_days(spark, folder):
    return sla.valid_pairs(request_log(spark, folder)).select("request_id", "entity_id", "days")


@query("F19 (timestamps)", """
SELECT event_id, CAST(floor(date_diff('microsecond', TIMESTAMP '2024-01-10 12:00:00', ts) / 86400000000.0) AS BIGINT) AS days FROM events""")
def timestamp_day_difference(spark, folder):
    events = table(spark, folder, "events", ["event_id", "ts"]).select(
        "event_id", F.lit("2024-01-10 12:00:00").cast("timestamp_ntz").alias("request"), F.col("ts").cast("timestamp_ntz").alias("response"))
    return sla.response_days(events).select("event_id", "days")


@query("P2", f"WITH {SQL_LOG} SELECT request_id, entity_id, days FROM log WHERE days > 45")
def late_requests(spark, folder):
    return sla.late_requests(request_log(spark, folder)).select("request_id", "entity_id", "days")


@query("P3", f"WITH {SQL_LOG} SELECT request_id, entity_id, days FROM log WHERE days > 90")
def extreme_late_requests(spark, folder):
    return sla.late_requests(request_log(spark, folder), extreme=True).select("request_id", "entity_id", "days")


@query("A7 F20 F27", f"WITH {SQL_LOG}, {SQL_SUMMARY} SELECT *, 45::BIGINT AS statutory_limit_days, {sql_round('100 - late_percentage', 1)} AS on_time_percentage,"
       " CAST(NULL AS VARCHAR) AS error FROM summary")
def sla_summary(spark, folder):
    summary = sla.on_time_percent(sla.sla_summary(request_log(spark, folder), "entity_id"))
    return summary.withColumn("statutory_limit_days", F.col("statutory_limit_days").cast("bigint"))


@query("A8", f"""WITH {SQL_LOG} SELECT entity_id, CASE WHEN days > 90 THEN 'very_late' WHEN days > 45 THEN 'late' ELSE 'on_time' END AS bucket,
count(*) AS n_requests FROM log WHERE days IS NOT NULL GROUP BY ALL""")
def sla_buckets(spark, folder):
    return sla.sla_buckets(request_log(spark, folder), ["entity_id"])


SQL_QUALITY = "CASE WHEN entity_id IN ('1-URGENT', '2-HIGH') THEN 'MISSING' WHEN entity_id = '3-MEDIUM' THEN 'BASIC' ELSE 'DETAILED' END"


@query("F18 A7", f"""
WITH {SQL_LOG}, {SQL_SUMMARY}, q AS (SELECT *, {SQL_QUALITY} AS quality FROM summary)
SELECT entity_id, 'CRITICAL_NO_APPEAL' AS type, 'CRITICAL' AS severity, {quoted(sla.NO_APPEAL_TEXT)} AS description,
       0.9::DOUBLE AS confidence, NULL::BIGINT AS late_count, NULL::BIGINT AS total_count, NULL::DOUBLE AS late_percentage FROM q WHERE quality = 'MISSING'
UNION ALL SELECT entity_id, 'WEAK_APPEAL_PROCESS', 'MEDIUM', {quoted(sla.WEAK_APPEAL_TEXT)}, 0.75, NULL, NULL, NULL FROM q WHERE quality = 'BASIC'
UNION ALL SELECT entity_id, 'LATE_RESPONSE', 'HIGH', late_responses || ' of ' || total_requests || ' consumer requests exceeded the 45-day response limit.',
       0.95, late_responses, total_requests, late_percentage FROM q WHERE late_responses > 0
UNION ALL SELECT entity_id, 'EXTREME_LATE_RESPONSE', 'CRITICAL',
       extreme_late_responses || ' requests exceeded even the extended 90-day limit (45 + 45 extension).', 0.98, NULL, NULL, NULL
FROM q WHERE extreme_late_responses > 0""")
def sla_violations(spark, folder):
    summary = sla.sla_summary(request_log(spark, folder), "entity_id")
    quality = F.when(F.col("entity_id").isin("1-URGENT", "2-HIGH"), "MISSING").when(F.col("entity_id") == "3-MEDIUM", "BASIC").otherwise("DETAILED")
    confidence = F.when(quality == "MISSING", 0.9).when(quality == "BASIC", 0.75).otherwise(0.95)
    appeals = table(spark, folder, "orders", ["o_orderpriority"]).groupBy(F.col("o_orderpriority").alias("entity_id")).agg(
        F.count(F.lit(1)).alias("n")).select("entity_id", quality.alias("quality"), confidence.alias("confidence"))
    return sla.appeal_violations(appeals, summary)


#: How dates are written, by the remainder of the line number; the last one is no date.
WRITTEN = ("yyyy-MM-dd", "MM/dd/yyyy", "dd.MM.yyyy", "yyyyMMdd", "MMM d, yyyy", "d-MMM-yyyy", "'week' w")
SQL_WRITTEN = ("%Y-%m-%d", "%m/%d/%Y", "%d.%m.%Y", "%Y%m%d", "%b %-d, %Y", "%-d-%b-%Y")


def _written(date: str, key: str):
    out = F.lit("some day")
    for k, pattern in enumerate(WRITTEN[:-1]):
        out = F.when(F.pmod(F.col(key), F.lit(len(WRITTEN))) == k, F.date_format(date, pattern)).otherwise(out)
    return out


def written_log(spark, folder):
    """Shipments with both dates as texts of many formats; some are blank or no dates at all."""
    orders = table(spark, folder, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority"])
    items = table(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_returnflag"], heavy=True)
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.col("o_orderpriority").alias("entity_id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("request_id"),
        F.when(F.col("l_partkey") % 11 == 0, "  ").otherwise(F.concat(F.lit(" "), _written("o_orderdate", "l_orderkey"))).alias("submitted"),
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(_written("l_shipdate", "l_partkey")).alias("Date_Responded"))


def _sql_written(date: str, key: str) -> str:
    cases = " ".join(f"WHEN {k} THEN strftime({date}, '{p}')" for k, p in enumerate(SQL_WRITTEN))
    return f"CASE {key} % {len(WRITTEN)} {cases} ELSE 'some day' END"


_SQL_FORMATS = "[" + ", ".join(quoted(p) for p in ("%Y-%m-%d", "%m/%d/%Y", "%d.%m.%Y", "%Y%m%d", "%b %d, %Y", "%d-%b-%Y")) + "]"
SQL_READ = f"""
texts AS (SELECT o_orderpriority AS entity_id, l_orderkey || '-' || l_linenumber AS request_id,
    CASE WHEN l_partkey % 11 = 0 THEN '  ' ELSE ' ' || {_sql_written('o_orderdate', 'l_orderkey')} END AS submitted,
    CASE WHEN l_returnflag <> 'R' THEN {_sql_written('l_shipdate', 'l_partkey')} END AS responded FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
parsed AS (SELECT *, try_strptime(trim(submitted), {_SQL_FORMATS}) AS a, try_strptime(trim(responded), {_SQL_FORMATS}) AS b FROM texts),
outcomes AS (SELECT *, CASE WHEN trim(coalesce(submitted, '')) = '' THEN 'no request date' WHEN a IS NULL THEN 'unreadable request date'
    WHEN trim(coalesce(responded, '')) = '' THEN 'no response date' WHEN b IS NULL THEN 'unreadable response date' ELSE 'valid' END AS outcome FROM parsed)"""


@query("P1 (ledger)", f"""WITH {SQL_READ} SELECT entity_id, outcome, count(*) AS n_rows,
    count(*) FILTER (WHERE regexp_matches(trim(submitted), '^[A-Z0-9-]+[a-z]{{2}}')) AS n_named_months,
    sum(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN date_diff('day', a::DATE, b::DATE) END)::BIGINT AS sum_days FROM outcomes GROUP BY ALL""")
def request_date_ledger(spark, folder):
    found = sla.date_outcomes(written_log(spark, folder))
    return found.groupBy("entity_id", "outcome").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("request_format").isin("name_day", "day_name")).alias("n_named_months"), F.sum("days").alias("sum_days"))


def _write_logs(spark, folder) -> str:
    """Request logs as CSV files of different headers, one folder of part files per priority; one has no dates, one is empty."""
    out = f"{scratch_folder(spark)}/request-logs-{uuid.uuid4().hex}"
    log = written_log(spark, folder)
    layouts = {
        "1-URGENT": ("request_id", "submitted", "Date_Responded"),
        "2-HIGH": (" Completed ", "Request_Date", "request_id"),
        "3-MEDIUM": ("request", "note, internal", "response"),
        "4-NOT SPECIFIED": ("completed", "Submitted", "response"),   # two candidates for the response: the rightmost counts
        "5-LOW": ("request_id", "opened", "closed"),
    }
    for priority, names in layouts.items():
        rows = log.where(F.col("entity_id") == priority)
        columns = {"1-URGENT": ("request_id", "submitted", "Date_Responded"), "2-HIGH": ("Date_Responded", "submitted", "request_id"),
                   "3-MEDIUM": ("submitted", "request_id", "Date_Responded"), "4-NOT SPECIFIED": ("request_id", "submitted", "Date_Responded"),
                   "5-LOW": ("request_id", "submitted", "Date_Responded")}[priority]
        named = rows.select(*(F.col(c).alias(n) for c, n in zip(columns, names)))
        named.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{out}/{priority[0]}")
    log.limit(0).select("request_id").coalesce(1).write.text(f"{out}/6")
    return out


@query("S5 P1 A7", f"""WITH {SQL_READ}, d AS (SELECT *, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN date_diff('day', a::DATE, b::DATE) END AS days FROM outcomes)
SELECT left(entity_id, 1) AS log, count(days) AS total_requests, count(*) - count(days) AS dropped_requests, count(*) FILTER (WHERE days > 45) AS late_responses,
    max(days) AS max_response_days, CAST(NULL AS VARCHAR) AS error FROM d WHERE entity_id <> '5-LOW' GROUP BY 1
UNION ALL SELECT '5', NULL, NULL, NULL, NULL, 'Could not identify date columns. Found: request_id, opened, closed'
UNION ALL SELECT '6', NULL, NULL, NULL, NULL, 'Could not read CSV: no columns'
UNION ALL SELECT '7', NULL, NULL, NULL, NULL, 'File not found'""")
def request_log_files(spark, folder):
    """Logs written with other headers each, read in one scan; a missing, an empty and a date-less one are error rows."""
    logs = read_request_logs(spark, _write_logs(spark, folder), expected=["7"])
    by_folder = F.split("source", "/")[0].alias("source")
    status = logs.status.groupBy(by_folder).agg(F.min("error").alias("error"))  # all part files of a log have one header
    found = sla.log_summaries(logs.rows.select(by_folder, "request_date", "response_date"), status)
    return found.select(F.col("entity_id").alias("log"), "total_requests", "dropped_requests", "late_responses", "max_response_days", "error")
