"""Findings scored against the labels: documents with personal data are what
was detected, low-quality documents are what was expected."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlark.catalog.registry import joined, query, quoted, sql_any, sql_round, table
from auditlark.operators import evaluate as E
from auditlark.operators import forensics as FO
from auditlark.rulepack import DEFAULT_PACK, GROUND_TRUTH_KEYS

ANY_PII = " OR ".join(f"regexp_matches(text, {quoted(p)})" for _, p in DEFAULT_PACK.patterns)

SQL_SETS = f"""
sources AS (SELECT doc_id, source FROM documents),
det AS (SELECT DISTINCT source, 'doc' || doc_id AS subject FROM documents WHERE {ANY_PII}),
exp AS (SELECT DISTINCT source, 'doc' || doc_id AS subject FROM labels JOIN sources USING (doc_id) WHERE quality = 0),
non AS (SELECT DISTINCT source, 'doc' || doc_id AS subject FROM labels JOIN sources USING (doc_id) WHERE quality = 1),
m AS (SELECT coalesce(det.source, exp.source) AS source, coalesce(det.subject, exp.subject) AS subject, det.subject IS NOT NULL AS d, exp.subject IS NOT NULL AS e
      FROM det FULL JOIN exp ON det.source = exp.source AND det.subject = exp.subject),
counts AS (SELECT source, count(*) FILTER (WHERE d AND e) AS tp, count(*) FILTER (WHERE d AND NOT e) AS fp, count(*) FILTER (WHERE e AND NOT d) AS fn FROM m GROUP BY source)"""


def detected_documents(spark, folder):
    docs = table(spark, folder, "documents", ["doc_id", "source", "text"], heavy=True)
    flagged = FO.row_flags(docs, F.col("text")).where(F.size("pii_types") > 0)
    return flagged.select("source", F.lit("MISSING_RIGHT").alias("type"), F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("right"))


def labelled_documents(spark, folder, quality):
    labels = table(spark, folder, "labels", ["doc_id", "quality"]).where(F.col("quality") == quality).select("doc_id")
    docs = table(spark, folder, "documents", ["doc_id", "source"])
    return labels.join(docs, "doc_id").select(
        "source", F.lit("MISSING_RIGHT").alias("type"), F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("right"))


@query("J9 A13 U3 U4 U5", f"""WITH {SQL_SETS},
tns AS (SELECT non.source, count(*) AS tn FROM non WHERE NOT EXISTS (SELECT 1 FROM det WHERE det.source = non.source AND det.subject = non.subject) GROUP BY 1),
a AS (SELECT coalesce(c.source, t.source) AS source, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn, coalesce(tn, 0) AS tn
      FROM counts c FULL JOIN tns t ON c.source = t.source)
SELECT source, tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
       {sql_round('(tp + tn)::DOUBLE / (tp + fp + fn + tn)', 4)} AS accuracy FROM a""")
def violation_accuracy(spark, folder):
    return E.violation_accuracy(detected_documents(spark, folder), labelled_documents(spark, folder, 0),
                                labelled_documents(spark, folder, 1), ["source"])


@query("J10 A14", f"""WITH {SQL_SETS}, r AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS r FROM counts)
SELECT source, tp AS true_positives, fp AS false_positives, fn AS false_negatives, {sql_round('p', 4)} AS precision, {sql_round('r', 4)} AS recall,
       {sql_round('CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END', 4)} AS f1 FROM r""")
def precision_recall(spark, folder):
    matched = E.match_sets(
        E.violation_keys(detected_documents(spark, folder), ["source"]),
        E.violation_keys(labelled_documents(spark, folder, 0), ["source"]), ["source", "type", "subject"])
    return E.precision_recall(matched, ["source"])


EXPECTED_TYPES = ("email", "SSN", "Phone", "health_data", "ip_address")
SQL_TYPES = (
    "det AS (" + " UNION ALL ".join(f"SELECT DISTINCT source, {quoted(k)} AS type FROM documents WHERE regexp_matches(text, {quoted(p)})" for k, p in DEFAULT_PACK.patterns)
    + "".join(f" UNION SELECT DISTINCT source, {quoted(c)} FROM documents WHERE {sql_any('lower(text)', terms)}" for c, terms in DEFAULT_PACK.keywords)
    + "), exp AS (SELECT DISTINCT source, lower(t) AS type FROM documents, (VALUES " + ", ".join(f"({quoted(t)})" for t in EXPECTED_TYPES) + ") AS x(t))")


@query("J10 W5 U3 U4", f"""WITH {SQL_TYPES},
m AS (SELECT coalesce(det.source, exp.source) AS source, coalesce(det.type, exp.type) AS type, det.type IS NOT NULL AS d, exp.type IS NOT NULL AS e
      FROM det FULL JOIN exp ON det.source = exp.source AND det.type = exp.type)
SELECT source, coalesce(string_agg(type, ',' ORDER BY type) FILTER (WHERE d), '') AS detected_list, coalesce(string_agg(type, ',' ORDER BY type) FILTER (WHERE e), '') AS expected_list,
       coalesce(string_agg(type, ',' ORDER BY type) FILTER (WHERE e AND NOT d), '') AS missed, coalesce(string_agg(type, ',' ORDER BY type) FILTER (WHERE d AND NOT e), '') AS extra
FROM m GROUP BY source""")
def pii_type_lists(spark, folder):
    docs = table(spark, folder, "documents", ["source", "text"], heavy=True)
    report = FO.text_report(docs, "text")
    detected = report.select("source", F.explode("pii_detected").alias("type"))
    expected = table(spark, folder, "documents", ["source"]).distinct().select(
        "source", F.explode(F.array(*[F.lit(t) for t in EXPECTED_TYPES])).alias("type"))
    lists = E.type_lists(E.pii_type_sets(detected, expected, ["source"]), ["source"], "type")
    return lists.select("source", *[joined(c).alias(c) for c in ("detected_list", "expected_list", "missed", "extra")])


@query("J10 U3 U4 (arrays)", f"""WITH d AS (SELECT doc_id, list_filter([{', '.join(f"CASE WHEN regexp_matches(text, {quoted(p)}) THEN {quoted(k)} END" for k, p in DEFAULT_PACK.patterns)}],
lambda x: x IS NOT NULL) AS kinds, ['email', 'phone', 'ssn'] AS want FROM documents)
SELECT doc_id, array_to_string(list_sort(list_intersect(kinds, want)), ',') AS "both", array_to_string(list_sort(list_filter(want, lambda x: NOT list_contains(kinds, x))), ',') AS missed,
       array_to_string(list_sort(list_filter(kinds, lambda x: NOT list_contains(want, x))), ',') AS extra FROM d""")
def pii_array_overlap(spark, folder):
    docs = table(spark, folder, "documents", ["doc_id", "text"], heavy=True)
    flagged = FO.row_flags(docs, F.col("text"))
    want = F.array(*[F.lit(t) for t in ("email", "phone", "ssn")])
    return flagged.select("doc_id", *[joined(c).alias(n) for n, c in E.array_overlap(F.col("pii_types"), want).items()])


@query("J11 P8", """WITH q AS (SELECT DISTINCT source, lower(lang) AS "right" FROM documents),
cov AS (SELECT source, "right", length("right" || source) % 2 = 0 AS covered FROM q),
fl AS (SELECT DISTINCT d.source, lower(d.lang) AS "right" FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 0)
SELECT cov.source, cov."right", cov.covered, fl.source IS NOT NULL AS detected_missing, cov.covered <> (fl.source IS NOT NULL) AS correct
FROM cov LEFT JOIN fl ON cov.source = fl.source AND cov."right" = fl."right" """)
def coverage_check(spark, folder):
    return _coverage(spark, folder)


def _coverage(spark, folder):
    docs = table(spark, folder, "documents", ["doc_id", "source", "lang"])
    expected = docs.select("source", F.lower("lang").alias("right")).distinct().withColumn(
        "covered", F.pmod(F.length(F.concat("right", "source")), F.lit(2)) == 0)
    low = table(spark, folder, "labels", ["doc_id", "quality"]).where(F.col("quality") == 0)
    flagged = low.join(docs, "doc_id").select("source", F.lit("MISSING_RIGHT").alias("type"), F.upper("lang").alias("right"))
    return E.coverage_check(expected, flagged, ["source"])


@query("A15", f"""WITH q AS (SELECT DISTINCT source, lower(lang) AS "right" FROM documents),
cov AS (SELECT source, "right", length("right" || source) % 2 = 0 AS covered FROM q),
fl AS (SELECT DISTINCT d.source, lower(d.lang) AS "right" FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 0),
k AS (SELECT cov.source, cov.covered <> (fl.source IS NOT NULL) AS correct FROM cov LEFT JOIN fl ON cov.source = fl.source AND cov."right" = fl."right")
SELECT source, count(*) FILTER (WHERE correct) AS correct, 6::BIGINT AS total, {sql_round('count(*) FILTER (WHERE correct) / 6.0', 4)} AS score FROM k GROUP BY source""")
def coverage_score(spark, folder):
    return E.coverage_score(_coverage(spark, folder), ["source"])


@query("A16", f"""WITH p AS (SELECT quality::VARCHAR AS label, CASE WHEN {ANY_PII} THEN '0' WHEN lang = 'fr' THEN '2' ELSE '1' END AS prediction FROM labels JOIN documents USING (doc_id)),
cls AS (SELECT label AS class FROM p UNION SELECT prediction FROM p),
k AS (SELECT class, (SELECT count(*) FROM p WHERE label = class AND prediction = class) AS tp, (SELECT count(*) FROM p WHERE label = class) AS support,
      (SELECT count(*) FROM p WHERE prediction = class) AS predicted FROM cls),
s AS (SELECT class, support, tp, CASE WHEN predicted > 0 THEN tp::DOUBLE / predicted ELSE 0 END AS p, CASE WHEN support > 0 THEN tp::DOUBLE / support ELSE 0 END AS r FROM k),
f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM s),
u AS (SELECT class, p, r, f, support FROM f UNION ALL SELECT 'accuracy', sum(tp)::DOUBLE / sum(support), sum(tp)::DOUBLE / sum(support), sum(tp)::DOUBLE / sum(support), sum(support) FROM f
      UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM f
      UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support), sum(support) FROM f)
SELECT class, {sql_round('p', 4)} AS precision, {sql_round('r', 4)} AS recall, {sql_round('f', 4)} AS f1, support::BIGINT AS support FROM u""")
def classification_report(spark, folder):
    docs = table(spark, folder, "documents", ["doc_id", "lang", "text"], heavy=True)
    flagged = FO.row_flags(docs, F.col("text"))
    labels = table(spark, folder, "labels", ["doc_id", "quality"])
    prediction = F.when(F.size("pii_types") > 0, "0").when(F.col("lang") == "fr", "2").otherwise("1")
    rows = flagged.select("doc_id", prediction.alias("prediction")).join(labels, "doc_id").withColumnRenamed("quality", "label")
    return E.classification_report(rows)


@query("A18", f"""WITH e AS (SELECT event_type, user_id, avg(value) AS v, count(*) AS n FROM events GROUP BY ALL),
s AS (SELECT event_type, user_id, CASE WHEN n > 5 THEN round(least(v / 20, 1.0), 2) END AS f1, CASE WHEN n > 3 THEN round(least(v / 15, 1.0), 2) END AS acc, round(least(v / 10, 1.0), 2) AS cov,
      n % 2 = 0 AS rules, n % 3 = 0 AS appeal, n % 5 > 0 AS viol FROM e)
SELECT event_type, user_id, 'Regulatory Analyst' AS stage, CASE WHEN rules THEN 'PASS' ELSE 'PARTIAL' END AS status, NULL::DOUBLE AS score FROM s
UNION ALL SELECT event_type, user_id, 'Data Forensics', CASE WHEN f1 IS NULL THEN 'NOT_EVALUATED' WHEN f1 >= 0.7 THEN 'PASS' ELSE 'NEEDS_IMPROVEMENT' END, f1 FROM s
UNION ALL SELECT event_type, user_id, 'Compliance Auditor', CASE WHEN acc IS NULL OR cov IS NULL THEN 'NOT_EVALUATED' WHEN acc >= 0.7 AND cov >= 0.7 THEN 'PASS' ELSE 'NEEDS_IMPROVEMENT' END, least(acc, cov) FROM s
UNION ALL SELECT event_type, user_id, 'Appeals Processor', CASE WHEN appeal THEN 'PASS' ELSE 'PARTIAL' END, NULL FROM s
UNION ALL SELECT event_type, user_id, 'Report Generator', CASE WHEN viol THEN 'PASS' ELSE 'PARTIAL' END, NULL FROM s""")
def stage_status(spark, folder):
    e = table(spark, folder, "events", ["event_type", "user_id", "value"]).groupBy("event_type", "user_id").agg(
        F.avg("value").alias("v"), F.count(F.lit(1)).alias("n"))
    part = lambda d: F.round(F.least(F.col("v") / d, F.lit(1.0)), 2)
    n = F.col("n")
    metrics = e.select(
        "event_type", "user_id", F.when(n > 5, part(20)).alias("pii_f1"), F.when(n > 3, part(15)).alias("violation_accuracy"),
        part(10).alias("coverage_score"), (n % 2 == 0).alias("has_rules"), (n % 3 == 0).alias("has_appeal"),
        F.lit(True).alias("has_summary"), (n % 5 > 0).alias("has_violations"))
    return E.stage_status(metrics, ["event_type", "user_id"])


@query("F25", f"""WITH k AS (SELECT event_id, {', '.join(f'(event_id // {3 ** i}) % 3 > 0 AS h{i}' for i in range(len(GROUND_TRUTH_KEYS)))} FROM events)
SELECT event_id, {' AND '.join(f'h{i}' for i in range(len(GROUND_TRUTH_KEYS)))} AS is_valid, CASE {' '.join(f"WHEN NOT h{i} THEN 'Missing required key: ''{k}'''" for i, k in enumerate(GROUND_TRUTH_KEYS))} ELSE 'Valid' END AS message FROM k""")
def ground_truth_validation(spark, folder):
    from auditlark.operators.evaluate import validate_ground_truth

    events = table(spark, folder, "events", ["event_id"])
    present = [F.when(F.pmod(F.floor(F.col("event_id") / 3 ** i), F.lit(3)) > 0, F.lit(1)).alias(k) for i, k in enumerate(GROUND_TRUTH_KEYS)]
    submissions = events.select("event_id", F.to_json(F.struct(*present, F.lit(6).alias("total_clauses"))).alias("document"))
    return validate_ground_truth(submissions, "document").select("event_id", "is_valid", "message")
