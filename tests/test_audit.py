import glob
import json
import re

from pyspark.sql import functions as F

from auditlark.operators import forensics as FO
from auditlark.operators import sla
from auditlark.operators import synth as S
from auditlark.plans.audit import report_documents, evaluate_audit, report_items, report_rows, run_audit
from auditlark.rulepack import PII_PATTERNS
from auditlark.sources import reports as store
from auditlark.sources.reports import write_reports

STATUTE = ("This act applies to persons who control personal data of not less than 100,000 consumers. The right to access, the right to correct, "
           "the right to delete, data portability, the right to opt out and the right to appeal apply. Forty-five days to respond to a request.")


def planted(spark, n_entities=12):
    """Policies with known clauses, customers with known data, logs with known lateness."""
    entities = spark.range(n_entities).withColumnRenamed("id", "entity")
    made = S.policies(entities, "entity").withColumn("entity_id", F.col("entity_id").cast("string"))
    people = S.customers(S.keys(spark, 600))
    owner = F.pmod(F.substring("customer_id", 2, 9).cast("bigint"), F.lit(n_entities)).cast("string")
    columns = people.columns
    scanned = FO.scan(people.select(owner.alias("source"), *columns), FO.row_text(people, columns), ["source"])
    report = FO.report_from_scan(scanned, columns).withColumn("entity_id", F.col("source"))
    statutes = spark.createDataFrame([("CT", 1, STATUTE)], "jurisdiction string, doc_id int, text string")
    log = S.request_log(S.keys(spark, 600), 600)
    requests = log.withColumn("entity_id", F.pmod(F.substring("customer_id", 2, 9).cast("bigint"), F.lit(n_entities)).cast("string"))
    return made, report, statutes, requests


def test_generators_are_repeatable(spark):
    a = sorted(map(str, S.customers(S.keys(spark, 200).repartition(1)).collect()))
    b = sorted(map(str, S.customers(S.keys(spark, 200).repartition(7)).collect()))
    assert a == b
    rows = S.customers(S.keys(spark, 2000)).collect()
    share = lambda c: sum(bool(r[c]) for r in rows) / len(rows)
    assert 0.45 < share("diagnosis") < 0.6 and 0.2 < share("racial_ethnic_origin") < 0.32 and 0.12 < share("religion") < 0.22
    patterns = dict(PII_PATTERNS)
    for r in rows[:50]:
        assert re.fullmatch(patterns["email"], r["email"]) and re.fullmatch(patterns["ssn"], r["ssn"])
        assert re.fullmatch(patterns["phone"], r["phone"]) and re.fullmatch(patterns["date_of_birth"], r["date_of_birth"])


def test_request_mix(spark):
    log = S.request_log(S.keys(spark, 4000), 100)
    row = sla.sla_summary(log.withColumn("e", F.lit("e")), "e").collect()[0]
    assert 17 < row["late_percentage"] < 23 and 0.035 < row["extreme_late_responses"] / 4000 < 0.065
    assert {r["days"] for r in sla.response_days(log).select("days").collect()} <= set(range(1, 151))


def test_planted_audit(spark, tmp_path):
    made, report, statutes, requests = planted(spark)
    audit = run_audit(made.withColumn("jurisdiction", F.lit("CT")).select("entity_id", "jurisdiction", "text"), report, statutes, requests)

    covered = {r["entity_id"]: set(r["covered_rights"]) for r in made.collect()}
    rights = {r for r, _ in S.CLAUSES}
    found = audit.violations.collect()
    missing = {e: {v["right"] for v in found if v["entity_id"] == e and v["type"] == "MISSING_RIGHT"} for e in covered}
    assert missing == {e: rights - held for e, held in covered.items()}
    no_appeal = {v["entity_id"] for v in found if v["type"] == "CRITICAL_NO_APPEAL"}
    assert no_appeal == {e for e, held in covered.items() if "appeal" not in held}
    assert all(v["source_file"] for v in found if v["type"] == "UNDISCLOSED_SENSITIVE_DATA")
    assert not any(v["type"] == "THRESHOLD_TRIGGERED" for v in found)

    expected = {
        "violations": made.select("entity_id", F.lit("MISSING_RIGHT").alias("type"), F.explode(F.array_except(
            F.array(*[F.lit(r) for r, _ in S.CLAUSES]), "covered_rights")).alias("right")),
        "non_violations": made.select("entity_id", F.lit("MISSING_RIGHT").alias("type"), F.explode("covered_rights").alias("right")),
        "pii_types": made.select("entity_id", F.explode(F.array(*[F.lit(t) for t in ("email", "ssn", "phone", "date_of_birth")])).alias("type")),
        "coverage": made.select("entity_id", F.explode(F.array(*[F.lit(r) for r, _ in S.CLAUSES])).alias("right"), "covered_rights")
        .withColumn("covered", F.expr("array_contains(covered_rights, right)")),
    }
    scored = evaluate_audit(audit, expected)
    assert {r["score"] for r in scored["score"].collect()} == {1.0}
    assert {r["recall"] for r in scored["pii"].collect()} == {1.0}
    accuracy = {r["entity_id"]: r for r in scored["violation_accuracy"].collect()}
    assert all(r["false_negatives"] == 0 for r in accuracy.values())
    stages = {(r["entity_id"], r["stage"]): r["status"] for r in scored["stages"].collect()}
    assert stages["0", "Regulatory Analyst"] == "PASS" and stages["0", "Appeals Processor"] == "PASS"

    rows = report_rows(audit, "2024-06-01 00:00:00")
    assert rows.count() == 12
    shown = "\n".join(rows.toJSON().collect())
    assert not any(re.search(p, shown) for k, p in PII_PATTERNS if k in ("email", "ssn", "credit_card", "date_of_birth"))
    write_reports(rows, str(tmp_path / "reports"))
    back = spark.read.json(str(tmp_path / "reports"))
    assert back.count() == 12 and {str(r["run_date"]) for r in back.select("run_date").distinct().collect()} == {"2024-06-01"}
    items = report_items(audit)
    assert items.where("kind = 'violation'").count() == len(found) and items.where("kind = 'detail'").count() == audit.pii_report.count()
    assert not any(re.search(p, "\n".join(r["row"] for r in items.collect())) for k, p in PII_PATTERNS if k in ("email", "ssn"))
    scores = {r["entity_id"]: r for r in audit.scores.collect()}
    assert all(0 <= r["risk_score"] <= 100 for r in scores.values())


def test_threshold_and_default_rights(spark):
    policies = spark.createDataFrame([("e", "X", "nothing")], "entity_id string, jurisdiction string, text string")
    statutes = spark.createDataFrame([("X", 1, "35,000 consumers")], "jurisdiction string, doc_id int, text string")
    report = FO.text_report(spark.createDataFrame([("s", "a@b.org")], "source string, text string"), "text").withColumn("entity_id", F.lit("e"))
    big = report.withColumn("unique_consumers", F.lit(35000).cast("bigint"))
    found = run_audit(policies, big, statutes, keep=False).violations.collect()
    assert {v["right"] for v in found if v["right"]} == {r for r, _ in S.CLAUSES}
    fired = [v for v in found if v["type"] == "THRESHOLD_TRIGGERED"]
    assert fired[0]["total_unique"] == 35000 and fired[0]["confidence"] == 0.9


def test_statute_right_without_description(spark):
    from auditlark.rulepack import DEFAULT_PACK

    pack = DEFAULT_PACK.replace(statute_rights=DEFAULT_PACK.statute_rights + (("object", ("right to object",)),))
    policies = spark.createDataFrame([("a", "X", "nothing"), ("b", "X", "This is our statement on the right to object."), ("c", "Y", "nothing")],
                                     "entity_id string, jurisdiction string, text string")
    statutes = spark.createDataFrame([("X", 1, "right to object, right to delete")], "jurisdiction string, doc_id int, text string")
    report = FO.text_report(spark.createDataFrame([("s", "x")], "source string, text string"), "text").withColumn("entity_id", F.lit("a"))
    found = [v for v in run_audit(policies, report, statutes, pack=pack, keep=False).violations.collect() if v["type"] == "MISSING_RIGHT"]
    rights = {e: {v["right"] for v in found if v["entity_id"] == e} for e in "abc"}
    assert rights == {"a": {"delete", "object"}, "b": {"delete"}, "c": {r for r, _ in S.CLAUSES}}
    assert {v["description"] for v in found if v["right"] == "object"} == {"right to object"}


def test_long_keys_are_not_cut(frame):
    ids = frame([(1234567,), (12,)], "id bigint")
    assert {r["customer_id"] for r in S.customers(ids).collect()} == {"C1234567", "C000012"}
    assert {r["request_id"] for r in S.request_log(ids, 5).collect()} == {"R1234567", "R0012"}


USAGE = "entity_id string, agent string, input_tokens long, output_tokens long, total_cost_usd double, duration_ms long"


def test_documents_are_whole_reports(spark, frame, tmp_path):
    made, report, statutes, requests = planted(spark)
    audit = run_audit(made.withColumn("jurisdiction", F.lit("CT")).select("entity_id", "jurisdiction", "text"), report, statutes, requests)
    usage = frame([("0", "b", 5, 6, 0.5, 7), ("0", "a", 1, 2, 0.25, 3), ("0", "a", 1, 1, 0.25, 3)], USAGE)
    lines = report_documents(audit, "2024-06-01 00:00:00", usage)
    out = store.write_documents(lines, str(tmp_path / "store"), "20240601_000000")
    documents = {}
    for path in glob.glob(f"{out}/entity_id=*/*.txt"):
        documents[re.search("entity_id=([^/]+)", path)[1]] = json.loads(open(path).read())  # one file per entity, valid as a whole
    violations = [v.asDict() for v in audit.violations.collect()]
    assert set(documents) == {r.entity_id for r in made.collect()}
    for entity, d in documents.items():
        own = sorted((v for v in violations if v["entity_id"] == entity), key=lambda v: v["position"])
        assert [v["type"] for v in d["violations"]] == [v["type"] for v in own] and [v["position"] for v in own] == list(range(1, len(own) + 1))
        assert d["executive_summary"]["total_violations"] == len(own)
        assert [v["type"] for v in d["compliance_findings"]["violations"] + d["appeals_findings"]["violations"]] == [v["type"] for v in own]
        assert d["compliance_findings"]["summary"]["total_violations"] == len(d["compliance_findings"]["violations"])
        assert len(d["pii_findings"]["details"]) == d["pii_findings"]["files_analyzed"]
        severities = {v["severity"] for v in d["appeals_findings"]["violations"]}
        assert d["appeals_findings"]["risk"] == ("CRITICAL" if "CRITICAL" in severities else "HIGH" if "HIGH" in severities else "MEDIUM" if severities else "LOW")
        assert set(d) == {"metadata", "executive_summary", "regulatory_analysis", "pii_findings", "compliance_findings", "appeals_findings", "violations", "recommendations", "_cost_summary"}
        assert "applicable_rules" in d["regulatory_analysis"] and d["metadata"]["scope"]
    assert documents["0"]["_cost_summary"] == {
        "total_cost_usd": 1.0, "total_input_tokens": 7, "total_output_tokens": 9, "total_tokens": 16, "total_duration_ms": 13, "model": "unknown", "per_agent": [
            {"agent": "a", "input_tokens": 2, "output_tokens": 3, "total_cost_usd": 0.5, "duration_ms": 6}, {"agent": "b", "input_tokens": 5, "output_tokens": 6, "total_cost_usd": 0.5, "duration_ms": 7}]}
    assert documents["1"]["_cost_summary"]["per_agent"] == [] and documents["1"]["_cost_summary"]["total_tokens"] == 0


def test_report_store_reads_every_layout(spark, tmp_path):
    def save(run, entity, text):
        folder = tmp_path / f"report_{run}" / f"entity_id={entity}"
        folder.mkdir(parents=True)
        (folder / "part-0.txt").write_text(text)

    save("20240101_000000", "a", json.dumps({"executive_summary": {"overall_status": "PASS"}}, indent=2))
    save("20240301_000000", "a", json.dumps({"executive_summary": {"risk_grade": "C"}, "_cost_summary": {"total_tokens": 5, "per_agent": [{"agent": "x", "input_tokens": 5}]}, "new_block": {"k": 1}}))
    save("20240201_000000", "b", "{ broken")
    save("20240101_000000", "b", json.dumps({"violations": [{"type": "T", "severity": "HIGH"}]}))
    saved = store.read_documents_store(spark, str(tmp_path))
    rows = [(r.run, r.entity_id, r.error) for r in store.newest_first(saved).collect()]
    assert [r[0] for r in rows] == sorted((r[0] for r in rows), reverse=True) and ("20240201_000000", "b", "Could not read report") in rows
    newest = {r.entity_id: r for r in store.newest_of_each(saved).collect()}
    assert newest["a"].run == "20240301_000000" and newest["a"].executive_summary.risk_grade == "C" and newest["b"].violations[0].type == "T"
    cost = newest["a"]._cost_summary
    assert (cost.total_tokens, cost.total_cost_usd, cost.model, cost.per_agent[0].agent) == (5, 0.0, "unknown", "x")
    assert newest["b"]._cost_summary.per_agent == [] and newest["b"]._cost_summary.total_tokens == 0
