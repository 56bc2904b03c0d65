import json

import pytest

from auditlark.operators import report as RP
from auditlark.operators import violations as V

SCHEMA = "entity_id string, type string, right string, data_category string, source_file string, severity string, confidence double"


def rows(frame, *severities, entity="e"):
    return frame([(entity, "T", None, None, None, s, 0.9) for s in severities], SCHEMA)


@pytest.mark.parametrize("severities, score, grade, label", [
    (["MEDIUM", "MEDIUM", "LOW"], 9, "A", "Minimal Risk"),
    (["CRITICAL"], 10, "B", "Low Risk"),
    (["CRITICAL", "CRITICAL", "HIGH", "LOW", "LOW"], 29, "B", "Low Risk"),
    (["CRITICAL"] * 3, 30, "C", "Moderate Risk"),
    (["CRITICAL"] * 4 + ["HIGH", "LOW", "LOW"], 49, "C", "Moderate Risk"),
    (["CRITICAL"] * 5, 50, "D", "High Risk"),
    (["CRITICAL"] * 6 + ["HIGH", "LOW", "LOW"], 69, "D", "High Risk"),
    (["CRITICAL"] * 7, 70, "F", "Critical Risk"),
    (["CRITICAL"] * 12, 100, "F", "Critical Risk"),
    (["ODD"], 4, "A", "Minimal Risk"),
    ([None], 4, "A", "Minimal Risk"),
    (["INFO"], 0, "A", "Minimal Risk"),
])
def test_score_and_grade(frame, severities, score, grade, label):
    row = RP.risk_scores(rows(frame, *severities)).collect()[0]
    assert (row["risk_score"], row["risk_grade"], row["risk_label"], row["overall_status"]) == (score, grade, label, "FAIL")


def test_clean_entity(frame):
    entities = frame([("e",), ("clean",)], "entity_id string")
    got = {r["entity_id"]: r for r in RP.risk_scores(rows(frame, "HIGH"), entities).collect()}
    assert (got["clean"]["risk_label"], got["clean"]["overall_status"], got["clean"]["risk_score"]) == ("Excellent", "PASS", 0)
    summary = {r["entity_id"]: (r["status"], r["risk_level"]) for r in V.severity_summary(rows(frame, "HIGH"), entities).collect()}
    assert summary == {"e": ("Non-Compliant", "HIGH"), "clean": ("Compliant", "LOW")}


@pytest.mark.parametrize("severities, status, risk", [
    (["CRITICAL", "HIGH"], "Non-Compliant", "CRITICAL"), (["HIGH", "INFO"], "Non-Compliant", "HIGH"),
    (["MEDIUM"], "Needs Review", "MEDIUM"), (["INFO"], "Needs Review", "MEDIUM")])
def test_status_ladder(frame, severities, status, risk):
    row = V.severity_summary(rows(frame, *severities)).collect()[0]
    assert (row["status"], row["risk_level"]) == (status, risk)


def test_recommendations(frame):
    df = frame([
        ("e", "MISSING_RIGHT", "delete", None, None, "HIGH", 0.9), ("e", "MISSING_RIGHT", "object", None, None, "MEDIUM", 0.9),
        ("e", "UNDISCLOSED_SENSITIVE_DATA", None, "religious", "t", "CRITICAL", 0.9), ("e", "LATE_RESPONSE", None, None, None, "HIGH", 0.9),
        ("e", "NO_SUCH_TYPE", None, None, None, "HIGH", 0.9)], SCHEMA)
    got = {(r["for_violation"], r["right"]): r for r in RP.recommendations(df).collect()}
    assert len(got) == 4
    assert got["MISSING_RIGHT", "delete"]["recommendation"].startswith("Include a clear right-to-delete provision")
    assert got["MISSING_RIGHT", "object"]["recommendation"] == "Add the 'object' right to your privacy policy."
    assert got["MISSING_RIGHT", "object"]["priority"] == "MEDIUM"
    assert "processing of religious data" in got["UNDISCLOSED_SENSITIVE_DATA", None]["recommendation"]
    assert got["LATE_RESPONSE", None]["priority"] == "HIGH"


def test_citations_titles_and_overrides(frame):
    df = frame([("e", "MISSING_RIGHT", "appeal", None, None, "HIGH", 0.9), ("e", "LATE_RESPONSE", "", None, None, "HIGH", 0.9),
                ("e", "OTHER", None, "health_data", "t", "LOW", 0.9)], SCHEMA)
    sections = {r["type"]: r["section"] for r in RP.with_citations(df).collect()}
    assert sections == {"MISSING_RIGHT": "Sec. 42-520(a)(6)", "LATE_RESPONSE": "Sec. 42-520(c)", "OTHER": None}
    titles = {r[0] for r in df.select(RP.display_title()).collect()}
    assert titles == {"MISSING_RIGHT - appeal", "LATE_RESPONSE", "OTHER (health_data)"}
    marked = df.withColumn("violation_id", RP.violation_id())
    gone = marked.where("type = 'OTHER'").select("violation_id")
    assert {r["type"] for r in RP.apply_overrides(marked, gone).collect()} == {"MISSING_RIGHT", "LATE_RESPONSE"}
    summary = RP.override_summary(marked, gone.union(gone)).collect()[0]
    assert (summary["total"], summary["overridden"], summary["active"]) == (3, 1, 2)


def test_first_recommendation(frame):
    df = frame([("e", "MISSING_RIGHT", "appeal", None, None, "HIGH", 0.9), ("e", "LATE_RESPONSE", None, None, None, "HIGH", 0.9),
                ("e", "OTHER", None, None, None, "LOW", 0.9)], SCHEMA)
    advice = frame([("e", "MISSING_RIGHT", "access", "P1", "first", 1), ("e", "MISSING_RIGHT", "appeal", "P2", "second", 2),
                    ("e", "LATE_RESPONSE", None, "P3", "third", 3), ("e", "LATE_RESPONSE", None, "P4", "fourth", 4)],
                   "entity_id string, for_violation string, right string, priority string, recommendation string, position int")
    got = {r["type"]: (r["action_priority"], r["action"]) for r in RP.with_first_recommendation(df, advice).collect()}
    assert got == {"MISSING_RIGHT": ("P2", "second"), "LATE_RESPONSE": ("P3", "third"), "OTHER": ("LOW", None)}


def test_usage(frame):
    usage = frame([("a", 1, 2, 0.5, 10), ("a", 3, 4, 0.25, 20), ("b", 5, 6, 2.0, 30)],
                  "agent string, input_tokens bigint, output_tokens bigint, total_cost_usd double, duration_ms bigint")
    got = {r["agent"]: r for r in RP.usage_rollup(usage).collect()}
    assert got[None]["total_tokens"] == 21 and got["a"]["total_cost_usd"] == 0.75 and got[None]["total_duration_ms"] == 60
    assert [(r["agent"], r["cost_rank"]) for r in RP.cost_ranking(usage).collect()] == [("b", 1), ("a", 2)]


def test_evidence_holds_every_line(frame):
    df = frame([("e", f"T{i}", None, None, None, "HIGH", 0.9) for i in range(50)] + [("e", "same", None, None, None, "HIGH", 0.9)] * 30, SCHEMA)
    scores = RP.risk_scores(df)
    assert RP.evidence_lines(df, scores).count() == 81
    one = RP.evidence_text(df, scores).collect()
    assert len(one) == 1 and one[0]["answer"].count("Violation: ") == 80 and one[0]["answer"].startswith("Compliance Status: ")


def test_union_of_violations(frame):
    a = frame([("e", "A", "access")], "entity_id string, type string, right string")
    b = frame([("e", "B", 5)], "entity_id string, type string, late_count int")
    df = V.union_violations(a, b)
    assert df.columns == list(V.VIOLATION_COLUMNS)
    assert {(r["type"], r["right"], r["late_count"]) for r in df.collect()} == {("A", "access", None), ("B", None, 5)}


def test_ids_tell_joined_parts_apart(frame):
    df = frame([("a|b", "c"), ("a", "b|c")], "entity_id string, type string").selectExpr("*", "'' AS right", "'' AS data_category", "'' AS source_file")
    assert df.select(RP.violation_id().alias("i")).distinct().count() == 2


def test_calls_without_agent_are_not_the_total(frame):
    usage = frame([(None, 1, 2, 0.5, 10), ("a", 3, 4, 0.25, 20)], "agent string, input_tokens int, output_tokens int, total_cost_usd double, duration_ms int")
    got = {(r["is_total"], r["agent"]): r["n_calls"] for r in RP.usage_rollup(usage).collect()}
    assert got == {(False, None): 1, (False, "a"): 1, (True, None): 2}


STRUCTURED = {"executive_summary": {"overall_status": "FAIL", "risk_assessment": {"grade": "D"}}, "violations": [{"type": "T", "severity": "HIGH", "description": "d"}, {"type": "U", "severity": "INFO", "finding": "f"}]}
PROSE = "Status: compliant\nGrade: b\n\nSUMMARY\n\n*All* fine.\n\nVIOLATION 1: High delay\nbody"
SHAPES = {
    "structured": (json.dumps(STRUCTURED), ("structured", "FAIL", "D", "", [("T", "HIGH", "d"), ("U", "INFO", "f")])),
    "failed": (json.dumps({"status": "FAILED", "message": "m"}), ("failed", "ERROR", "?", "Pipeline error: Unknown error. m", [])),
    "error": (json.dumps({"error": "E", "violations": []}), ("failed", "ERROR", "?", "Pipeline error: E. ", [])),
    "error with summary": (json.dumps({"error": "E", "executive_summary": {"risk_grade": "A", "summary": "s"}}), ("failed", None, "A", "s", [])),
    "narrative": (json.dumps({"raw_response": PROSE}), ("narrative", "COMPLIANT", "B", "All fine.", [("High delay", "HIGH", "High delay\nbody")])),
    "no json": (PROSE, ("narrative", "COMPLIANT", "B", "All fine.", [("High delay", "HIGH", "High delay\nbody")])),
    "narrative with own fields": (json.dumps({"raw_response": PROSE, "executive_summary": {"risk_grade": "F"}, "violations": []}), ("narrative", None, "F", "All fine.", [])),
    "empty summary": (json.dumps({**STRUCTURED, "executive_summary": {}, "raw_response": "nothing"}), ("narrative", None, "?", "", [("T", "HIGH", "d"), ("U", "INFO", "f")])),
    "plain": (json.dumps({"other": 1}), ("plain", None, "?", "", [])),
    "wrong types": (json.dumps({"executive_summary": 5, "violations": "none", "raw_response": ""}), ("plain", None, "?", "", [])),
    "a list": ("[1, 2]", ("narrative", "UNKNOWN", "?", "", [])),
    "empty": ("", ("plain", None, "?", "", [])), "null": (None, ("plain", None, "?", "", [])),
}


def test_reports_of_any_shape(frame):
    df = frame([(k, d) for k, (d, _) in SHAPES.items()], "k string, d string")
    for r in RP.normalize_reports(df, ["k"], "d").collect():
        found = (r.branch, r.status, r.risk_grade, r.summary, [tuple(v) for v in r.violations])
        assert found == SHAPES[r.k][1], r.k
        assert r.total_violations == len(r.violations) and r.high_violations == sum(v.severity == "HIGH" for v in r.violations)


def test_answers_and_fallback(frame):
    scores = frame([("a", "FAIL", "C", "two gaps"), ("b", "PASS", "A", None)], "entity_id string, overall_status string, risk_grade string, summary string")
    found = frame([("a", "T", None, "HIGH", 2), ("a", "U", "delete", None, 1)], "entity_id string, type string, right string, severity string, position long")
    advice = frame([("a", "T", None, None, "do it", 2), ("a", "U", None, None, None, 1)], "entity_id string, for_violation string, right string, data_category string, recommendation string, position long")
    entities = frame([("a",), ("b",), ("c",)], "entity_id string")
    got = {r.entity_id: r.answer for r in RP.evidence_text(found, scores, advice, entities).collect()}
    assert got["a"] == ("Compliance Status: FAIL\nRisk Grade: C\nSummary: two gaps\nViolation: U - delete ()\nViolation: T -  (HIGH)\nRecommendation: \nRecommendation: do it")
    assert got["b"] == "Compliance Status: PASS\nRisk Grade: A\nSummary: " and got["c"] == "No structured data found in report."


def test_contexts_are_cut_and_bounded(frame):
    blocks = frame([("a", ("CT",), (3,), ("LOW",)), ("b", None, None, None), ("c", None, (0,), None)],
                   "entity_id string, regulatory_analysis struct<law:string>, pii_findings struct<files:int>, appeals_findings struct<risk:string>")
    details = frame([("a", i, '{"n":%d}' % i) for i in range(1, 500)], "entity_id string, position long, row string")
    got = {(r.entity_id, r.position): r.context for r in RP.contexts(blocks, details, limit=100).collect()}
    whole = '{"files":3,"details":[' + ",".join('{"n":%d}' % i for i in range(1, 500)) + "]}"
    assert got == {("a", 1): 'Regulatory Analysis: {"law":"CT"}', ("a", 2): "PII Findings: " + whole[:100], ("a", 3): 'Appeals Findings: {"risk":"LOW"}',
                   ("b", 1): "No context available", ("c", 1): 'PII Findings: {"files":0,"details":[]}'}
