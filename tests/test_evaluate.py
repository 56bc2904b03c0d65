from auditlark.operators import evaluate as E


def test_violation_accuracy(frame):
    schema = "k string, type string, right string, data_category string"
    detected = frame([("x", "MISSING_RIGHT", "delete", None), ("x", "MISSING_RIGHT", "delete", None), ("x", "U", None, "health_data"),
                      ("x", "LATE", None, None), ("x", "MISSING_RIGHT", "access", None)], schema)
    expected = frame([("x", "MISSING_RIGHT", "delete", None), ("x", "U", "", "religious"), ("y", "U", None, "religious")], schema)
    quiet = frame([("x", "MISSING_RIGHT", "access", None), ("x", "MISSING_RIGHT", "correct", None), ("z", "MISSING_RIGHT", "correct", None)], schema)
    got = {r["k"]: r for r in E.violation_accuracy(detected, expected, quiet, ["k"]).collect()}
    x = got["x"]
    assert (x["true_positives"], x["false_positives"], x["false_negatives"], x["true_negatives"]) == (1, 3, 1, 1)
    assert x["accuracy"] == round(2 / 6, 4)
    assert got["y"]["accuracy"] == 0.0 and got["z"]["accuracy"] == 1.0
    listed = {r["k"]: r for r in E.violation_accuracy(detected, expected, quiet, ["k"], only_listed_types=True).collect()}
    assert listed["x"]["false_positives"] == 2


def test_precision_recall_and_lists(frame):
    detected = frame([("x", "Email"), ("x", "phone"), ("x", ""), ("n", "ssn")], "k string, type string")
    expected = frame([("x", "EMAIL"), ("x", "ssn"), ("x", "dob"), ("m", "ssn")], "k string, type string")
    matched = E.pii_type_sets(detected, expected, ["k"])
    got = {r["k"]: r for r in E.precision_recall(matched, ["k"]).collect()}
    assert (got["x"]["precision"], got["x"]["recall"], got["x"]["f1"]) == (0.5, 0.3333, 0.4)
    assert (got["n"]["precision"], got["n"]["recall"], got["n"]["f1"]) == (0.0, 0.0, 0.0)
    lists = {r["k"]: r for r in E.type_lists(matched, ["k"], "type").collect()}
    assert lists["x"]["missed"] == ["dob", "ssn"] and lists["x"]["extra"] == ["phone"] and lists["x"]["detected_list"] == ["email", "phone"]


def test_coverage(frame):
    expected = frame([("x", "access", True), ("x", "delete", False), ("x", "appeal", False), ("x", "Correct", True)], "k string, right string, covered boolean")
    found = frame([("x", "MISSING_RIGHT", "DELETE"), ("x", "MISSING_RIGHT", "correct"), ("x", "OTHER", "access")], "k string, type string, right string")
    checked = E.coverage_check(expected, found, ["k"])
    assert {r["right"]: r["correct"] for r in checked.collect()} == {"access": True, "delete": True, "appeal": False, "correct": False}
    row = E.coverage_score(checked, ["k"]).collect()[0]
    assert (row["correct"], row["total"], row["score"]) == (2, 6, 0.3333)


def test_classification_report(frame):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")] + [("b", "d")]
    got = {r["class"]: r for r in E.classification_report(frame(pairs, "label string, prediction string")).collect()}
    assert (got["a"]["precision"], got["a"]["recall"], got["a"]["f1"], got["a"]["support"]) == (0.75, 0.75, 0.75, 4)
    assert (got["c"]["precision"], got["c"]["f1"]) == (0.0, 0.0) and got["d"]["support"] == 0
    assert got["accuracy"]["f1"] == 0.625 and got["weighted avg"]["recall"] == 0.625


def test_stages(frame):
    df = frame([("x", True, 0.7, 0.7, 0.69, True, True, True), ("y", False, None, 0.9, 0.9, None, True, False)],
               "k string, has_rules boolean, pii_f1 double, violation_accuracy double, coverage_score double, has_appeal boolean, has_summary boolean, has_violations boolean")
    got = {(r["k"], r["stage"]): r["status"] for r in E.stage_status(df, ["k"]).collect()}
    assert got["x", "Data Forensics"] == "PASS" and got["x", "Compliance Auditor"] == "NEEDS_IMPROVEMENT"
    assert got["y", "Data Forensics"] == "NOT_EVALUATED" and got["y", "Compliance Auditor"] == "PASS"
    assert got["y", "Regulatory Analyst"] == "PARTIAL" and got["y", "Appeals Processor"] == "PARTIAL" and got["y", "Report Generator"] == "PARTIAL"


def test_ground_truth_validation(frame):
    full = '{"expected_violations": [], "expected_pii_types": [], "expected_rights_coverage": {}, "expected_compliance_status": "x"}'
    df = frame([(1, full), (2, '{"expected_violations": []}'), (3, "{}"), (4, "no json")], "i int, d string")
    got = {r["i"]: (r["is_valid"], r["message"]) for r in E.validate_ground_truth(df, "d").collect()}
    assert got[1] == (True, "Valid")
    assert got[2] == (False, "Missing required key: 'expected_pii_types'")
    assert got[3][1] == got[4][1] == "Missing required key: 'expected_violations'"
