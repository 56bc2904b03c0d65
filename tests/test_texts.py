import json
import random
import re
import struct

from pyspark.sql import functions as F

from auditlark.functions import jsontext as J
from auditlark.functions import numbers as N
from auditlark.functions import text as X
from auditlark.operators import report as RP


def test_rounding_agrees_with_python(frame):
    rng = random.Random(1)
    values = [2.675, 0.5, 1.5, 2.5, -2.5, 0.125, 1e-9, 18.65, 1234567.125, -0.00005] + [rng.uniform(-1e5, 1e5) for _ in range(500)]
    values += [v for v in (struct.unpack("d", rng.randbytes(8))[0] for _ in range(200)) if 1e-9 < abs(v) < 1e9]
    df = frame([(v,) for v in values], "v double")
    cols = [N.round_exact(F.col("v"), d).alias(f"r{d}") for d in (0, 1, 3, 4)]
    for r in df.select("v", *cols).collect():
        for d in (0, 1, 3, 4):
            assert r[f"r{d}"] == round(r["v"], d), (r["v"], d)


def expected_payload(text):
    """The first JSON value among: the whole text, the fenced blocks, what a decoder reads from the first brace, from the first bracket."""
    def reads(candidate):
        try:
            json.loads(candidate)
        except ValueError:
            return False
        return True

    def from_first(opening):
        at = text.find(opening)
        if at < 0:
            return []
        try:
            return [text[at:json.JSONDecoder().raw_decode(text, at)[1]]]
        except ValueError:
            return []

    fenced = [b.strip() for b in re.findall(J.FENCED_BLOCK, text)]
    return next((c for c in [text, *fenced, *from_first("{"), *from_first("[")] if reads(c)), None)


def test_json_payload(frame):
    rng = random.Random(2)
    pieces = ['{"a": 1}', "{", "}", "[1, 2]", "[", "]", "text ", "```json\n", "\n```", "```", '{"a": {"b": [1, {"c": "é"}]}}', "\n", " ", "null"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))) for _ in range(400)]
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("i", J.json_payload(F.col("t")).alias("p"), J.json_payload_or_text(F.col("t")).alias("q")).collect():
        want = expected_payload(texts[r["i"]])
        assert r["p"] == want, texts[r["i"]]
        assert r["q"] == (want if want is not None else texts[r["i"]])


def test_unwrap_json(frame):
    deep = {"k": [1]}
    for _ in range(7):
        deep = json.dumps(deep)
    df = frame([(1, deep), (2, '{"k": 1}'), (3, '"plain"'), (4, "[1]"), (5, "nope"), (6, json.dumps('"x'))], "i int, t string")
    got = {r["i"]: r["u"] for r in df.select("i", J.unwrap_json(F.col("t")).alias("u")).collect()}
    assert json.loads(got[1]) == {"k": [1]} and json.loads(got[2]) == {"k": 1}
    assert json.loads(got[3]) == {"raw": "plain"} and json.loads(got[4]) == [1]
    assert got[5] is None and json.loads(got[6]) == {"raw": '"x'}


def test_html_to_text(frame):
    html = '<html><style>p{}</style><script>var t="</p>";</script><!-- <b>x</b> --><p class="a">A &amp; B&nbsp;&lt;c&gt;</p>\n<br>d</html>'
    assert frame([(html,)], "h string").select(X.html_to_text(F.col("h")).alias("t")).collect()[0]["t"] == "A & B <c> d"


def test_narrative(frame):
    raw = ("# Report\nOverall: Non-Compliant\nGrade: **C**\n\nEXECUTIVE SUMMARY\n\nTwo *serious* gaps.\nOne more.\n\n"
           "VIOLATION 1: **No appeal** CRITICAL\nbody *text*\n\nviolation 2 High delay\n\nVIOLATION 3: small thing\nend")
    row = RP.parse_narratives(frame([("r", raw)], "id string, raw string"), ["id"], "raw").collect()[0]
    assert (row["status"], row["risk_grade"], row["summary"]) == ("NON_COMPLIANT", "C", "Two serious gaps.\nOne more.")
    assert [(v["type"], v["severity"]) for v in row["violations"]] == [
        ("No appeal CRITICAL", "CRITICAL"), ("High delay", "HIGH"), ("small thing", "MEDIUM")]
    assert row["violations"][0]["finding"] == "No appeal CRITICAL\nbody text"
    none = RP.parse_narratives(frame([("r", "hello")], "id string, raw string"), ["id"], "raw").collect()[0]
    assert (none["status"], none["risk_grade"], none["summary"], none["violations"]) == ("UNKNOWN", "?", "", [])


def test_number_words(frame):
    text = "One Hundred Thousand; one hundred; thirty five thousand; forty-five; SIXTY"
    got = frame([(text,)], "t string").select(X.number_words_to_digits(F.col("t")).alias("d")).collect()[0]["d"]
    assert got == "100000; 100; 35000; 45; 60"


def test_saved_report_layouts(frame):
    newer = {"executive_summary": {"overall_compliance_status": "X", "risk_grade": "B"}, "violations_summary": {"total_violations": 3, "critical": 1}}
    older = {"executive_summary": {"overall_status": "FAIL", "risk_assessment": {"grade": "D", "label": "High Risk"}, "total_violations": 2, "high_violations": 1}}
    df = frame([(1, json.dumps(newer)), (2, json.dumps(older)), (3, "{}")], "i int, d string")
    got = {r["i"]: r for r in RP.report_fields(df, ["i"], "d").collect()}
    assert (got[1]["status"], got[1]["risk_grade"], got[1]["total_violations"], got[1]["critical"], got[1]["model"]) == ("X", "B", 3, 1, "unknown")
    assert (got[2]["status"], got[2]["risk_grade"], got[2]["risk_level"], got[2]["high"]) == ("FAIL", "D", "High Risk", 1)
    assert (got[3]["status"], got[3]["risk_grade"], got[3]["total_cost_usd"]) == (None, "?", 0.0)
