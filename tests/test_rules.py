import pytest

from auditlark.operators import rules as R


def extract(frame, *texts):
    df = frame([("c", i, t) for i, t in enumerate(texts)], "corpus string, doc int, text string")
    return R.extract_rules(df, "corpus", "doc", "text").collect()[0]


@pytest.mark.parametrize("text, value, confidence", [
    ("personal data of one hundred thousand\nor more", 100000, 0.95),
    ("at least 100,000 consumers", 100000, 0.95),
    ("NOT LESS THAN\n100.000 people", 100000, 0.95),
    ("thirty-five thousand consumers", 35000, 0.90),
    ("derives revenue from the sale of personal data of 35,000", 35000, 0.90),
    ("derives revenue from the sale\nof personal data of 35,000", None, 0.3),
    ("nothing here", None, 0.3),
])
def test_threshold(frame, text, value, confidence):
    row = extract(frame, text)["threshold"]
    assert (row["value"], row["confidence"]) == (value, confidence)
    assert (row["note"] is None) == (value is not None)


def test_higher_level_wins_over_documents(frame):
    assert extract(frame, "35,000 consumers", "100000 consumers")["threshold"]["value"] == 100000


def test_rights_evidence_and_confidence(frame):
    three = extract(frame, "The right to ACCESS and the right to delete.", "data portability and a portable format")
    assert three["consumer_rights"]["rights"] == ["access", "delete", "portability"]
    assert three["consumer_rights"]["evidence"] == {"access": "right to access", "delete": "right to delete", "portability": "portable"}
    assert three["consumer_rights"]["confidence"] == 0.6
    four = extract(frame, "right to access, right to delete, portable", "may opt-out")
    assert four["consumer_rights"]["confidence"] == 0.85


def test_categories_and_exemptions(frame):
    row = extract(frame, "Biometric Data and genetic data", "a GLBA financial institution or a State Agency")
    assert row["sensitive_data"]["categories"] == ["biometric data", "genetic data"]
    assert row["sensitive_data"]["confidence"] == 0.9
    assert row["exemption_rules"]["exemptions"] == {"glba": True, "government": True}
    assert extract(frame, "x")["sensitive_data"]["confidence"] == 0.4


def test_timelines(frame):
    row = extract(frame, "forty-five days to respond to a request", "sixty days to cure", "30 calendar days for an appeal")
    assert row["timeline_rules"]["timelines"] == {
        "consumer_request_response_days": 45, "cure_period_days": 60, "appeal_response_days": 30}
    assert row["timeline_rules"]["confidence"] == 0.8 and row["timeline_rules"]["response_days_source"] is None


def test_later_pattern_replaces_earlier_and_first_document_counts(frame):
    row = extract(frame, "20 days to respond", "30 days to respond", "without undue delay, within 40 days", "without undue delay in 50 days")
    assert row["timeline_rules"]["timelines"]["consumer_request_response_days"] == 40
    assert extract(frame, "20 days to respond", "30 days to respond")["timeline_rules"]["timelines"]["consumer_request_response_days"] == 20


def test_default_timeline_counts_its_mark(frame):
    row = extract(frame, "no periods")["timeline_rules"]
    assert row["timelines"] == {"consumer_request_response_days": 45}
    assert row["response_days_source"] == "CTDPA default" and row["confidence"] == 0.8
    found = extract(frame, "ninety days to respond")["timeline_rules"]
    assert found["timelines"] == {"consumer_request_response_days": 90} and found["confidence"] == 0.5


def test_null_text_and_metadata(frame):
    df = frame([("c", 1, "abc", "f1"), ("c", 2, None, "f2"), ("c", 3, "de", "f1")], "corpus string, doc int, text string, file string")
    row = R.extract_rules(df, "corpus", "doc", "text").collect()[0]
    assert (row["n_docs"], row["total_text_length"]) == (3, 5)
    files = {r["file"]: r for r in R.file_metadata(df, "file", "text").collect()}
    assert (files["f1"]["pages"], files["f1"]["chars_extracted"], files["f1"]["error"]) == (2, 5, None)
    assert files["f2"]["error"]
