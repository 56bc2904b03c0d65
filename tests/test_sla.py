import datetime

import pytest
from pyspark.sql import functions as F

from auditlark.functions import text as X
from auditlark.operators import sla
from auditlark.sources.requests import canonical_log


def log(frame, days, entity="e"):
    start = datetime.date(2024, 1, 1)
    return [(entity, "2024-01-01", (start + datetime.timedelta(days=d)).isoformat()) for d in days]


SCHEMA = "entity_id string, request_date string, response_date string"


def test_boundaries(frame):
    df = frame(log(frame, [45, 46, 90, 91, 0, -3]), SCHEMA)
    row = sla.sla_summary(df, "entity_id").collect()[0]
    assert (row["total_requests"], row["late_responses"], row["extreme_late_responses"]) == (6, 3, 1)
    assert row["max_response_days"] == 91
    assert row["late_percentage"] == 50.0
    assert row["average_response_days"] == round((45 + 46 + 90 + 91 - 3) / 6, 1)
    buckets = {r["bucket"]: r["n_requests"] for r in sla.sla_buckets(df, ["entity_id"]).collect()}
    assert buckets == {"on_time": 3, "late": 2, "very_late": 1}


def test_twelve_row_log(frame):
    days = [10, 20, 30, 44, 15, 25, 35, 40, 60, 75, 92, 107]
    row = sla.on_time_percent(sla.sla_summary(frame(log(frame, days), SCHEMA), "entity_id")).collect()[0]
    assert (row["total_requests"], row["late_responses"], row["extreme_late_responses"], row["max_response_days"]) == (12, 4, 2, 107)
    assert row["late_percentage"] == 33.3 and row["on_time_percentage"] == 66.7


def test_unreadable_dates(frame):
    rows = log(frame, [50]) + [("e", "soon", "2024-02-01"), ("e", None, "2024-02-01"), ("e", "2024-02-31", "2024-03-01"),
                               ("none", "n/a", ""), ("slash", "01/31/2024", "03/31/2024")]
    got = {r["entity_id"]: r for r in sla.sla_summary(frame(rows, SCHEMA), "entity_id").collect()}
    assert got["e"]["total_requests"] == 1 and got["e"]["error"] is None
    assert got["none"]["error"] == "No valid date pairs found in request log." and got["none"]["late_percentage"] is None
    assert got["slash"]["max_response_days"] == 60


def test_column_aliases():
    assert sla.resolve_date_columns(["Submitted ", "x", " COMPLETED"]) == ("Submitted ", " COMPLETED")
    assert sla.resolve_date_columns(["request", "request_date", "response"]) == ("request_date", "response")
    assert sla.resolve_date_columns(["a", "b"]) == (None, None)


def test_canonical_log(frame):
    df = frame([("r", "2024-01-01", "2024-01-03")], "id string, submitted string, date_responded string")
    assert canonical_log(df).columns == ["id", "request_date", "response_date"]
    with pytest.raises(ValueError, match="no pair of request and response dates"):
        canonical_log(df.select("id"))


def test_timestamps_floor(frame):
    df = frame([("2024-01-02 06:00:00", "2024-01-01 12:00:00"), ("2024-01-01 12:00:00", "2024-01-03 11:59:59")], "request string, response string")
    assert sorted(r["days"] for r in sla.response_days(df).collect()) == [-1, 1]


def test_status_option(frame):
    rows = [(*r, s) for r, s in zip(log(frame, [50, 60]), ["completed", "pending"])]
    df = frame(rows, SCHEMA + ", status string")
    assert sla.sla_summary(df, "entity_id").collect()[0]["total_requests"] == 2
    assert sla.sla_summary(df, "entity_id", statuses=["completed"]).collect()[0]["total_requests"] == 1


def test_violations(frame):
    summary = sla.sla_summary(frame(log(frame, [50, 95, 10], "a") + log(frame, [1], "b"), SCHEMA), "entity_id")
    appeals = frame([("a", "MISSING", 0.9), ("b", "BASIC", 0.75), ("c", "DETAILED", 0.95)], "entity_id string, quality string, confidence double")
    rows = {(r["entity_id"], r["type"]): r for r in sla.appeal_violations(appeals, summary).collect()}
    assert set(rows) == {("a", "CRITICAL_NO_APPEAL"), ("a", "LATE_RESPONSE"), ("a", "EXTREME_LATE_RESPONSE"), ("b", "WEAK_APPEAL_PROCESS")}
    late = rows["a", "LATE_RESPONSE"]
    assert late["description"] == "2 of 3 consumer requests exceeded the 45-day response limit."
    assert (late["late_count"], late["total_count"], late["late_percentage"]) == (2, 3, 66.7)
    assert rows["a", "EXTREME_LATE_RESPONSE"]["description"] == "1 requests exceeded even the extended 90-day limit (45 + 45 extension)."
    assert {r["type"] for r in sla.appeal_violations(appeals).collect()} == {"CRITICAL_NO_APPEAL", "WEAK_APPEAL_PROCESS"}


def test_no_time_zone_shifts_days(spark, frame):
    df = frame([("e", "2024-03-01", "2024-04-15"), ("e", "2024-10-01", "2024-11-16"), ("e", "2024-03-10 02:30:00", "2024-03-11 02:30:00")], SCHEMA)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "UTC", "Australia/Lord_Howe"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert sorted(r["days"] for r in sla.response_days(df).collect()) == [1, 45, 46]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_strip_takes_every_blank_without_a_pattern(frame):
    blanks = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = ["", " ", "a b", "".join(blanks), *(f"{b}a{b}b{b}\n" for b in blanks), "​a​", "᠎a", "\U0001f389 "]
    stripped = frame(list(enumerate(texts)), "i int, t string").select("i", X.strip(F.col("t")).alias("s"))
    assert {r.i: r.s for r in stripped.collect()} == {i: t.strip() for i, t in enumerate(texts)}
    log = frame([("2024-01-01", " 2024-02-01 ")], "request string, response string")
    found = sla.date_outcomes(log)
    assert [r.days for r in found.collect()] == [31] and found.columns[:2] == ["request", "response"]
    assert "regexp_replace" not in found._jdf.queryExecution().executedPlan().toString()
