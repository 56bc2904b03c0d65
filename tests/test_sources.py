import datetime
import json

from pyspark.sql import functions as F

from auditlark.operators import forensics as FO
from auditlark.operators import report as RP
from auditlark.sources import documents as D
from auditlark.sources import reports as R
from auditlark.sources import tables as T


def test_read_tables_with_errors(spark, tmp_path):
    (tmp_path / "shop.csv").write_text("customer_id,email,zip\nC1,a@b.org,06103\nC2,,06510\n")
    (tmp_path / "bad.parquet").write_text("no parquet")
    tables, errors = T.read_tables(spark, [str(tmp_path / n) for n in ("shop.csv", "bad.parquet", "none.csv")])
    assert set(tables) == {"shop.csv"}
    assert [r["zip"] for r in tables["shop.csv"].collect()] == ["06103", "06510"]
    got = {r["source"]: r["error"] for r in errors.collect()}
    assert got["none.csv"] == "File not found" and got["bad.parquet"].startswith("Could not read table")
    report = errors
    for name, df in tables.items():
        report = report.unionByName(FO.table_report(df, name))
    assert report.count() == 3
    assert FO.total_consumers(report.withColumn("k", F.lit(1)), ["k"]).collect()[0]["total_unique_consumers"] == 2


def test_many_csv_in_one_scan(spark, tmp_path):
    for n in "ab":
        (tmp_path / f"{n}.csv").write_text(f"id,text\n1,{n}@x.org\n")
    df = T.read_many_csv(spark, str(tmp_path), "id string, text string")
    assert {r["source"]: r["pii_detected"] for r in FO.text_report(df, "text").collect()} == {"a.csv": ["email"], "b.csv": ["email"]}


def test_whole_documents_and_assembly(spark, tmp_path):
    (tmp_path / "b.txt").write_text("second\nline")
    (tmp_path / "a.txt").write_text("first")
    docs = D.read_documents(spark, str(tmp_path)).withColumn("entity", F.lit("e"))
    row = D.assemble(docs, "entity", "doc_id", "text").collect()
    assert len(row) == 1 and row[0]["text"] == "first\n\n--- Next Document ---\n\nsecond\nline" and row[0]["n_docs"] == 2


def test_ordered_documents(frame):
    docs = frame([("big", i, "x" * 50) for i in range(5)] + [("small", 1, "a"), ("small", 0, None)], "e string, n int, t string")
    rows = D.ordered_documents(docs, "e", "n", "t").collect()
    assert sorted((r["position"], r["text"]) for r in rows if r["entity_id"] == "small") == [(1, ""), (2, "a")]
    joined = {r["entity_id"]: r["text"] for r in D.assemble(docs, "e", "n", "t").collect()}
    assert joined["small"] == "\n\n--- Next Document ---\n\na" and joined["big"].count("x") == 250 + 4


def test_report_sink_and_source(spark, frame, tmp_path):
    when = datetime.datetime(2024, 5, 1, 10)
    df = frame([("e", when, "A", None), ("e", when + datetime.timedelta(days=1), "B", (1.5, "m"))],
               "entity_id string, generated_at timestamp, risk_grade string, _cost_summary struct<total_cost_usd:double,model:string>")
    R.write_reports(df, str(tmp_path / "out"))
    back = R.read_reports(spark, str(tmp_path / "out"), df.schema)
    costs = {r["risk_grade"]: tuple(r["_cost_summary"]) for r in back.collect()}
    assert costs == {"A": (0.0, "unknown"), "B": (1.5, "m")}
    assert RP.latest_reports(back, "entity_id", "generated_at").collect()[0]["risk_grade"] == "B"
    names = [r["file"] for r in R.saved_report_names(spark, str(tmp_path / "out")).collect() if r["file"].endswith(".json")]
    assert names == sorted(names, reverse=True) and names


def test_exports(spark, frame, tmp_path):
    scores = frame([("e", "FAIL", "C", "Moderate Risk", 30, 3)],
                   "entity_id string, overall_status string, risk_grade string, risk_label string, risk_score bigint, total_violations bigint")
    R.export_summary(scores, str(tmp_path / "md"))
    text = spark.read.text(str(tmp_path / "md"), wholetext=True).collect()[0]["value"]
    assert text.strip().splitlines() == ["## e", "- Status: FAIL", "- Risk grade: C (Moderate Risk)", "- Risk score: 30", "- Violations: 3"]
    R.export_violations(scores, str(tmp_path / "json"))
    lines = spark.read.text(str(tmp_path / "json")).collect()
    assert json.loads(lines[0]["value"])["risk_grade"] == "C"
    R.write_table(scores, str(tmp_path / "csv"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 1


def test_flatten_findings(frame):
    doc = {"pii_findings": {"details": [
        {"file": "a", "detection_details": [{"type": "email", "method": "regex", "count": 2, "confidence": 0.95}],
         "column_pii_indicators": [{"column": "mail", "likely_pii_type": "email"}]},
        {"file": "b", "error": "File not found"}]}}
    old = {"pii_detection_findings": {"pii_detected": {"ssn": {"count": 4, "confidence": 0.9}}}}
    df = frame([(1, json.dumps(doc)), (2, json.dumps(old)), (3, "{}")], "i int, d string")
    got = {(r["i"], r["kind"], r["file"], r["type"], r["count"]) for r in RP.flatten_findings(df, ["i"], "d").collect()}
    assert got == {(1, "detection", "a", "email", 2), (1, "column", "a", "email", None), (2, "map_entry", None, "ssn", 4)}
