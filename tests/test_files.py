"""Files of any layout in one scan, broken ones as rows; dates written in many ways."""

import datetime
import glob
import re
import shutil

import pytest
from pyspark.sql import functions as F

from auditlark.operators import forensics as FO
from auditlark.operators import sla
from auditlark.sources import files as FI
from auditlark.sources.requests import read_request_logs


@pytest.fixture
def csv_folder(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text('customer_id,email,zip\nC1,"a,x@b.org",06103\nC2,,06510\nC1\n\n')
    (folder / "b.csv").write_text('﻿id,"no ""te"\n1,"say ""hi"", you"\n')
    (folder / "bad.csv").write_text("a,b\n1,2\n1,2,3\n")
    (folder / "empty.csv").write_text("")
    (folder / "header only.csv").write_text("user_id,phone\n")
    (folder / "garbage.csv").write_bytes(bytes(range(256)) * 4)
    return str(folder)


def test_csv_files_of_any_header(spark, csv_folder):
    files = FI.read_csv_files(spark, csv_folder, expected=["a.csv", "none.csv"])
    status = {r.source: r for r in files.status.collect()}
    assert {s: r.error for s, r in status.items() if r.error} == {
        "bad.csv": "Could not read CSV: 1 malformed rows", "empty.csv": "Could not read CSV: no columns",
        "garbage.csv": "Could not read CSV: not a text file", "none.csv": "File not found"}
    assert status["a.csv"].header == ["customer_id", "email", "zip"] and status["b.csv"].header == ["id", 'no "te']
    assert (status["a.csv"].n_rows, status["a.csv"].n_bytes) == (3, 57) and status["bad.csv"].n_bad_rows == 1
    rows = {(r.source, tuple(r.cells)) for r in files.rows.collect()}
    assert rows == {("a.csv", ("C1", "a,x@b.org", "06103")), ("a.csv", ("C2", None, "06510")), ("a.csv", ("C1", None, None)), ("b.csv", ("1", 'say "hi", you'))}


def test_reports_of_files(spark, csv_folder):
    files = FI.read_csv_files(spark, csv_folder)
    report = {r.source.replace("%20", " "): r for r in FO.file_reports(files.rows, files.status).collect()}
    assert len(report) == 6
    assert (report["a.csv"].n_rows, report["a.csv"].n_cols, report["a.csv"].pii_detected, report["a.csv"].unique_consumers) == (3, 3, ["email"], 2)
    assert {(c.column, c.likely_pii_type) for c in report["a.csv"].column_pii} >= {("email", "email")}
    empty = report["header only.csv"]
    assert (empty.n_rows, empty.n_cols, empty.pii_detected, empty.unique_consumers, empty.error) == (0, 2, [], 0, None)
    assert report["bad.csv"].error and report["bad.csv"].n_rows is None
    assert not any("C1" in str(r) or "06103" in str(r) for r in report.values())


def test_broken_parquet_among_good_ones(spark, tmp_path):
    folder = tmp_path / "parquet"
    folder.mkdir()
    spark.range(1000).selectExpr("id", "cast(id as string) t").coalesce(1).write.parquet(f"{tmp_path}/one")
    spark.range(0).selectExpr("id", "cast(id as string) t").coalesce(1).write.parquet(f"{tmp_path}/none")
    whole = glob.glob(f"{tmp_path}/one/*.parquet")[0]
    shutil.copy(whole, folder / "good.parquet")
    shutil.copy(glob.glob(f"{tmp_path}/none/*.parquet")[0], folder / "zero.parquet")
    data = open(whole, "rb").read()
    (folder / "cut.parquet").write_bytes(data[:len(data) // 2])
    (folder / "pages.parquet").write_bytes(data[:100] + bytes(300) + data[400:])
    (folder / "text.parquet").write_text("no parquet")
    files = FI.read_parquet_files(spark, str(folder), "id long, t string", expected=["good.parquet", "gone.parquet"])
    assert {r.source: r.error for r in files.status.collect()} == {
        "good.parquet": None, "zero.parquet": None, "cut.parquet": "Could not read table: no footer", "text.parquet": "Could not read table: no footer",
        "pages.parquet": "Could not read table: pages are broken", "gone.parquet": "File not found"}
    assert {r.source: r["count"] for r in files.rows.groupBy("source").count().collect()} == {"good.parquet": 1000}
    assert files.rows.agg(F.sum("id")).first()[0] == 499_500


def test_logs_of_different_headers(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    (folder / "a.csv").write_text("id,Submitted,completed,response_date\n1,2024-01-01,2024-01-02,2024-03-01\n")      # rightmost response
    (folder / "b.csv").write_text(' DATE_RESPONDED ,request\n"Mar 5, 2024",01/02/2024\nsoon,01/02/2024\n')
    (folder / "c.csv").write_text("id,when\n1,2024-01-01\n")
    (folder / "d.csv").write_text("request,response\nx,y\n")
    (folder / "e.csv").write_text("request,response\n")
    logs = read_request_logs(spark, str(folder), expected=["f.csv"])
    rows = {r.entity_id: r for r in sla.log_summaries(logs.rows, logs.status).collect()}
    assert (rows["a.csv"].total_requests, rows["a.csv"].max_response_days, rows["a.csv"].error) == (1, 60, None)
    assert (rows["b.csv"].total_requests, rows["b.csv"].dropped_requests, rows["b.csv"].late_responses, rows["b.csv"].error) == (1, 1, 1, None)
    assert rows["c.csv"].error == "Could not identify date columns. Found: id, when"
    assert rows["d.csv"].error == rows["e.csv"].error == "No valid date pairs found in request log." and rows["f.csv"].error == "File not found"


DATES = {
    "2024-01-05": ("iso", (2024, 1, 5)), "2024-1-5": ("iso", (2024, 1, 5)), "2024-01-05T23:59:59": ("iso", (2024, 1, 5, 23, 59, 59)), "2024-01-05 07:00:00.5": ("iso", (2024, 1, 5, 7, 0, 0, 500_000)),
    "01/05/2024": ("month_first", (2024, 1, 5)), "1/5/2024": ("month_first", (2024, 1, 5)), "1/5/2024 7:30": ("month_first_time", (2024, 1, 5, 7, 30)), "25/12/2024": ("day_first", (2024, 12, 25)),
    "2024/1/5": ("year_slashes", (2024, 1, 5)), "5.1.2024": ("dots", (2024, 1, 5)), "20240105": ("compact", (2024, 1, 5)), "5-Jan-2024": ("day_name", (2024, 1, 5)), "05 Jan 2024": ("day_name", (2024, 1, 5)),
    "Jan 5, 2024": ("name_day", (2024, 1, 5)), "2024-02": ("year_month", (2024, 2, 1)), " 2024-01-05\t": ("iso", (2024, 1, 5)),
    "2024-02-30": None, "02/30/2024": None, "13/13/2024": None, "20241301": None, "n/a": None, "": None, None: None, "5": None, "2024-01-05x": None, "Foo 5, 2024": None,
}


def test_dates_by_a_list_of_formats(frame):
    got = {r.t: r.d for r in frame([(t,) for t in DATES], "t string").select("t", sla.read_date(F.col("t")).alias("d")).collect()}
    for text, expected in DATES.items():
        found = got[text] and (got[text].format, got[text].value)
        assert found == (expected and (expected[0], datetime.datetime(*expected[1]))), text


def test_ledger_counts_every_row_once(frame):
    rows = [("a", "2024-01-01", "2024-02-20"), ("a", None, "2024-02-20"), ("a", " ", None), ("a", "x", "2024-02-20"), ("a", "2024-01-01", ""), ("a", "2024-01-01", "y"), ("b", "1/1/2024", "20240101")]
    log = frame(rows, "e string, request string, response string")
    by_format = sla.date_ledger(log, ["e"]).collect()
    assert ("no request date", None, "iso", 1) in {tuple(r)[1:] for r in by_format} and ("valid", "month_first", "compact", 1) in {tuple(r)[1:] for r in by_format}
    ledger = {}
    for r in by_format:
        ledger[r.e, r.outcome] = ledger.get((r.e, r.outcome), 0) + r.n_rows
    assert ledger == {("a", "valid"): 1, ("a", "no request date"): 2, ("a", "unreadable request date"): 1, ("a", "no response date"): 1, ("a", "unreadable response date"): 1, ("b", "valid"): 1}
    summary = {r.entity_id: r for r in sla.sla_summary(log, "e").collect()}
    assert (summary["a"].total_requests, summary["a"].dropped_requests, summary["a"].late_responses) == (1, 5, 1)
    assert sla.valid_pairs(log).count() == 2


def test_other_packs_bring_other_formats(frame):
    pack = sla.DEFAULT_PACK.replace(date_formats=(("reversed", r"^\d\d-\d\d-\d{4}$", "dd-MM-yyyy"),))
    found = frame([("05-01-2024",), ("2024-01-05",)], "t string").select(sla.read_date(F.col("t"), pack).alias("d")).collect()
    assert [r.d and r.d.value for r in found] == [datetime.datetime(2024, 1, 5), None]
    assert re.match(pack.date_formats[0][1], "05-01-2024")


def test_large_tables_are_written_and_read_as_part_files(spark, frame, tmp_path):
    """Every task that has rows of a log or a table writes its own file; the status of a table counts all of them."""
    from auditlark.catalog.forensics import csv_file_reports
    from auditlark.catalog.requests import _write_logs

    folder = str(tmp_path / "in")
    n = spark.range(0, 90, 1, 3)
    name = F.concat(F.lit("n"), "id")
    n.selectExpr("id AS l_orderkey", "1L AS l_linenumber", "id AS l_partkey", "timestamp'2024-02-01' AS l_shipdate", "'A' AS l_returnflag").write.parquet(f"{folder}/lineitem.parquet")
    n.selectExpr("id AS o_orderkey", "timestamp'2024-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority").coalesce(1).write.parquet(f"{folder}/orders.parquet")
    n.select(F.col("id").alias("c_custkey"), name.alias("c_name"), F.lit(1).alias("c_nationkey"), F.lit(1.5).alias("c_acctbal"), F.lit("x").alias("c_mktsegment")).write.parquet(f"{folder}/customer.parquet")
    n.select(F.col("id").alias("s_suppkey"), name.alias("s_name"), F.lit(1).alias("s_nationkey"), F.lit(1.5).alias("s_acctbal")).write.parquet(f"{folder}/supplier.parquet")
    n.select(F.col("id").cast("int").alias("n_nationkey"), name.alias("n_name"), F.lit(1).alias("n_regionkey")).limit(0).write.parquet(f"{folder}/nation.parquet")
    n.selectExpr("id AS event_id", "timestamp'2024-01-01' AS ts", "id % 7 AS user_id", "'e' AS event_type", "1.0D AS value", "'{\"a\": 1, \"b\": \"c\"}' AS props").write.parquet(f"{folder}/events.parquet")
    n.selectExpr("id AS p_partkey", "1 AS p_size").write.parquet(f"{folder}/part.parquet")
    settings = {"spark.sql.files.openCostInBytes": str(128 * 1024 * 1024), "spark.sql.files.minPartitionNum": "3"}  # a task per file
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        logs = _write_logs(spark, folder)
        assert len(glob.glob(f"{logs.removeprefix('file:')}/1/*.csv")) == 3
        report = {r.source: r for r in csv_file_reports(spark, folder).collect()}
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert (report["customer"].n_rows, report["events"].unique_consumers, report["nation"].n_rows) == (90, 7, 0)
    assert report["part"].error == "Could not read CSV: 30 malformed rows" and report["region"].error == "File not found"
