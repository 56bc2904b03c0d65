import random
import re

import pytest
from pyspark.sql import functions as F

from auditlark.functions import text as X
from auditlark.operators import forensics as FO
from auditlark.rulepack import DEFAULT_PACK, PII_PATTERNS

ALPHABET = list("0123456789") * 4 + list("-./ ()+@_\n\tabé.com") + ["555-123-4567", "12/31/1999", "a.b@c.de", "10.0.0.1", " ", "4111 1111 1111 1111"]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_pattern_counts_agree_with_python(frame):
    texts = random_texts(600, 7)
    df = frame([(str(i), t) for i, t in enumerate(texts)], "source string, text string")
    rows = {r["source"]: r for r in FO.scan(df, F.col("text"), ["source"]).collect()}
    for i, text in enumerate(texts):
        for n, (_, pattern) in enumerate(PII_PATTERNS):
            assert rows[str(i)][f"p{n}"] == len(re.findall(pattern, text)), (pattern, text)


def test_row_flags_agree_with_python(frame):
    texts = random_texts(300, 8)
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for r in FO.row_flags(df, F.col("text")).collect():
        assert r["pii_types"] == [k for k, p in PII_PATTERNS if re.search(p, texts[r["i"]])]


def test_keyword_confidence_steps(frame):
    words = ["diagnosis", "treatment", "medical", "prescription", "patient"]
    rows = [(f"n{n}", " ".join(words[:n])) for n in (0, 1, 2, 3, 5)]
    scanned = FO.scan(frame(rows, "source string, text string"), F.col("text"), ["source"])
    got = {r["source"]: (r["confidence"], r["matched_terms"]) for r in FO.detections(scanned, ["source"]).collect()}
    assert {k: v[0] for k, v in got.items()} == {"n1": 0.65, "n2": 0.8, "n3": 0.9, "n5": 0.9}
    assert got["n2"][1] == ["diagnosis", "treatment"]


def test_terms_are_counted_once_over_all_rows(frame):
    df = frame([("s", "patient"), ("s", "PATIENT again"), ("s", "clinical"), ("s", None)], "source string, text string")
    row = FO.text_report(df, "text").collect()[0]
    assert row["n_rows"] == 4
    assert row["detection_details"][0]["matched_terms"] == ["patient", "clinical"]


def test_substring_by_default_and_word_option(frame):
    df = frame([("s", "leave no trace")], "source string, text string")
    assert FO.text_report(df, "text").collect()[0]["pii_detected"] == ["racial_ethnic"]
    assert FO.text_report(df, "text", word_boundary=True).collect()[0]["pii_detected"] == []
    whole = frame([("s", "race, or not")], "source string, text string")
    assert FO.text_report(whole, "text", word_boundary=True).collect()[0]["pii_detected"] == ["racial_ethnic"]


def test_best_per_type_and_ties(frame):
    found = frame([
        ("s", 0, "email", "regex", 2, None, 0.95), ("s", 14, "email", "ml_model", None, None, 0.99),
        ("s", 6, "health_data", "keyword", None, ["patient"], 0.65), ("s", 15, "health_data", "ml_model", None, None, 0.65),
        ("t", 20, "name", "ml_model", None, None, 0.7),
    ], "source string, ordinal int, type string, method string, count bigint, matched_terms array<string>, confidence double")
    best = {(r["source"], r["type"]): r for r in FO.best_per_type(found, ["source"]).collect()}
    assert best["s", "email"]["method"] == "ml_model" and best["s", "email"]["ordinal"] == 0
    assert best["s", "health_data"]["method"] == "keyword"
    summary = {r["source"]: r for r in FO.summarize(FO.best_per_type(found, ["source"]), ["source"]).collect()}
    assert summary["s"]["pii_detected"] == ["email", "health_data"]
    assert summary["s"]["average_confidence"] == round((0.99 + 0.65) / 2, 3)


def test_model_hits_compete_inside_the_report(frame):
    df = frame([("s", "mail a@b.org, patient")], "source string, text string")
    hits = frame([("s", 14, "email", "ml_model", None, None, 0.97), ("s", 15, "name", "ml_model", None, None, 0.6)],
                 "source string, ordinal int, type string, method string, count bigint, matched_terms array<string>, confidence double")
    row = FO.text_report(df, "text", model_hits=hits).collect()[0]
    assert [(d["type"], d["method"]) for d in row["detection_details"]] == [
        ("email", "ml_model"), ("health_data", "keyword"), ("name", "ml_model")]


def test_table_report(frame):
    df = frame([
        ("C1", "a@x.org", "555-123-4567", "asthma", 1234567890.0), ("C1", None, None, "diagnosis pending", None),
        (None, "b@x.org c@x.org", "none", "", 2.0),
    ], "customer_id string, email string, phone string, notes string, amount double")
    row = FO.table_report(df, "shop.csv").collect()[0]
    counts = {d["type"]: d["count"] for d in row["detection_details"]}
    assert counts["email"] == 3
    assert counts["phone"] == 2  # the plain digits of a large double count as in a CSV file
    assert row["unique_consumers"] == 1 and row["n_rows"] == 3 and row["n_cols"] == 5
    assert [(c["column"], c["likely_pii_type"]) for c in row["column_pii"]] == [("email", "email"), ("phone", "phone")]


def test_cells_do_not_join_unless_asked(frame):
    df = frame([("860", "555-1234")], "area string, number string")
    assert FO.table_report(df, "t").collect()[0]["pii_detected"] == []
    assert FO.table_report(df, "t", cell_separator=" ").collect()[0]["pii_detected"] == ["phone"]


def test_headers_option(frame):
    df = frame([("x",)], "religion string")
    assert FO.table_report(df, "t").collect()[0]["pii_detected"] == []
    assert FO.table_report(df, "t", include_headers=True).collect()[0]["pii_detected"] == ["religious"]


@pytest.mark.parametrize("name, kind", [
    ("l_shipdate", "ip_address"), ("ethnicity", "address"), ("email_address", "email"), (" First_Name ", "name"),
    ("Mobile", "phone"), ("dob", "dob"), ("amount", None),
])
def test_column_hints(frame, name, kind):
    assert frame([(name,)], "c string").select(X.column_hint(F.col("c")).alias("k")).collect()[0]["k"] == kind


def test_consumer_fallback_is_row_count(frame):
    df = frame([("s", 1), ("s", 1), ("s", None)], "source string, x int")
    assert FO.distinct_consumers(df, ["source"]).collect()[0]["unique_consumers"] == 3


def test_same_result_for_any_partitioning(frame):
    texts = random_texts(200, 9)
    df = frame([("s%d" % (i % 3), t) for i, t in enumerate(texts)], "source string, text string")
    one, many = [sorted(map(str, FO.text_report(df.repartition(n), "text").collect())) for n in (1, 8)]
    assert one == many


def test_column_scan_matches_whole_scan(frame):
    df = frame([("a@b.org", "x 10.1.1.1", i) for i in range(5)], "a string, b string, n int")
    got = {(r["column"], r["type"]): r["count"] for r in FO.column_scan(df, "t", columns_per_pass=2).collect()}
    assert got == {("a", "email"): 5, ("b", "ip_address"): 5}


def test_report_holds_no_personal_values(frame):
    values = ["jo@mail.org", "123-45-6789", "860-555-1234", "4111 1111 1111 1111", "10.20.30.40", "12/31/1980"]
    df = frame([("s", " ; ".join(values) + " diagnosis")], "source string, text string")
    shown = str(FO.without_values(FO.text_report(df, "text")).collect())
    for value in values:
        assert value not in shown
    assert not any(re.search(p, shown) for _, p in PII_PATTERNS)


def test_more_terms_than_one_mask(frame):
    terms = tuple(f"word{i:03d}" for i in range(130))
    pack = DEFAULT_PACK.replace(keywords=(("many", terms),))
    df = frame([("s", "word000 word059"), ("s", "word060 word129")], "source string, text string")
    row = FO.text_report(df, "text", pack=pack).collect()[0]
    assert row["detection_details"][0]["matched_terms"] == ["word000", "word059", "word060", "word129"]


def test_text_report_counts_consumers_by_the_id_column(frame):
    df = frame([("s", "x", "c1"), ("s", "y", "c1"), ("t", "z", None)], "source string, text string, customer_id string")
    assert {r["source"]: r["unique_consumers"] for r in FO.text_report(df, "text").collect()} == {"s": 1, "t": 0}


def test_reports_of_many_tables_equal_single_ones(frame):
    tables = {"a": frame([("c1", "mail x@y.org"), ("c1", "ssn 123-45-6789")], "customer_id string, note string"), "b": frame([(1, 2.5)], "n int, v double"), "c": frame([], "email string")}
    many = {r["source"]: r for r in FO.table_reports(tables).collect()}
    for name, df in tables.items():
        assert many[name] == FO.table_report(df, name).collect()[0]


def test_probe_passes_all_matches_and_few_plain_cells():
    plain = "18601\x0111063\x01102\x0138.0\x0182500.87\x010.07\x01A\x01F\x012000-12-24 00:00:00"
    for _, pattern in PII_PATTERNS[1:]:
        probe, start = DEFAULT_PACK.probe(pattern), DEFAULT_PACK.start(pattern)
        assert not re.search(probe, plain)
        for text in random_texts(1500, 11):
            assert not re.search(pattern, text) or re.search(probe, text), (pattern, text)
            assert re.findall(start + pattern, text) == re.findall(pattern, text)


def test_terms_of_short_long_and_odd_texts(spark, frame):
    terms = ["race", "dna", "geo-fence", "ción", "a.b", "@", "iris", "x y"]
    texts = ["", "trace", "DNA", "geo-fence ción", "a.b a_b @", "axb", "x  y", "\u0001iris\u0001", "z" * 900, "z" * 900 + "race dna", "\U0001f389 ción" * 100]
    pack = DEFAULT_PACK.replace(keywords=(("k", tuple(terms)),))
    scanned = FO.scan(frame(list(enumerate(texts)), "i int, text string"), F.col("text"), ["i"], pack)
    assert {r["i"]: r["m0"] for r in scanned.collect()} == {
        i: sum(1 << n for n, term in enumerate(terms) if term in t.lower()) for i, t in enumerate(texts)}
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
