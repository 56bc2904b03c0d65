import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from auditlark.functions import text as X
from auditlark.operators import policy as P
from auditlark.operators import violations as V
from auditlark.rulepack import DEFAULT_PACK, POLICY_RIGHTS

POLICY = """Shop privacy notice

1. WHAT WE KEEP
Contact details, birth dates and health-related data of club members are kept.

2. YOUR RIGHTS
(a) You may access the personal data that is being processed and confirm whether we hold it.
(b) You may correct inaccuracies in your personal data.

3. SAFETY
We protect data from unauthorized use.
"""


def words(text):
    found = [w[:5] for w in re.findall(r"\w{2,}", text.lower())]
    return Counter(found + [f"{a} {b}" for a, b in zip(found, found[1:])])


def paragraphs(text):
    parts = [p.strip() for p in re.split(X.PARAGRAPH_BREAK, text)]
    return [p for p in parts if len(p) >= 30] or [text]


class Tfidf:
    """Words and pairs, sublinear counts, smooth inverse paragraph frequencies, unit length."""

    def __init__(self, texts):
        every = [words(p) for t in texts for p in paragraphs(t)]
        self.n, self.df = len(every), Counter(w for p in every for w in p)

    def vector(self, text):
        weights = {w: (1 + math.log(k)) * (math.log((self.n + 1) / (self.df[w] + 1)) + 0.5) for w, k in words(text).items()}
        norm = math.sqrt(sum(x * x for x in weights.values())) or 1
        return {w: x / norm for w, x in weights.items()}

    def best(self, text, description):
        d = self.vector(description)
        return max([0.0] + [sum(x * d.get(w, 0) for w, x in self.vector(p).items()) for p in paragraphs(text)])


def random_policies(n):
    rng = random.Random(3)
    pieces = ["\n\n", "\n", " ", "\n1. ", "\nA) ", "\n## ", "\nSection ", "a", "été", "consumers have rights", "personal data", "  \n \n", "delete", "opt out.", "\t"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_paragraphs_agree_with_python(frame):
    texts = random_policies(200) + [POLICY, "", "short"]
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for r in df.select("i", X.paragraphs(F.col("text")).alias("p")).collect():
        assert r["p"] == paragraphs(texts[r["i"]])
    rows = P.paragraph_rows(df, ["i"], "text").collect()
    assert sorted((r["i"], r["para_no"]) for r in rows) == sorted((i, n) for i, t in enumerate(texts) for n in range(len(paragraphs(t))))


def test_scores_agree_with_brute_force(frame):
    texts = random_policies(60) + [POLICY]
    df = frame([(f"e{i % 20}", t) for i, t in enumerate(texts)], "entity string, text string")
    got = {(r["entity_id"], r["right"]): r["best_score"] for r in P.coverage_from_text(df, "entity", "text").collect()}
    tfidf = Tfidf(texts)
    for e in range(20):
        for right, description, _ in POLICY_RIGHTS:
            want = max(tfidf.best(t, description) for i, t in enumerate(texts) if i % 20 == e)
            assert abs(got[f"e{e}", right] - want) < 1e-12


def test_coverage_of_a_policy(frame):
    df = frame([("e", POLICY)], "entity string, text string")
    rows = {r["right"]: r for r in P.coverage_from_text(df, "entity", "text").collect()}
    assert {r for r, row in rows.items() if row["covered"]} == {"access", "correct"}
    missing = {r["right"]: r for r in P.missing_rights(P.coverage_from_text(df, "entity", "text")).collect()}
    assert set(missing) == {"delete", "portability", "opt-out", "appeal"}
    assert {r: missing[r]["severity"] for r in missing} == {"delete": "HIGH", "opt-out": "HIGH", "portability": "MEDIUM", "appeal": "MEDIUM"}
    for row in missing.values():
        assert row["confidence"] == round(1 - rows[row["right"]]["best_score"], 4)


LONG_POLICY = """NORTHWIND OUTFITTERS PRIVACY NOTICE
In force since: May 3, 2023

1. ABOUT THIS NOTICE
Northwind Outfitters ("we") values the trust of the people who shop with us.
This notice explains how personal data is gathered, used and shared.

2. WHAT WE GATHER
- Names, e-mail and postal addresses, phone numbers
- Birth dates
- Orders and payments
- Health-related data of members of the walking club
- Browser and device details

3. WHAT IT IS USED FOR
We use personal data for:
- Running and improving the shop
- Handling transactions
- Newsletters and promotions
- Statistics and profiling so that offers suit you
- Partners who deliver parcels

4. WHAT YOU CAN DO
(a) Access: You may ask whether your personal data is being processed, and request a copy of the personal data.
(b) Correction: If personal data is inaccurate, you may ask us to correct it.

5. HOW LONG WE KEEP IT
Records stay as long as these purposes or the law require.

6. SAFETY
Reasonable measures guard data against unauthorized access, loss or destruction.

7. CHILDREN
The shop is not meant for people under 16.

8. CHANGES
We may change this notice and will post the new one on our site.
"""


def test_coverage_of_a_long_policy_has_a_margin(frame):
    """Only access and correct are covered, at some distance from the right whose keyword is there by chance."""
    df = frame([("e", LONG_POLICY)], "entity string, text string")
    scores = {r["right"]: (r["best_score"], r["keyword_found"], r["covered"]) for r in P.coverage_from_text(df, "entity", "text").collect()}
    assert {r for r, (_, _, covered) in scores.items() if covered} == {"access", "correct"}
    with_keyword = {r: s for r, (s, found, _) in scores.items() if found}
    assert set(with_keyword) == {"access", "correct", "opt-out"}
    assert min(with_keyword["access"], with_keyword["correct"]) >= with_keyword["opt-out"] + 0.04
    assert all(s < DEFAULT_PACK.lexical_strong - 0.05 for r, (s, _, covered) in scores.items() if not covered)


def test_terms_beyond_the_table_are_left_out(frame):
    df = frame([("e", "alpha beta gamma delta " * 3), ("f", "alpha beta")], "entity string, text string")
    table = P.TermTable.count(df, "text", limit=1)
    own = {w for _, d, _ in POLICY_RIGHTS for w in words(d)}
    assert set(table.idf) == own | {"alpha"}
    assert P.TermTable.count(df.limit(0), "text").scores(F.lit("access")) is not None


def test_very_long_and_empty_policies(frame):
    df = frame([("a", None), ("b", ""), ("c", "personal data access " * 20_000), ("d", "\n\n")], "entity string, text string")
    rows = {(r["entity_id"], r["right"]): r["best_score"] for r in P.coverage_from_text(df, "entity", "text").collect()}
    assert len(rows) == 24 and all(rows[e, "access"] == 0.0 for e in "abd") and rows["c", "access"] > 0.2


def test_whole_policy_keyword_counts(frame):
    """The keyword may stand anywhere, even as part of another word."""
    rows = {r["right"]: r for r in P.coverage_from_text(frame([("e", "unauthorized ACCESSories")], "entity string, text string"), "entity", "text").collect()}
    assert rows["access"]["keyword_found"] and not rows["access"]["covered"]


def test_required_rights_per_entity(frame):
    coverage = P.coverage_from_text(frame([("a", "x"), ("b", "y")], "entity string, text string"), "entity", "text")
    required = frame([("a", "delete"), ("a", "appeal")], "entity_id string, right string")
    got = sorted((r["entity_id"], r["right"]) for r in P.missing_rights(coverage, required).collect())
    assert [r for e, r in got if e == "a"] == ["appeal", "delete"]
    assert len([r for e, r in got if e == "b"]) == 6


def test_threshold_edges(frame):
    scores = frame([("e", "access", 0.45), ("e", "correct", 0.25), ("e", "delete", 0.4499), ("e", "appeal", 0.2499)],
                   "entity_id string, right string, best_score double")
    policies = frame([("e", "please correct; appeal here")], "entity_id string, text string")
    rows = {r["right"]: r["covered"] for r in P.coverage_from_scores(scores, policies, "entity_id", "text").collect()}
    assert rows == {"access": True, "correct": True, "delete": False, "appeal": False}


def test_many_right_vectors_take_several_exact_passes(frame):
    rng = random.Random(5)
    vec = lambda: [rng.uniform(-1, 1) for _ in range(4)]
    vectors = [(f"e{i % 3}", vec()) for i in range(12)] + [("zero", [0.0] * 4)]
    rights = [(f"r{i}", vec()) for i in range(150)]
    got = {(r["entity_id"], r["right"]): r["best_score"] for r in P.best_vector_match(
        frame(vectors, "e string, v array<double>"), "e", "v", frame(rights, "r string, w array<double>"), "r", "w").collect()}
    cos = lambda a, b: 0.0 if not any(a) else sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))
    assert len(got) == 4 * 150
    for (e, r), score in got.items():
        want = max([0.0] + [cos(v, dict(rights)[r]) for name, v in vectors if name == e])
        assert abs(score - want) < 1e-9


def test_encoder_slot(frame):
    import pandas as pd

    out = P.encode(frame([("ab",), ("c",)], "text string"), "text", lambda: lambda s: pd.Series([[float(len(t))] for t in s])).collect()
    assert [r["vector"] for r in out] == [[2.0], [1.0]]


def test_appeal_quality(frame):
    rows = [("a", "You may APPEAL; see how to appeal below."), ("b", "We hear any dispute."), ("c", "none"), ("d", None), ("a2", "x"), ("a2", "appeal process")]
    got = {r["entity_id"]: r for r in P.appeal_quality(frame(rows, "e string, t string"), "e", "t").collect()}
    assert (got["a"]["quality"], got["a"]["matched_terms"], got["a"]["confidence"]) == ("DETAILED", ["appeal", "how to appeal"], 0.95)
    assert (got["b"]["quality"], got["b"]["has_appeal"], got["b"]["confidence"]) == ("BASIC", True, 0.75)
    assert (got["c"]["quality"], got["c"]["has_appeal"], got["c"]["confidence"]) == ("MISSING", False, 0.9)
    assert got["d"]["quality"] == "MISSING" and got["a2"]["quality"] == "DETAILED"


def test_undisclosed_data(frame):
    detected = frame([("a", "t1", "health_data"), ("a", "t1", "email"), ("a", "t1", "religious"), ("b", "t2", "health_data")],
                     "entity_id string, source string, type string")
    policies = frame([("a", "Health-related data"), ("a", "other page")], "e string, text string")
    got = {(r["entity_id"], r["data_category"], r["source_file"]) for r in V.undisclosed_data(detected, policies, "e", "text").collect()}
    assert got == {("a", "religious", "t1"), ("b", "health_data", "t2")}


def test_threshold_violations(frame):
    totals = frame([("a", 100000), ("b", 99999), ("c", 5), ("d", 5)], "entity_id string, total_unique_consumers bigint")
    rules = frame([("a", 100000, 0.95), ("b", 100000, 0.95), ("c", None, 0.3), ("d", 0, 0.3)], "entity_id string, value bigint, confidence double")
    rows = V.threshold_violations(totals, rules).collect()
    assert [r["entity_id"] for r in rows] == ["a"]
    assert rows[0]["description"].startswith("Business processes data of 100,000 unique consumers, exceeding the CTDPA threshold of 100,000.")


def test_pack_is_replaceable(frame):
    pack = DEFAULT_PACK.replace(disclosure_terms=(("email", ("mail",)),))
    detected = frame([("a", "t", "email")], "entity_id string, source string, type string")
    policies = frame([("a", "we store mail"), ("b", "no")], "e string, text string")
    assert V.undisclosed_data(detected, policies, "e", "text", pack).count() == 0


def test_more_appeal_terms_than_one_mask(frame):
    pack = P.DEFAULT_PACK.replace(appeal_terms=tuple(f"basic term {i:02d}" for i in range(62)), appeal_detail_terms=("submit an appeal",))
    df = frame([("a", "You may submit an appeal."), ("b", "see basic term 61"), ("c", "nothing")], "entity string, text string")
    got = {r["entity_id"]: (r["quality"], list(r["matched_terms"])) for r in P.appeal_quality(df, "entity", "text", pack).collect()}
    assert got == {"a": ("DETAILED", ["submit an appeal"]), "b": ("BASIC", ["basic term 61"]), "c": ("MISSING", [])}


def test_more_categories_than_one_mask(frame):
    pack = P.DEFAULT_PACK.replace(disclosure_terms=tuple((f"kind_{i:02d}", (f"word{i:02d}",)) for i in range(65)))
    policies = frame([("a", "word00 word63 WORD64")], "entity string, text string")
    detected = frame([("a", "f", f"kind_{i:02d}") for i in range(65)], "entity_id string, source string, type string")
    open_kinds = {r["data_category"] for r in V.undisclosed_data(detected, policies, "entity", "text", pack).collect()}
    assert open_kinds == {f"kind_{i:02d}" for i in range(65)} - {"kind_00", "kind_63", "kind_64"}


def test_paragraph_scores_match_the_column(frame):
    rows = [("a", "You may access your personal data.\n\nYou may correct inaccurate personal data we hold about you."), ("a", ""), ("b", None), ("b", "12 ! ?")]
    df = frame(rows, "entity string, text string")
    table = P.TermTable.count(df, "text")
    best = {}
    for r in df.select("entity", "text", table.scores(F.col("text")).alias("s")).collect():
        best[r.text] = r.s
    scored = table.paragraph_scores(P.paragraph_rows(df, ["text"], "text").withColumnRenamed("paragraph", "part").select("text", "part"), "part").collect()
    for text, expected in best.items():
        got = [max(x) for x in zip(*(r.scores for r in scored if r.text == text))]
        assert got == [] or max(abs(a - b) for a, b in zip(got, expected)) < 1e-12
    assert {r.text for r in scored} >= {rows[0][1], "12 ! ?"}
