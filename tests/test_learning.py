import math
import re
from collections import Counter

from pyspark.sql import functions as F

from auditlark.operators import evaluate as E
from auditlark.operators import ml as ML
from auditlark.operators import synth as S
from auditlark.operators.ranking import hash_rank, ordered_position, stratified_split


def test_ranks_are_exact_for_any_cell_size(frame):
    import hashlib

    rows = [(i, "hot" if i % 3 else "cold") for i in range(300)] + [(1000, None), (1001, None)]
    df = frame(rows, "id int, g string")
    want = {}
    for g in ("hot", "cold", None):
        members = sorted((hashlib.md5(f"{i}|42".encode()).hexdigest(), i) for i, k in rows if k == g)
        want.update({i: n + 1 for n, (_, i) in enumerate(members)})
    for digits in (1, 2, 4):
        got = {r["id"]: r["rank"] for r in hash_rank(df, "id", "g", prefix_digits=digits).collect()}
        assert got == want


def test_ordered_positions_in_groups_of_any_size(frame):
    import random

    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.7 else rng.choice(["a", None]), rng.choice(["x", "y", None]), i) for i in range(3000)]
    got = {r.i: r.position for r in ordered_position(frame(rows, "g string, k string, i int"), ["g"], ["k", "i"], ranges=8).collect()}
    for g in ("hot", "a", None):
        members = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or "", r[2]))
        assert [got[r[2]] for r in members] == list(range(1, len(members) + 1))
    assert len(got) == len(rows)
    assert ordered_position(frame([], "g string, k string, i int"), ["g"], ["k", "i"]).count() == 0
    assert [r.position for r in ordered_position(frame([("a", "x", 1)], "g string, k string, i int"), ["g"], ["k"]).collect()] == [1]


def test_split_keeps_proportions(frame):
    df = frame([(i, "a" if i < 100 else "b") for i in range(150)], "id int, label string")
    counts = {(r["label"], r["is_train"]): r["count"] for r in stratified_split(df, "id", "label").groupBy("label", "is_train").count().collect()}
    assert counts == {("a", True): 80, ("a", False): 20, ("b", True): 40, ("b", False): 10}


def test_tfidf_by_hand(frame):
    texts = ["Red fox jumps", "red red dog", "a fox, a DOG"]
    df = frame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    model = ML.tfidf_model(df)
    vocabulary = model.stages[3].vocabulary

    def terms(t):
        w = re.findall(r"\b\w\w+\b", t.lower())
        return Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])])

    seen = [terms(t) for t in texts]
    for r in model.transform(df).collect():
        raw = {t: n * (math.log(4 / (1 + sum(t in s for s in seen))) + 1) for t, n in seen[r["id"]].items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        got = {vocabulary[i]: v for i, v in zip(r["features"].indices, r["features"].values)}
        assert got.keys() == raw.keys() and all(abs(got[t] - raw[t] / norm) < 1e-9 for t in raw)


def test_top_terms_ties_are_alphabetical(frame):
    df = frame([("bb aa cc aa",)], "text string")
    assert ML.top_terms(df, 2) == ["aa", "aa cc"]


def test_classifier(spark, tmp_path):
    texts = S.labelled_texts(S.keys(spark, 450))
    assert texts.groupBy("label").count().where("count = 50").count() == 9
    path = str(tmp_path / "model")
    model, scored = ML.train_and_evaluate(texts, "id", path=path, max_iter=60)
    report = {r["class"]: r for r in E.classification_report(scored).collect()}
    assert report["accuracy"]["f1"] >= 0.95 and report["accuracy"]["support"] == 90
    again = ML.load_classifier(path)
    first = {r["id"]: r["prediction"] for r in scored.collect()}
    assert {r["id"]: r["prediction"] for r in again.transform(scored.select("id", "text")).collect()} == first
    hits = ML.model_detections(texts.withColumn("source", F.col("label")), ["source"], "text", again)
    kinds = {(r["source"], r["type"]) for r in hits.collect()}
    assert ("email", "email") in kinds and ("health_data", "health_data") in kinds
    assert not any(t == "clean" for _, t in kinds) and all(r["confidence"] > 0.5 for r in hits.collect())


def test_absent_model(frame, tmp_path):
    df = frame([("s", "text")], "source string, text string")
    assert ML.load_classifier(str(tmp_path / "none")) is None
    assert ML.model_detections(df, ["source"], "text", None).count() == 0


def examples(frame, n=240):
    texts = S.labelled_texts(frame([(i,) for i in range(n)], "id long"), "id")
    return texts.unionByName(frame([(n, None, ""), (n + 1, None, "name"), (n + 2, "1 2 3", None), (n + 3, "x", "name")], "id long, text string, label string").select(*texts.columns))


def test_coefficient_table_scores_like_the_model(frame):
    texts = examples(frame).where("label IS NOT NULL AND text IS NOT NULL")
    model = ML.train_classifier(texts, max_iter=40)
    table = ML.linear_probabilities(texts, "id", "text", ML.coefficient_table(model)).collect()
    names = ML.class_names(model)
    expected = {(r.id, names[k]): p for r in model.transform(texts).select("id", "probability").collect() for k, p in enumerate(r.probability)}
    got = {(r.id, r.label): r.probability for r in table}
    assert got.keys() == expected.keys()
    assert max(abs(got[k] - expected[k]) for k in got) < 1e-9


def test_closed_form_coefficients_by_hand(frame):
    rows = [(1, "red fox", "a"), (2, "red", "b"), (3, "red fox fox", "a"), (4, "", "b"), (5, None, None)]
    table = {(r.label, r.term): r for r in ML.term_weights(frame(rows, "id int, text string, label string")).collect()}
    terms = {"red": (3, 3), "fox": (3, 2), "red fox": (2, 2), "fox fox": (1, 1)}
    assert {t for _, t in table if t} == set(terms)
    counts = {("a", "red"): 2, ("a", "fox"): 3, ("a", "red fox"): 2, ("a", "fox fox"): 1, ("b", "red"): 1}
    for (label, term), row in table.items():
        if term is None:
            assert math.isclose(row.weight, math.log(0.5))
            continue
        total = sum(n for (c, _), n in counts.items() if c == label)
        assert math.isclose(row.weight, math.log((counts.get((label, term), 0) + 1) / (total + 4)))
        assert math.isclose(row.idf, math.log(5 / (terms[term][1] + 1)) + 1)


def test_probabilities_add_up_and_cut(frame):
    texts = examples(frame)
    coefficients = ML.term_weights(texts)
    found = ML.linear_probabilities(texts, "id", "text", coefficients)
    sums = {r.id: r["sum(probability)"] for r in found.groupBy("id").sum("probability").collect()}
    assert set(sums) == {r.id for r in texts.collect()} and all(abs(s - 1) < 1e-9 for s in sums.values())
    cut = ML.confident_classes(found, cut=0.5).collect()
    assert cut and all(r.label != "clean" and r.probability > 0.5 for r in cut)
    unknown = {r.label: r.probability for r in found.where("id = 242").collect()}  # no term is known: the shares of the classes
    shares = {r.label: r["count"] for r in texts.where("label IS NOT NULL").groupBy("label").count().collect()}
    assert all(math.isclose(unknown[c], n / sum(shares.values()), rel_tol=1e-9) for c, n in shares.items())


def test_a_fitted_model_expects_its_class_sizes(frame):
    texts = examples(frame).where("label IS NOT NULL AND text IS NOT NULL")
    for r in ML.calibration(ML.train_classifier(texts, max_iter=100, tolerance=1e-8), texts).collect():
        assert abs(r.expected_rows - r.n_rows) < 0.02 * r.n_rows


def test_split_moves_no_whole_rows(frame):
    df = frame([(i, "a" if i % 3 else None, "some text") for i in range(300)], "id int, label string, text string").repartition(3)
    split = stratified_split(df, "id", "label")
    got = {(r["label"], r["is_train"]): r["count"] for r in split.groupBy("label", "is_train").count().collect()}
    assert got == {("a", True): 160, ("a", False): 40, (None, True): 80, (None, False): 20}
    ranks = {r["id"]: r["rank"] for r in hash_rank(df, "id", "label").collect()}
    assert all(r["is_train"] == (ranks[r["id"]] <= (160 if r["label"] else 80)) for r in split.collect())
    joins = [line for line in split._jdf.queryExecution().executedPlan().toString().splitlines() if "SortMergeJoin" in line]
    assert not joins  # rows with their texts stay where they are read


def test_split_counts_repeated_keys(frame):
    df = frame([(i // 4, "a", f"t{i}") for i in range(100)] + [(None, "b", "x")] * 10, "id int, label string, text string")
    got = {(r["label"], r["is_train"]): r["count"] for r in stratified_split(df, "id", "label").groupBy("label", "is_train").count().collect()}
    assert got == {("a", True): 80, ("a", False): 20, ("b", True): 8, ("b", False): 2}


def test_terms_are_not_kept(frame, spark, monkeypatch):
    df = frame([(1, "red fox"), (2, "red dog")], "id int, text string")
    kept = []
    kind = type(df)
    monkeypatch.setattr(kind, "persist", lambda self, *a: kept.append(self) or self)
    assert ML.tfidf_model(df).stages[3].vocabulary == sorted(["red", "fox", "dog", "red fox", "red dog"])
    assert not kept


def test_scores_leave_one_row_per_text(frame):
    rows = [(1, "red fox", "a"), (2, "red", "b"), (3, "red fox fox", "a"), (4, "", "b"), (5, None, None)]
    df = frame(rows, "id int, text string, label string")
    plan = ML.linear_probabilities(df, "id", "text", ML.term_weights(df))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("MapInArrow")[1]  # terms meet the vocabulary where they are read
    only = frame([(7, "fox fox fox")], "id int, text string")
    weights = ML.term_weights(df).collect()
    w = {(r.label, r.term): r.weight for r in weights}
    got = {r.label: r.probability for r in ML.linear_probabilities(only, "id", "text", ML.term_weights(df)).collect()}
    idf = {r.term: r.idf for r in weights}
    n = {"fox": 3, "fox fox": 2}
    norm = math.sqrt(sum((k * idf[t]) ** 2 for t, k in n.items()))
    z = {c: w[c, None] + sum(k * idf[t] * w[c, t] for t, k in n.items()) / norm for c in "ab"}
    total = sum(math.exp(v) for v in z.values())
    assert all(abs(got[c] - math.exp(z[c]) / total) < 1e-9 for c in "ab")
