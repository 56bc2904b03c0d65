"""Hard negatives and whitening against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditlark.llm import hardneg, queries, whitening

AWKWARD = [(9001, None, 1), (9002, [], 1), (9003, [1.0, None], 1), (9004, [math.nan, 1.0], 2), (9005, [math.inf, 0.5], 2), (9006, [0.25, 0.5], None),
           (None, [0.25, 0.5], 1), (9050, [0.0, 0.0], 1), (9051, [1e30, 0.0], 1)]


def brute_negatives(rows, is_anchor, k_pos=5, k_neg=3):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(c is None or not math.isfinite(c) or abs(c) >= 1 << 18 for c in v):
            continue
        own = (str(label), [math.floor(256 * c) for c in v])
        kept[i] = min(kept.get(i, own), own)
    out = set()
    for a, (label, x) in kept.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), b, other == label) for b, (other, y) in kept.items() if b != a and len(y) == len(x))
        for score, b, _ in [s for s in scored if s[2]][:k_pos]:
            fits = [(s, c) for s, c, same in scored if not same and -50 * score <= -100 * s <= -95 * score][:k_neg]
            out.update((a, b, rank + 1, c, -score, -s) for rank, (s, c) in enumerate(fits))
    return out


@pytest.mark.parametrize("kind", ["apart", "tight", "hot"])
def test_hard_negatives_equal_brute_force(spark, kind):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, 6))
    rows = []
    for i in range(900):
        v = centres[i % 6] + rng.standard_normal(6) * (0.05 if kind == "tight" else 0.8)
        if kind == "hot" and i % 3 == 0:
            v = centres[0]
        rows.append((i, [float(c) for c in v], int(rng.integers(0, 3))))
    rows += [rows[7], (8, [1.0] * 6, 0)] + [(i, v and v + [0.0] * 4 if v and i != 9006 else v, label) for i, v, label in AWKWARD]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS q", "2 AS leaf", "'z' AS x", "3 AS place")
    found = hardneg.mine(df, F.col("vec_id") % 50 == 0, leaf_rows=32, arity=4)
    assert dict(found.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got))
    expected = brute_negatives(rows, lambda i: i % 50 == 0)
    assert set(got) == expected and expected


def test_tree_eliminates_and_loses_nothing():
    rng = np.random.default_rng(1)
    rows = np.floor(256 * np.concatenate([c + 0.1 * rng.standard_normal((400, 3)) for c in 4 * rng.standard_normal((8, 3))])).astype("i8")
    tree = hardneg.Tree(rows[::7], int((rows * rows).sum(1).max()), 0.02, 4, 3)
    lifted = tree.lifted(rows)
    tree.store([dict(zip(("node", "i", "j", "low", "high"), r)) for r in tree.ranges(lifted)])
    home, queries_ = tree.home(lifted), rows[::50]
    scores = queries_ @ rows.T
    low, high = np.quantile(scores, 0.9, axis=1)[:, None], np.quantile(scores, 0.97, axis=1)[:, None]
    reached = {(leaf, q) for leaf, members, _ in tree.reached(queries_, low, high) for q in members.tolist()}
    needed = {(int(home[r]), q) for q in range(len(queries_)) for r in np.flatnonzero((scores[q] >= low[q]) & (scores[q] <= high[q]))}
    assert needed <= reached and len(reached) < 0.5 * tree.leaves * len(queries_)


def test_no_rows_for_negatives(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hardneg.mine(empty, F.col("vec_id") % 50 == 0).collect() == []
    one = spark.createDataFrame([(50, [1.0], 1), (51, [1.0], 2)], "vec_id long, embedding array<float>, label int")
    assert hardneg.mine(one, F.col("vec_id") % 50 == 0).collect() == []


def test_query_of_hard_negatives(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)], rng.randrange(10)) for i in range(300)] + [(350, None, 1), (351, [0.0] * 4, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    read = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{tmp_path}/embeddings.parquet").collect()]
    moved = [(i, v, None if label is None else (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in read]
    assert {tuple(r) for r in queries.op11_hard_negatives(spark, str(tmp_path)).collect()} == brute_negatives(moved, lambda i: i % 50 == 0)


def whitened_by_numpy(rows, most):
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) and abs(c) < 1 << 42 for c in v)]
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in usable], dtype=object)
    n, sums = len(x), x.sum(0)
    centred = ((n * x - sums) / n).astype("f8")
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    return [i for i, _ in usable], n, ((n * x - sums) ** 2).sum(1), centred @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def check_whitening(found, rows, most):
    ids, n, deviation, whitened, explained = whitened_by_numpy(rows, most)
    by_row = {(r.vec_id, r.component): r for r in found}
    assert len(found) == len(by_row) == len(ids) * most
    for k in range(most):
        mine = np.array([by_row[i, k + 1].whitened for i in ids])
        sign = np.sign(mine @ whitened[:, k])
        assert np.abs(sign * mine - whitened[:, k]).max() < 1e-8
        assert abs(by_row[ids[0], k + 1].explained / explained[k] - 1) < 1e-10
    assert [by_row[i, 1].deviation for i in ids] == deviation.tolist()
    assert {r.n for r in found} == {n} and max(r.identity_error for r in found) < 1e-10


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(8)
    spread = rng.standard_normal((12, 12)) * np.geomspace(1, 1e-2, 12)
    rows = [(i, (rng.standard_normal(12) @ spread).tolist()) for i in range(400)]
    awkward = [(500, None), (501, [1.0] * 11 + [None]), (502, [math.nan] * 12), (503, [math.inf] * 12), (504, [1e13] * 12), (505, [])]
    df = spark.createDataFrame(rows + awkward, "vec_id long, embedding array<double>").selectExpr("*", "1 AS n", "2 AS id", "'a' AS x", "0D AS whitened")
    check_whitening(whitening.whiten(df).collect(), rows, 8)


def test_whitening_of_few_and_equal_rows(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()

    assert run([]) == [] and run([(1, [1.0, 2.0])]) == [] and run([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])]) == []
    flat = [(i, [float(i % 5), 2.0 * (i % 5), 7.0]) for i in range(20)]  # one direction only
    found = run(flat)
    assert len(found) == 20 and {r.component for r in found} == {1} and abs(found[0].explained - 1) < 1e-12 and found[0].identity_error < 1e-12
    both = [(i, [float(i), float(i * i)]) for i in range(9)] + [(i, [float(i % 4)]) for i in range(9, 15)]  # each length by itself
    found = run(both)
    assert {(r.n, r.component) for r in found} == {(9, 1), (9, 2), (6, 1)}


def test_deviations_that_fit_no_long_are_null(spark):
    rows = [(i, [float((1 << 41) * (i % 2)), float(i)]) for i in range(2000)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), most=1).collect()
    assert len(found) == 2000 and {r.deviation for r in found} == {None}


def test_query_of_whitening(spark, tmp_path):
    rng = np.random.default_rng(9)
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(10) * np.arange(1, 11)]) for i in range(150)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    check_whitening(queries.op13_embedding_whitening(spark, str(tmp_path)).collect(), rows, 8)
