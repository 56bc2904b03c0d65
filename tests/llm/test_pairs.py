"""Joins and near-duplicates against brute force."""

import math
import random

import numpy as np
import pytest

from auditlark.llm import components, embeddings, jaccard


def groups_of(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(7, 7), (None, 3)]
    found = components.components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()
    real = [(a, b) for a, b in pairs if a is not None and a != b]
    expected = groups_of(real, {x for p in real for x in p})
    assert {r.node: r.component for r in found} == expected


def shingle_set(text, n):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)])


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_similar_groups_equal_brute_force(spark, texts, awkward, n, percent):
    rng = random.Random(n)
    base = [" ".join(rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(rng.choice([4, 12, 40, 150, 400]))) for _ in range(25)]
    rows = list(awkward)
    for i in range(160):
        words = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 0, 1, 2, len(words) // 60 + 1, len(words) // 25 + 1])):
            words[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
        rows.append((100 + i, " ".join(words).upper() if i % 5 == 0 else " ".join(words)))
    found = jaccard.similar_groups(texts(rows), words=n, threshold=f"0.{percent // 10}").collect()
    sets = {d: shingle_set(t, n) for d, t in rows if d is not None}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    expected = groups_of(links, sets)
    assert sorted(r.doc_id for r in found) == sorted(sets)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {d: (len(s), expected[d]) for d, s in sets.items()}


def bound(x, y):
    a, b = (jaccard._bitmap(s) for s in (x, y))
    size = min(len(a), len(b))
    return jaccard._overlap_bound(jaccard._folded([a], size), jaccard._folded([b], size), np.array([len(x)]), np.array([len(y)]))[0]


def test_bitmap_bound_never_undercuts_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x = np.unique(rng.integers(0, 3000, rng.integers(1, 900)).astype("u8") * np.uint64(0x9E3779B97F4A7C15))
        y = np.unique(np.concatenate([rng.choice(x, len(x) // 2), rng.integers(0, 3000, rng.integers(1, 300)).astype("u8")]))
        assert bound(x, y) >= len(np.intersect1d(x, y))


@pytest.mark.parametrize("size", [100, 2500, 20_000])
def test_bitmaps_of_long_texts_tell_sets_apart(size):
    rng = np.random.default_rng(size)
    x = np.unique(rng.integers(0, 1 << 63, size).astype("u8"))
    for share, most in ((0.0, 0.65), (0.8, 0.85)):
        y = np.unique(np.concatenate([x[:int(share * size)], rng.integers(0, 1 << 63, size - int(share * size)).astype("u8")]))
        high = bound(x, y)
        assert len(np.intersect1d(x, y)) <= high <= most * size


def test_long_texts_and_a_group_of_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_ROWS", 16)  # several tiles on few rows
    rng = random.Random(9)
    long = [f"w{rng.randrange(10**6)}" for _ in range(5000)]
    short = [f"v{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(240):
        words = list(long if i < 20 else short if i < 100 else [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 200))])
        for _ in range(rng.choice([0, 2, 5, 8]) * len(words) // 250 if i < 100 else 0):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append(((i * 101) % 240, " ".join(words)))
    sets = {d: shingle_set(t, 3) for d, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 10 * len(sets[a] & sets[b]) >= 9 * len(sets[a] | sets[b])]
    expected = groups_of(links, sets)
    assert len(set(expected[d] for d, _ in rows[:100])) > 2 and len(links) > 200
    found = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == expected


def test_no_documents(spark):
    assert jaccard.similar_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(24).tolist()) for i in range(300)]
    for i in range(300, 700):
        near = np.array(rows[rng.integers(0, 40)][1])
        rows.append((i, (near + rng.standard_normal(24) * rng.choice([0.0, 0.05, 0.2, 0.3])).tolist()))
    rows += [(700, None), (701, []), (702, [0.0] * 24), (703, [1.0] * 23 + [math.nan]), (704, [math.inf] * 24), (705, [1.0] * 23 + [None]), (706, [1.0, 2.0]), (707, [2.0, 4.0]),
             (708, [-0.0] + [1.0] * 23), (709, [0.0] + [1.0] * 23), (710, [1e-200] * 24), (711, [1e200] * 24), (None, [1.0] * 24), (712, rows[0][1]), (712, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS label", "2 AS leaf", "3 AS rep")
    found = {r.vec_id: r for r in embeddings.near_duplicates(df, leaf_rows=64, trees=10).collect()}
    vectors = {i: np.array(v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    unit = {i: (v / np.abs(v).max()) / np.linalg.norm(v / np.abs(v).max()) for i, v in vectors.items()}
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    ids = {i for i, _ in rows if i is not None}
    expected = groups_of(links, ids)
    count = {i: 0 for i in ids}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    assert set(found) == ids
    right = sum(found[i].n_links == count[i] and found[i].component_id == expected[i] for i in ids)
    assert right >= 0.98 * len(ids) and all(found[i].n_links <= count[i] for i in ids)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    assert found[708].n_links >= 1 and found[710].component_id == found[711].component_id


def test_tiles_give_few_links_that_join_all_groups():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 24))
    rows = embeddings._unit(centres[rng.integers(0, 12, 500)] + rng.choice([0.02, 0.15, 0.4], (500, 1)) * rng.standard_normal((500, 24)))
    tiles = np.array_split(np.arange(500), 4)
    found = []
    for a in range(4):
        for b in range(a, 4):
            i, j = embeddings._spanning(rows[tiles[a]], None if a == b else rows[tiles[b]], 0.95)
            assert len(i) < len(tiles[a]) if a == b else len(i) <= 60  # a pair of linked groups, not of rows
            found += [(int(tiles[a][x]), int(tiles[b][y])) for x, y in zip(i, j)]
    near = [(a, b) for a, b in zip(*map(lambda x: x.tolist(), np.nonzero(rows @ rows.T >= 0.95))) if a < b]
    assert all(rows[a] @ rows[b] >= 0.95 - 1e-12 and a != b for a, b in found) and len(near) > 3 * len(found)
    assert groups_of(found, range(500)) == groups_of(near, range(500))
