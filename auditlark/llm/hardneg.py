"""Hard negatives by exact window search in a GNAT-style multiway hyperplane tree.

For every anchor: its best rows of the same label (positives), and for each of them the best rows of other labels whose score lies in a window below the
positive's score. A score is the inner product of vectors of whole numbers, exact.

1. *Classes.* Rows with equal vector and label score alike with every anchor and are ordered by id. Only the first ``positives + 1`` of a class can be
   in a result (one may be the anchor itself), so a class takes part once, with that many ids; anchors of one class share one search.
2. *Metric.* With one more coordinate, sqrt(M - |x|^2) for M the largest squared length, all rows are equally long, and a
   query with 0 there has the distance sqrt(|q|^2 + M - 2 score): a window of scores is an annulus of distances.
3. *Tree.* Each inner node has up to ``arity`` split points far from one another and sends a row to the nearest, so the hyperplanes between split points
   bound the subtrees. Split points come from a bounded sample; all rows go down the tree, and each split point stores the
   smallest and largest distance to the rows of every sibling subtree, over all rows.
4. *Search.* A sibling is eliminated where its range does not meet the annulus around a split point that the triangle inequality allows.
   The first search of a query looks into its own leaf, which narrows its window; the second into all leaves that are left.
5. *Exact leaves.* Leaves are cut into tiles of rows and queries into blocks; each tile and block that meet are one task's matrix product, and each gives at
   most as many candidates per query as the result needs. No task holds a leaf, and no pairs are written.

The tree is broadcast: at most ``sample_rows`` points and, per inner node, ``arity`` squared ranges.

Rows with a null id, a null label, a vector that is null, empty, or holds a null, non-finite or huge component (2 ** 18 and more) take no part; vectors meet only
those of their own length. Of rows that share an id the one with the smallest label, then vector, counts. Anchors without a positive, and positives
without a negative in their window, give no rows, and neither does an empty table. Other columns are ignored.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlark.llm import store
from auditlark.llm.batches import small_batches
from auditlark.llm.samples import uniform

SAMPLE_VALUES = 4_000_000
QUERY_BLOCK = 4096
WINDOWS = "array<struct<p:long,low:long,high:long>>"


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where no sum can pass 2 ** 53, else in 64-bit integers."""
    if a.shape[1] * max(1, int(np.abs(a).max(initial=0))) * max(1, int(np.abs(b).max(initial=0))) < 1 << 53:
        return (a.astype("f8") @ b.astype("f8").T).astype("i8")
    return a @ b.T


@dataclasses.dataclass
class Node:
    points: np.ndarray                 # split points with their additional coordinate
    children: list[int]                # numbers of inner nodes, or of leaves as -1 - leaf
    nearest: np.ndarray | None = None  # [i, j]: smallest distance of split point i to a row of subtree j
    farthest: np.ndarray | None = None


class Tree:
    """Split points fitted on a sample of vectors of whole numbers; ``largest`` is the largest squared length of all rows."""

    def __init__(self, sample: np.ndarray, largest: int, leaf_share: float, arity: int, seed: int):
        self.largest, self.arity, self.nodes, self.leaves = float(largest), arity, [], 0
        self.slack = 1e-6 * max(1.0, largest) ** 0.5  # far above the rounding of a distance
        self.rng = np.random.default_rng(seed)
        self._grow(self.lifted(sample), max(leaf_share * len(sample), 2 * arity))

    def lifted(self, x: np.ndarray) -> np.ndarray:
        x = x.astype("f8")
        return np.column_stack([x, np.sqrt(np.maximum(0.0, self.largest - (x * x).sum(1)))])

    @staticmethod
    def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)))

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _grow(self, rows: np.ndarray, least: float) -> int:
        if len(rows) <= least:
            return self._leaf()
        some = rows[self.rng.choice(len(rows), min(len(rows), 3 * self.arity), replace=False)]
        chosen, apart = [0], self.distances(some, some[:1])[:, 0]
        while len(chosen) < self.arity and apart.max() > self.slack:  # each the farthest from those before
            chosen.append(int(apart.argmax()))
            apart = np.minimum(apart, self.distances(some, some[chosen[-1:]])[:, 0])
        if len(chosen) < 2:
            return self._leaf()
        at = len(self.nodes)
        self.nodes.append(Node(some[chosen], []))
        own = self.distances(rows, some[chosen]).argmin(1)
        self.nodes[at].children = [self._grow(rows[own == j], least) for j in range(len(chosen))]
        return at

    def walk(self, lifted: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray | None, np.ndarray | None]]:
        """For every inner node its rows, their distances to its split points and the child of each; for every leaf its rows."""
        todo = [(0 if self.nodes else -1, np.arange(len(lifted)))]
        while todo:
            at, members = todo.pop()
            if not len(members):
                continue
            if at < 0:
                yield at, members, None, None
                continue
            node = self.nodes[at]
            apart = self.distances(lifted[members], node.points)
            own = apart.argmin(1)
            yield at, members, apart, own
            todo.extend((child, members[own == j]) for j, child in enumerate(node.children))

    def home(self, lifted: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(lifted), "i4")
        for at, members, apart, _ in self.walk(lifted):
            if apart is None:
                leaf[members] = -1 - at
        return leaf

    def ranges(self, lifted: np.ndarray) -> Iterator[tuple[int, int, int, float, float]]:
        """``(node, split point, subtree, smallest, largest distance)`` over the given rows."""
        for at, _, apart, own in self.walk(lifted):
            if apart is not None:
                for j in range(apart.shape[1]):
                    inside = apart[own == j]
                    if len(inside):
                        for i, (low, high) in enumerate(zip(inside.min(0), inside.max(0))):
                            yield at, i, j, float(low), float(high)

    def store(self, found: list) -> None:
        for node in self.nodes:
            shape = (len(node.points), len(node.points))
            node.nearest, node.farthest = np.full(shape, np.inf), np.full(shape, -np.inf)
        for r in found:
            self.nodes[r["node"]].nearest[r["i"], r["j"]] = r["low"]
            self.nodes[r["node"]].farthest[r["i"], r["j"]] = r["high"]

    def annuli(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner and outer radius for windows of scores, an array (query, window) each."""
        both = ((queries * queries).sum(1) + self.largest)[:, None]
        return np.sqrt(np.maximum(0.0, both - 2 * high)) - self.slack, np.sqrt(np.maximum(0.0, both - 2 * low)) + self.slack

    def reached(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(leaf, queries, alive)`` of all leaves not eliminated; ``alive`` tells which windows of each query may have rows there. A missing
        window has ``low`` above ``high``."""
        queries = np.column_stack([queries.astype("f8"), np.zeros(len(queries))])
        inner, outer = self.annuli(queries, low, high)
        todo = [(0 if self.nodes else -1, np.arange(len(queries)), low <= high)]
        while todo:
            at, members, alive = todo.pop()
            some = alive.any(1)
            members, alive = members[some], alive[some]
            if not len(members):
                continue
            if at < 0:
                yield -1 - at, members, alive
                continue
            node = self.nodes[at]
            apart = self.distances(queries[members], node.points)
            for j, child in enumerate(node.children):
                left = alive.copy()
                for i in range(len(node.points)):
                    d = apart[:, i, None]
                    least = np.maximum(np.maximum(d - outer[members], inner[members] - d), 0.0) - self.slack
                    left &= (node.farthest[i, j] >= least) & (node.nearest[i, j] <= d + outer[members] + self.slack)
                todo.append((child, members, left))


def _per_query(batch: pa.RecordBatch, place: int) -> tuple[np.ndarray, np.ndarray, list]:
    """Windows of a batch of queries as arrays (query, window), filled with an impossible window."""
    windows = batch.column(place).to_pylist()
    width = max((len(w) for w in windows), default=0)
    low, high = np.full((len(windows), width), 1.0), np.full((len(windows), width), 0.0)
    for k, listed in enumerate(windows):
        for c, w in enumerate(listed):
            low[k, c], high[k, c] = w["low"], w["high"]
    return low, high, windows


def _first(scores: np.ndarray, classes: np.ndarray, ids: list[np.ndarray], most: int) -> list[tuple[int, int]]:
    """The first ``most`` ``(id, score)`` of some classes of a tile, higher scores first, then smaller ids."""
    if len(classes) > most:  # every class has one id at least
        classes = classes[scores[classes] >= np.partition(scores[classes], -most)[-most]]
    if not len(classes):
        return []
    found = np.concatenate([ids[c] for c in classes])
    of = np.repeat(scores[classes], [len(ids[c]) for c in classes])
    order = np.lexsort((found, -of))[:most]
    return list(zip(found[order].tolist(), of[order].tolist()))


def _compare(rows: pa.Table, queries: pa.Table, same: bool, most: int) -> pa.Table:
    """Per query and window of a block the first ``most`` rows of a tile with the same label, or another one."""
    out = ([], [], [], [])
    if rows.num_rows and queries.num_rows:
        numbers: dict[str, int] = {}
        label, wanted = (np.array([numbers.setdefault(v, len(numbers)) for v in t.column("label").to_pylist()]) for t in (rows, queries))
        ids = [np.array(v, "i8") for v in rows.column("ids").to_pylist()]
        fits = {v: np.flatnonzero((label == v) == same) for v in set(wanted.tolist())}
        scores = _scores(_matrix(queries.column("x")), _matrix(rows.column("x")))
        for k, (q, windows) in enumerate(zip(queries.column("q").to_pylist(), queries.column("windows").to_pylist())):
            own = fits[wanted[k]]
            s = scores[k][own]
            for w in windows:
                inside = own[(s >= w["low"]) & (s <= w["high"])]
                for found, score in _first(scores[k], inside, ids, most):
                    for column, value in zip(out, (q, w["p"], found, score)):
                        column.append(value)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("q", "p", "id", "score"), out)})


class Index:
    """The rows of one vector length in the leaves of a tree, written by leaf and tile."""

    def __init__(self, classes: DataFrame, n: int, dim: int, leaf_rows: int, sample_rows: int, arity: int, seed: int):
        spark = classes.sparkSession
        bound = max(2, min(sample_rows, SAMPLE_VALUES // dim))
        sample = classes.where(uniform("q", seed) < bound / n).select("x").limit(bound).toArrow()
        if not sample.num_rows:
            sample = classes.select("x").limit(bound).toArrow()
        largest = classes.agg(F.max(F.aggregate("x", F.lit(0).cast("long"), lambda s, v: s + v * v))).first()[0]
        tree = Tree(_matrix(sample.column("x")), largest, min(1.0, leaf_rows / n), arity, seed)
        plain = spark.sparkContext.broadcast(tree)

        def ranges(batches):
            best: dict = {}
            for batch in batches:
                for node, i, j, low, high in plain.value.ranges(plain.value.lifted(_matrix(batch.column(0)))):
                    a, b = best.get((node, i, j), (np.inf, -np.inf))
                    best[node, i, j] = min(a, low), max(b, high)
            rows = [(*key, *both) for key, both in best.items()]
            yield pa.RecordBatch.from_pylist([dict(zip(("node", "i", "j", "low", "high"), r)) for r in rows], schema=pa.schema(
                [("node", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("low", pa.float64()), ("high", pa.float64())]))

        measured = classes.select("x").mapInArrow(ranges, "node int, i int, j int, low double, high double")
        tree.store(measured.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect())  # arity ** 2 per inner node
        self.tree = spark.sparkContext.broadcast(tree)

        def place(batches):
            for batch in batches:
                leaf = plain.value.home(plain.value.lifted(_matrix(batch.column(3))))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], names=["leaf", "q", "label", "ids", "x"])

        placed = store.written(classes.select("q", "label", "ids", "x").mapInArrow(place, "leaf int, q long, label string, ids array<long>, x array<long>"), "leaves")
        sizes = placed.groupBy("leaf").agg(F.ceil(F.count("*") / (4 * leaf_rows)).cast("int").alias("tiles"))  # as many rows as the tree has leaves
        self.sizes = store.written(sizes, "leaf_sizes")
        self.rows = placed.join(F.broadcast(self.sizes), "leaf").withColumn("tile", F.pmod(F.xxhash64("q"), F.col("tiles")).cast("int")).drop("tiles", "q")

    def search(self, queries: DataFrame, blocks: int, same: bool, most: int, own_leaf: bool) -> DataFrame:
        """``(q, p, id, score)``: the first ``most`` rows in every window of ``queries (q, label, x, windows)``, found in a query's own leaf
        or in all others. Windows reach to any other leaf that is not eliminated."""
        shared = self.tree

        def pairs(batches):
            tree = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _matrix(batch.column(2))
                home = tree.home(tree.lifted(x))
                low, high, windows = _per_query(batch, 3)
                if own_leaf:
                    reached = ((int(leaf), np.flatnonzero(home == leaf), None) for leaf in np.unique(home))
                else:
                    reached = ((leaf, members, alive) for leaf, members, alive in tree.reached(x, low, high))
                for leaf, members, alive in reached:
                    if alive is None:
                        listed = [windows[k] for k in members]
                    else:
                        elsewhere = home[members] != leaf
                        members, alive = members[elsewhere], alive[elsewhere]
                        listed = [[w for w, a in zip(windows[k], alive[c]) if a] for c, k in enumerate(members)]
                    if len(members):
                        part = batch.take(pa.array(members))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(members), leaf, "i4")), *part.columns[:3], pa.array(listed, batch.column(3).type)], names=["leaf", "q", "label", "x", "windows"])

        met = queries.select("q", "label", "x", "windows").mapInArrow(pairs, f"leaf int, q long, label string, x array<long>, windows {WINDOWS}")
        met = met.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int"))
        met = store.written(met, "met_leaves")
        rows = self.rows.join(met.select("leaf", "block").distinct(), "leaf")
        met = met.join(F.broadcast(self.sizes), "leaf").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).drop("tiles")
        keys = ["leaf", "tile", "block"]
        met = met.select(*(F.col(c).alias(f"to_{c}") for c in keys), "q", "label", "x", "windows")  # other names: both sides stem from one table
        return rows.groupBy(*keys).cogroup(met.groupBy(*(f"to_{c}" for c in keys))).applyInArrow(lambda r, q: _compare(r, q, same, most), "q long, p long, id long, score long")


def _best(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("q", "p").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def _narrowed(queries: DataFrame, found: DataFrame, most: int) -> DataFrame:
    """``queries`` whose windows begin at the score of the ``most``-th row found so far."""
    least = found.where(F.col("place") == most).groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("p", "score"))).alias("least"))
    windows = F.transform("windows", lambda w: F.struct(w["p"].alias("p"), F.greatest(w["low"], F.try_element_at("least", w["p"])).alias("low"), w["high"].alias("high")))
    return queries.join(least, "q", "left").withColumn("windows", windows).drop("least")


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", positives: int = 5,
         negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256, leaf_rows: int = 1024, sample_rows: int = 20_000, arity: int = 8,
         seed: int = 11) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components become ``floor(scale * x)``. ``is_anchor`` is a condition on the columns of ``vectors``. A negative's score is from ``low`` to ``high`` per cent
    of the positive's. ``leaf_rows`` is the aim for a leaf of the tree; a tile has four times as many rows at most, on average.
    """
    plain = small_batches(vectors).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    usable = (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float(1 << 18)))  # false for NaN, which counts as largest
    plain = plain.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(usable, F.lit(False)))
    plain = plain.select("id", "label", "anchor", F.transform("v", lambda c: F.floor(c * scale).cast("long")).alias("x"))
    rows = plain.groupBy("id").agg(F.min(F.struct("label", "x", "anchor")).alias("r")).select("id", "r.*")
    rows = store.written(rows, "labelled_vectors")
    most = max(positives + 1, negatives)
    in_class = Window.partitionBy("x", "label").orderBy("id")
    classes = rows.select("id", "label", "x").withColumn("place", F.row_number().over(in_class)).where(F.col("place") <= most)
    classes = classes.groupBy("x", "label").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("q", F.get("ids", F.lit(0)))
    classes = store.written(classes, "vector_classes")
    anchors = rows.where("anchor").join(classes.select("x", "label", "q"), ["x", "label"]).select("id", "q")
    anchors = store.written(anchors, "anchors")
    queries = store.written(classes.join(anchors.select("q").distinct(), "q", "left_semi").select("q", "label", "x"), "queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    every = F.array(F.struct(F.lit(0).cast("long").alias("p"), F.lit(-(1 << 62)).alias("low"), F.lit(1 << 62).alias("high")))
    found = None
    for dim, n in sorted((r[0], r[1]) for r in classes.groupBy(F.size("x")).count().collect()):
        own = queries.where(F.size("x") == dim)
        if own.isEmpty():
            continue
        index = Index(classes.where(F.size("x") == dim), n, dim, leaf_rows, sample_rows, arity, seed)

        def nearest(asked: DataFrame, same: bool, wanted: int, index=index) -> DataFrame:
            near = store.written(_best(index.search(asked, blocks, same, wanted, own_leaf=True), wanted), "found_near")
            rest = index.search(_narrowed(asked, near, wanted), blocks, same, wanted, own_leaf=False)
            return store.written(_best(near.drop("place").unionByName(rest), wanted), "found")

        best = nearest(own.withColumn("windows", every), True, positives + 1).select("q", "id", "score", "place")
        window = F.struct(F.col("score").alias("p"), F.ceil(F.col("score") * low / 100).alias("low"), F.floor(F.col("score") * high / 100).alias("high"))
        listed = best.select("q", window.alias("w")).where("w.low <= w.high").groupBy("q").agg(F.collect_set("w").cast(WINDOWS).alias("windows"))
        worst = nearest(own.join(listed, "q"), False, negatives)

        # One row per query class: its positives in order, each with its negatives.
        with_negatives = worst.groupBy("q", "p").agg(F.sort_array(F.collect_list(F.struct("place", F.col("id").alias("negative"), F.col("score").alias("s")))).alias("negatives"))
        answers = best.join(with_negatives.withColumnRenamed("p", "score"), ["q", "score"], "left")
        answers = answers.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score", "negatives"))).alias("answers"))
        found = answers if found is None else found.unionByName(answers)
    if found is None:
        return vectors.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    others = F.slice(F.filter("answers", lambda a: a["id"] != F.col("anchor_id")), 1, positives)
    out = anchors.select(F.col("id").alias("anchor_id"), "q").join(store.written(found, "answers"), "q")
    out = out.select("anchor_id", F.explode(others).alias("a"))
    out = out.select("anchor_id", F.col("a.id").alias("positive_id"), F.col("a.score").alias("positive_score"), F.explode("a.negatives").alias("n"))
    return out.select("anchor_id", "positive_id", F.col("n.place").cast("int").alias("rank"), F.col("n.negative").alias("negative_id"),
                      "positive_score", F.col("n.s").alias("negative_score"))
