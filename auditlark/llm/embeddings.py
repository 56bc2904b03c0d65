"""Near-duplicate embeddings: a forest of random-projection trees with spill overlap.

1. Equal vectors are one class; a class takes part once.
2. *Trees.* Each inner node splits by a random direction at the median of a bounded sample. Vectors
   closer to the split than half the width that a pair at the threshold has along a random direction go both ways
   (spill), so near pairs part rarely; every tree draws other directions. Every class is routed through every tree.
3. *Leaves.* Within a leaf cosines are computed in double precision. A leaf gives the links of a spanning forest
   of its linked vectors, never all pairs. A leaf with more than ``leaf_rows`` vectors is cut into row tiles, and each pair
   of tiles is compared by itself, so no task holds a large leaf. A tile gives one link for each row at most, two tiles those between their groups.
4. *Union.* The links of all trees join into components.
5. *Count.* In each component, again in pairs of row tiles, every vector's links are counted exactly.

A vector that is null, empty, zero, or holds null or non-finite components links with nothing, and so do vectors of different length. Of rows that share
an id the smallest vector counts; rows without id are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlark.llm import store
from auditlark.llm.batches import small_batches
from auditlark.llm.components import components
from auditlark.llm.samples import uniform

SAMPLE_VALUES = 4_000_000


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaling by the largest component first keeps extreme ones from over- or underflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column) -> np.ndarray:
    values = _one(column)
    return values.flatten().to_numpy(zero_copy_only=False).astype("f8").reshape(len(values), -1)


def _one(column) -> pa.Array:
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


class Tree:
    """Random splits fitted on a sample; ``route`` gives the leaves of every row."""

    def __init__(self, sample: np.ndarray, leaf_share: float, margin: float, seed: int):
        self.rng, self.margin, self.nodes = np.random.default_rng(seed), margin, []
        self._grow(sample, leaf_share * len(sample))

    def _grow(self, rows: np.ndarray, least: float) -> int:
        at = len(self.nodes)
        self.nodes.append(None)
        if len(rows) <= max(least, 16):
            return at
        direction = self.rng.standard_normal(rows.shape[1])
        direction /= np.sqrt(direction @ direction)
        along = rows @ direction
        split = float(np.median(along))
        left, right = rows[along <= split + self.margin], rows[along > split - self.margin]
        if max(len(left), len(right)) > 0.95 * len(rows):  # nothing to part: the whole node lies within the spill
            return at
        self.nodes[at] = (direction, split, self._grow(left, least), self._grow(right, least))
        return at

    def route(self, rows: np.ndarray):
        todo = [(0, np.arange(len(rows)))]
        while todo:
            at, members = todo.pop()
            if not len(members):
                continue
            if self.nodes[at] is None:
                yield at, members
                continue
            direction, split, left, right = self.nodes[at]
            along = rows[members] @ direction
            todo.append((left, members[along <= split + self.margin]))
            todo.append((right, members[along > split - self.margin]))


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a symmetric matrix of links: each row's group, and the links (two arrays) of a tree over every group, found level by level."""
    np.fill_diagonal(near, False)
    group = np.arange(len(near))
    rest = near.any(axis=1)
    ends, starts = [], []
    for root in np.flatnonzero(rest):
        if not rest[root]:
            continue
        rest[root] = False
        level = np.array([root])
        while len(level):
            linked = near[level] & rest
            reached = np.flatnonzero(linked.any(axis=0))
            starts.append(level[linked[:, reached].argmax(axis=0)])
            ends.append(reached)
            rest[reached] = False
            group[reached] = root
            level = reached
    none = [np.zeros(0, "i8")]
    return group, np.concatenate(none + starts), np.concatenate(none + ends)


def _spanning(own: np.ndarray, other: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all linked vectors of one tile; of two tiles only those that join their groups, as each tile gives the links within it."""
    group, starts, ends = _forest(own @ own.T >= threshold)
    if other is None:
        return starts, ends
    others, _, _ = _forest(other @ other.T >= threshold)
    i, j = np.nonzero(own @ other.T >= threshold)
    _, first = np.unique(group[i] * len(other) + others[j], return_index=True)  # one link for two groups
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for k in first:
        if (a := root(int(group[i[k]]))) != (b := root(len(own) + int(others[j[k]]))):
            parent[a] = b
            kept.append(k)
    return i[kept], j[kept]


def _leaf_links(group: pa.Table, threshold: float) -> pa.Table:
    ids, tile, i, j = (group.column(k).to_numpy() for k in ("rep", "tile", "i", "j"))
    rows = _unit(_matrix(group.column("vector")))
    own, other = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
    starts, ends = _spanning(rows[own], None if i[0] == j[0] else rows[other], threshold)
    return pa.table({"a": pa.array(ids[own[starts]], pa.int64()), "b": pa.array(ids[other[ends]], pa.int64())})


def _larger(batches, most: int):
    """Batches of ``most`` rows and more: a tree visits its nodes for every batch, so small ones cost its size each."""
    held = []
    for batch in filter(len, batches):
        held.append(batch)
        if sum(map(len, held)) >= most:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _count_links(group: pa.Table, threshold: float) -> pa.Table:
    """Per vector of a pair of tiles the linked vectors of the other tile, classes counted with all their members."""
    ids, tile, i, j, size = (group.column(k).to_numpy() for k in ("rep", "tile", "i", "j", "members"))
    rows = _unit(_matrix(group.column("vector")))
    own, other = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
    n = np.zeros(len(ids), "i8")
    for low in range(0, len(own), 256):
        part = own[low:low + 256]
        near = rows[part] @ rows[other].T >= threshold
        near &= part[:, None] != other[None, :]
        n[part] += near @ size[other]
        if i[0] != j[0]:
            n[other] += near.T @ size[part]
    return pa.table({"rep": ids, "n": n})


def _in_tiles(rows: DataFrame, keys: list[str], tile_rows: int) -> DataFrame:
    """Every row once for each pair of row tiles it belongs to, so that all pairs of a group meet in bounded pieces."""
    sizes = store.written(rows.groupBy(*keys).agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles")).where("tiles > 1"), "large_groups")
    cut = rows.join(sizes, keys, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    cut = cut.withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return cut.withColumn("i", F.least("tile", "other")).withColumn("j", F.greatest("tile", "other")).drop("other", "tiles")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, trees: int = 8,
                    leaf_rows: int = 512, sample_rows: int = 20_000, spill: float = 0.5, seed: int = 3) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` of every id.

    Trees are fitted on at most ``sample_rows`` classes (fewer for long vectors: four million values), all classes are routed. ``spill`` is the overlap
    on either side of a split, as a share of the typical width of a pair at the threshold.
    """
    values = F.col(vector_col).cast("array<double>")
    rows = small_batches(vectors).select(F.col(id_col).cast("long").alias("id"), values.alias("vector")).where("id IS NOT NULL")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce((F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = rows.select("id", F.when(usable, F.transform("vector", lambda x: x + F.lit(0.0))).alias("vector"))  # -0.0 becomes 0.0
    ids = rows.groupBy("id").agg(F.min(F.struct(F.col("vector").isNull().alias("none"), "vector")).alias("v")).select("id", "v.vector")
    ids = store.written(ids, "vectors")
    classes = store.written(ids.where("vector IS NOT NULL").groupBy("vector").agg(F.min("id").alias("rep"), F.count("*").alias("members")), "vector_classes")

    shapes = {r[0]: r[1] for r in classes.groupBy(F.size("vector")).count().collect()}
    links = None
    for dim, n in sorted(shapes.items()):
        own = classes.where(F.size("vector") == dim)
        bound = max(2, min(sample_rows, SAMPLE_VALUES // dim))
        sample = own.where(uniform("rep", seed) < bound / n).select("vector").limit(bound).toArrow()
        if not sample.num_rows:
            sample = own.select("vector").limit(bound).toArrow()
        sample = _unit(_matrix(sample.column("vector")))
        margin = spill * np.sqrt(max(0.0, 2 - 2 * threshold) / dim)
        forest = [Tree(sample, min(1.0, leaf_rows / n), margin, seed * 1000 + k) for k in range(trees)]
        shared = classes.sparkSession.sparkContext.broadcast(forest)  # as large as the sample allows

        def route(batches, shared=shared, most=max(1, SAMPLE_VALUES // 4 // dim)):
            for batch in _larger(batches, most):
                unit = _unit(_matrix(batch.column(1)))
                for k, tree in enumerate(shared.value):
                    for leaf, members in tree.route(unit):
                        where = pa.array(members)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(members), k << 32 | leaf)), *(_one(batch.column(c).take(where)) for c in (0, 1))], names=["leaf", "rep", "vector"])

        placed = own.select("rep", "vector").mapInArrow(route, "leaf long, rep long, vector array<double>")
        tiled = _in_tiles(store.written(placed.select("leaf", "rep"), "leaves"), ["leaf"], leaf_rows).join(own.select("rep", "vector"), "rep")
        found = tiled.groupBy("leaf", "i", "j").applyInArrow(lambda g: _leaf_links(g, threshold), "a long, b long").distinct()
        links = found if links is None else links.unionByName(found)
    spark = vectors.sparkSession
    if links is None:
        links = spark.createDataFrame([], "a long, b long")
    groups = store.written(components(links, "a", "b").select(F.col("node").alias("rep"), "component"), "vector_groups")

    tiled = _in_tiles(groups.select("component", "rep"), ["component"], leaf_rows).join(classes, "rep")
    counted = tiled.groupBy("component", "i", "j").applyInArrow(lambda g: _count_links(g, threshold), "rep long, n long")
    counted = counted.groupBy("rep").agg(F.sum("n").alias("n"))
    per_class = classes.join(counted, "rep", "left").join(groups, "rep", "left").select(
        "vector", (F.coalesce("n", F.lit(0)) + F.col("members") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    per_class = store.written(per_class, "vector_results")  # a plain table on this side lets a common vector's rows be split
    out = ids.join(per_class, "vector", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col(id_col) == F.col("component_id"))
