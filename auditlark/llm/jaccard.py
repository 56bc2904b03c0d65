"""Joins texts whose word shingles have a high Jaccard similarity, exactly.

Equal sets are one class from the start. For the others:

1. *Size bands.* Similar sets have similar sizes, so a set only meets its own band and the ones beside it:
   two neighbouring bands are a tile. In a tile two similar sets differ in at most ``d`` shingles. The shingle universe is dealt by hash into more
   than ``d`` parts, so similar sets agree wholly in some, and the hash of such a part's shingles is a key both have. No similar pair
   is missed, and unrelated texts that merely share a passage almost never get a common key.
2. *Bitmaps.* Each set has a bitmap of its shingles' parities, two to four bits a shingle whatever its size. A bit in which two bitmaps
   differ stems from a shingle that only one set has, so bit counts bound the overlap from above. Longer bitmaps fold onto shorter ones.
3. *Stars.* In each key every set is paired with one pivot; of the pairs whose bitmaps allow the threshold each set has one verified, and
   links join components. The first pivot is a key's smallest set, later ones are drawn anew in the keys that still hold several components.
4. *Tiles.* In the keys that then still hold several components, the largest component and the other sets are cut into tiles of rows. The
   others meet one another and the largest component, which does not meet itself; pairs of different components that pass the bitmaps remain.
5. Remaining pairs are verified by intersecting the sorted shingle arrays; only sets of such pairs are built again.

Linked sets of one component need no further comparison, so a group of thousands of copies costs
one comparison per member and star instead of all pairs.

Words are runs of non-blank characters, A-Z lower-cased. Shingles are 64-bit hashes of word runs; a
text with fewer words has one shingle of all its words; a null text or one without words has the empty set and links
with nothing. Of rows that share an id the one with most shingles counts (of equal counts, the largest digest); rows
without id are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlark.llm import store
from auditlark.llm.batches import small_batches
from auditlark.llm.components import components

BITMAP_BITS = 128     # at least
STARS = 3
TILE_ROWS = 256
KNOWN_WORDS = 150_000

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


class _Shingler:
    """Sorted distinct 64-bit shingle hashes of texts."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        known, found = self.known, []
        for word in (text or "").encode().lower().split():
            h = known.get(word)
            if h is None:
                h = known[word] = xxhash.xxh3_64_intdigest(word)
            found.append(h)
        if len(known) > KNOWN_WORDS:
            known.clear()
        w = np.array(found, "u8")
        if not len(w):
            return w
        n = min(self.words, len(w))
        state = np.full(len(w) - n + 1, n, "u8")
        for i in range(n):
            state = _mix(state * _M2 + w[i:len(w) - n + 1 + i])
        return np.unique(state)


class Bands:
    """Size bands for a threshold, and how many shingles similar sets of two bands can differ in."""

    def __init__(self, threshold: Fraction):
        self.t, self.tops = threshold, [1]

    def of(self, size: int) -> int:
        while self.tops[-1] < size:
            self.tops.append(max(self.tops[-1] + 1, math.floor(self.tops[-1] / self.t)))
        low, high = 0, len(self.tops) - 1
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if self.tops[mid] < size else (low, mid)
        return low

    def differing(self, low: int, high: int) -> int:
        """Largest symmetric difference of similar sets, one of each band."""
        a, b = self.tops[low], self.tops[high]
        return math.floor((1 - self.t) / (1 + self.t) * (a + b))

    def tiles(self, size: int) -> list[int]:
        """The tiles of a size: tile ``b`` holds the bands ``b`` and ``b + 1``; sizes within the threshold share one at least."""
        own = self.of(size)
        self.of(self.tops[own] + 1)
        return [own, own - 1] if own else [own]


SPARE_PARTS = 1.3


def _keys(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """Hashes of the fullest ``d + 1`` parts per tile.

    There are more parts than that. At most ``d`` of them differ, so two similar sets share all but ``d`` of their non-empty parts; taking
    the fullest first (equal parts are equally full) both have a shared one among their first ``d + 1``. Only sets with at most ``d``
    non-empty parts, which can agree in empty ones alone, give those too.
    """
    out = []
    for tile in bands.tiles(len(shingles)):
        d = bands.differing(tile, tile + 1)
        parts = int(SPARE_PARTS * (d + 1)) if d else 1
        salt = np.uint64((tile + 1) * 0x9E3779B97F4A7C15 % (1 << 63))
        part = (((shingles >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype("i8")
        order = np.argsort(part, kind="stable")
        size = np.bincount(part, minlength=parts)
        starts = np.cumsum(size) - size
        full = np.flatnonzero(size)
        sums = np.zeros(parts, "u8")
        sums[full] = np.add.reduceat(_mix(shingles ^ salt)[order], starts[full])
        keys = _mix(sums + np.arange(parts, dtype="u8") * _M1 + salt)
        if len(full) > d:
            full = full[np.lexsort((keys[full], -size[full]))[:d + 1]]
            keys = keys[full]
        out.append(keys)
    return np.concatenate(out).view("i8")


def _bitmap(shingles: np.ndarray) -> bytes:
    """Parity of the shingles that fall on each bit; the number of bits is a power of two, at least twice the shingles."""
    bits = max(BITMAP_BITS, 1 << (2 * len(shingles) - 1).bit_length()) if len(shingles) else BITMAP_BITS
    count = np.bincount((shingles & np.uint64(bits - 1)).astype("i8"), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8)).tobytes()


def _digest(shingles: bytes) -> bytes:
    return hashlib.blake2b(shingles, digest_size=16).digest()


SIGNED = "doc long, n_shingles long, digest binary, bitmap binary, keys array<long>"


def _sign(batches: Iterator[pa.RecordBatch], words: int, threshold: Fraction) -> Iterator[pa.RecordBatch]:
    shingle, bands = _Shingler(words), Bands(threshold)
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            s = shingle(text.as_py())
            keys = _keys(s, bands) if len(s) else np.zeros(0, "i8")
            rows.append((doc, len(s), _digest(s.tobytes()), _bitmap(s), keys))
            if len(rows) == 500:
                yield _signed(rows)
                rows = []
        if rows:
            yield _signed(rows)


def _signed(rows: list[tuple]) -> pa.RecordBatch:
    doc, n, digest, bitmap, keys = zip(*rows)
    offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype("i4")
    keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys), pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(bitmap, pa.binary()), keys],
        names=["doc", "n_shingles", "digest", "bitmap", "keys"])


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """``(a, b, shingles)`` of rows ``(a, b, text, digest)``; rows whose text gives another set than the wanted one fall out."""
    shingle = _Shingler(words)
    for batch in batches:
        for low in range(0, batch.num_rows, 200):
            part = batch.slice(low, 200)
            found = [shingle(t.as_py()).tobytes() for t in part.column(2)]
            same = pa.array([_digest(s) == d for s, d in zip(found, part.column(3).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.binary())], names=["a", "b", "shingles"]).filter(same)


def _similar(batches: Iterator[pa.RecordBatch], threshold: Fraction) -> Iterator[pa.RecordBatch]:
    p, q = threshold.numerator, threshold.denominator
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = np.frombuffer(x.as_py(), "u8"), np.frombuffer(y.as_py(), "u8")
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(q * common >= p * (len(x) + len(y) - common))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _overlap_bound(bits_a: np.ndarray, bits_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Shingles in common at most: every bit that differs stems from a shingle the other set lacks."""
    return (size_a + size_b - np.bitwise_count(bits_a ^ bits_b).sum(-1, dtype="i8")) // 2


def _folded(bitmaps: list[bytes], size: int) -> np.ndarray:
    """Bitmaps of one length in bytes as rows of ``size`` bytes: halves are laid over one another until they fit."""
    bits = np.frombuffer(b"".join(bitmaps), "u8").reshape(len(bitmaps), -1)
    while bits.shape[1] * 8 > size:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _may_link(batches: Iterator[pa.RecordBatch], threshold: Fraction) -> Iterator[pa.RecordBatch]:
    """Keeps the pairs whose bitmaps allow the threshold."""
    p, q = threshold.numerator, threshold.denominator
    for batch in batches:
        n_a, n_b = (np.asarray(batch.column(k).to_numpy(zero_copy_only=False), "i8") for k in (2, 3))
        a, b = batch.column(4).to_pylist(), batch.column(5).to_pylist()
        bound = np.zeros(batch.num_rows, "i8")
        lengths = np.array([(len(x), len(y)) for x, y in zip(a, b)], "i8").reshape(-1, 2)
        for pair in np.unique(lengths, axis=0):
            rows = np.flatnonzero((lengths == pair).all(1))
            size = int(pair.min())
            bound[rows] = _overlap_bound(_folded([a[r] for r in rows], size), _folded([b[r] for r in rows], size), n_a[rows], n_b[rows])
        keep = q * bound >= p * (n_a + n_b - bound)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))


def _tile_pairs(group: pa.Table, threshold: Fraction) -> pa.Table:
    """Pairs of different components in one pair of row tiles whose bitmaps allow the threshold."""
    p, q = threshold.numerator, threshold.denominator
    tile, i, j, rep, comp, n = (group.column(k).to_numpy() for k in ("tile", "i", "j", "rep", "comp", "n_shingles"))
    raw = group.column("bitmap").to_pylist()
    lengths = np.array([len(x) for x in raw])
    size = int(lengths.min())
    bits = np.zeros((len(raw), size // 8), "u8")
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        bits[rows] = _folded([raw[r] for r in rows], size)
    left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
    found_a, found_b = [], []
    for x in left:
        bound = _overlap_bound(bits[x], bits[right], n[x], n[right])
        ok = (q * bound >= p * (n[x] + n[right] - bound)) & (comp[right] != comp[x]) & ((rep[right] > rep[x]) | (i[0] != j[0]))
        found_a.append(np.minimum(rep[right[ok]], rep[x]))
        found_b.append(np.maximum(rep[right[ok]], rep[x]))
    none = np.zeros(0, "i8")
    return pa.table({"a": np.concatenate([none, *found_a]), "b": np.concatenate([none, *found_b])})


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, threshold: str = "0.9") -> DataFrame:
    """``(id_col, n_shingles, class_id, component_id)`` of every document with an id.

    ``class_id`` is the smallest id with an equal set; ``component_id`` the smallest id reachable by links.
    """
    t = Fraction(threshold)
    if not 0 < t <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).where("doc IS NOT NULL")
    signed = store.written(texts.mapInArrow(lambda it: _sign(it, words, t), SIGNED), "shingled")
    chosen = signed.groupBy("doc").agg(F.max(F.struct("n_shingles", "digest")).alias("set")).select("doc", "set.n_shingles", "set.digest")
    classes = store.written(chosen.groupBy("digest", "n_shingles").agg(F.min("doc").alias("class_id")), "classes")
    member = store.written(chosen.join(classes, ["digest", "n_shingles"]), "members")
    firsts = member.where("doc = class_id AND n_shingles > 0").select("doc", "digest")
    reps = signed.join(firsts, ["doc", "digest"], "left_semi")  # a repeated row merely repeats its keys

    # Keys with more than one set, each with its smallest set: one shuffle, read as a stream in key order.
    keyed = reps.select(F.explode("keys").alias("key"), F.col("doc").alias("rep"))
    in_key = Window.partitionBy("key").orderBy("rep")
    low = F.min("rep").over(in_key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hits = keyed.select("key", "rep", low.alias("low"), F.lead("rep").over(in_key).alias("after"))
    hits = store.written(hits.where("low < rep OR after > rep").select("key", "rep", "low"), "shared_keys")
    info = store.written(reps.join(hits.select(F.col("rep").alias("doc")).distinct(), "doc", "left_semi")
                         .select(F.col("doc").alias("rep"), "n_shingles", "bitmap", "digest").dropDuplicates(["rep"]), "bitmaps")
    digests = info.select(F.col("rep").alias("doc"), "digest")

    def allowed(pairs: DataFrame) -> DataFrame:
        for end in ("a", "b"):
            pairs = pairs.join(info.select(F.col("rep").alias(end), F.col("n_shingles").alias(f"n_{end}"), F.col("bitmap").alias(f"bitmap_{end}")), end)
        return pairs.select("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b").mapInArrow(lambda it: _may_link(it, t), "a long, b long")

    def verified(pairs: DataFrame) -> DataFrame:
        """The linked ones of distinct pairs. The set of each ``b`` travels once, to that of its ``a``."""
        def sets(wanted: DataFrame) -> DataFrame:
            rows = texts.join(wanted.join(digests, "doc"), "doc").select("a", F.col("doc").alias("b"), "text", "digest")
            return rows.mapInArrow(lambda it: _sets(it, words), "a long, b long, shingles binary")

        ends = sets(pairs.select("a", F.col("b").alias("doc"))).withColumnRenamed("shingles", "shingles_b")
        starts = sets(pairs.select("a", F.col("a").alias("doc")).distinct()).select("a", F.col("shingles").alias("shingles_a")).dropDuplicates(["a"])
        return ends.join(starts, "a").select("a", "b", "shingles_a", "shingles_b").mapInArrow(lambda it: _similar(it, t), "a long, b long")

    def mixed_keys(found: DataFrame, *more) -> tuple[DataFrame, DataFrame]:
        """The sets with their components, and the keys of several components; keys with the same sets are one."""
        placed = hits.select("key", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("comp"))
        mixed = placed.groupBy("key").agg(F.count("*").alias("size"), F.min("comp").alias("c1"), F.max("comp").alias("c2"),
                                          F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("print"), *more).where("c1 < c2")
        return placed, mixed.groupBy("size", "print").agg(F.min_by(F.struct("*"), "key").alias("k")).select("k.*")

    links = found = None
    for turn in range(STARS):
        if found is None:
            stars = hits.where("low < rep").select(F.col("low").alias("a"), F.col("rep").alias("b"))
        else:
            pivot = F.min(F.struct(F.xxhash64("rep", F.lit(turn)).alias("draw"), "rep", "comp")).alias("pivot")
            placed, mixed = mixed_keys(found, pivot)
            stars = placed.join(mixed.select("key", "pivot"), "key").where("comp != pivot.comp").select(F.col("pivot.rep").alias("a"), F.col("rep").alias("b"))
        one_each = store.written(allowed(stars.distinct()).groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "stars")
        more = store.written(verified(one_each), "star_links")
        links = more if links is None else links.unionByName(more)
        found = store.written(components(links, "a", "b"), "star_groups")

    # Sets of different components under one key: the largest component's tiles come after those of the others.
    placed, mixed = mixed_keys(found)
    placed = placed.join(mixed.select("key", "size"), "key")
    largest = placed.groupBy("key", "comp").agg(F.count("*").alias("n"), F.first("size").alias("size")).groupBy("key").agg(
        F.max(F.struct("n", "comp")).alias("top"), F.first("size").alias("size"))
    tiles = largest.select("key", F.col("top.comp").alias("top"), F.ceil((F.col("size") - F.col("top.n")) / TILE_ROWS).cast("int").alias("others"),
                           F.ceil(F.col("top.n") / TILE_ROWS).cast("int").alias("own"))
    in_top = F.col("comp") == F.col("top")
    rows = placed.drop("size").join(tiles, "key").join(info.drop("digest"), "rep")
    rows = rows.withColumn("tile", F.when(in_top, F.col("others") + F.pmod(F.xxhash64("rep"), F.col("own"))).otherwise(F.pmod(F.xxhash64("rep"), F.col("others"))).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1 + F.when(in_top, 0).otherwise(F.col("own")))))
    rows = rows.select("key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "rep", "comp", "n_shingles", "bitmap")
    rest = store.written(rows.groupBy("key", "i", "j").applyInArrow(lambda g: _tile_pairs(g, t), "a long, b long").distinct(), "tile_pairs")
    links = links.unionByName(store.written(verified(rest), "tile_links"))
    final = components(links, "a", "b").select(F.col("node").alias("class_id"), F.col("component").alias("component_id"))

    group = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "class_id")).otherwise(F.col("doc"))
    class_id = F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("doc"))
    return member.join(final, "class_id", "left").select(
        F.col("doc").alias(id_col), "n_shingles", class_id.alias("class_id"), group.alias("component_id"))
