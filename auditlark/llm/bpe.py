"""Byte-level BPE: every distinct word is encoded once, whatever the size of the corpus.

1. Each task splits its texts into pre-tokens and packs them into blocks: the block's distinct
   words, and for every position the number of its word. The blocks are a written table.
2. The blocks' words are dealt out by word, so equal words of all blocks meet in one task,
   which encodes each of them once. A word has one row at most per block, so no word is hot.
3. The ids go back to their block, which reassembles every text by position.

Decoding looks every id up in the token-byte table, which has one row per vocabulary entry and
so a size that does not grow with the data.

A null text counts as empty and has no ids. Rows that share an id are encoded each by itself;
other columns of the input are ignored, a null id is kept.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark import TaskContext

from auditlark.llm import store
from auditlark.llm.batches import small_batches

# White space as the pre-token pattern sees it. A match never spans a change from other
# characters to white space, so a run of white space and the word after it split by themselves.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")

BLOCK_CHARS = 8_000_000
LONG_WORD = 48


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file with a base64 token and a number per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join the neighbours with the lowest rank, leftmost first, until no pair is a token."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > LONG_WORD:
        return _encode_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    get = ranks.get
    pairs = [get(parts[i] + parts[i + 1], 1 << 60) for i in range(len(parts) - 1)]
    while pairs:
        best = min(pairs)
        if best == 1 << 60:
            break
        i = pairs.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], 1 << 60)
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], 1 << 60)
    return [ranks[p] for p in parts]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges from a heap, for words of any length in n log n."""
    n = len(word)
    end = list(range(1, n + 1))        # where the part that starts here ends; 0: joined to an earlier one
    before = list(range(-1, n - 1))    # start of the part before
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (rank := ranks.get(word[i:end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


# --- packing -----------------------------------------------------------------

def _pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit values by byte plane, compressed: most high bytes are zero."""
    planes = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return np.uint32(len(values)).tobytes() + pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data[:4], "<u4")[0])
    planes = np.frombuffer(pa.decompress(data[4:], 4 * n, "zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(n)


def _pack_words(words: list[bytes]) -> bytes:
    lengths = _pack(np.fromiter(map(len, words), "u4", len(words)))
    text = b"".join(words)
    return np.array([len(lengths), len(text)], "<u4").tobytes() + lengths + pa.compress(text, "zstd", asbytes=True)


def _unpack_words(data: bytes) -> list[bytes]:
    head, size = np.frombuffer(data[:8], "<u4").tolist()
    ends = np.cumsum(_unpack(data[8:8 + head])).tolist()
    text = pa.decompress(data[8 + head:], size, "zstd", asbytes=True)
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of the runs ``starts[i] .. starts[i] + lengths[i]``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


# --- 1: blocks -----------------------------------------------------------------

BLOCKS = T.StructType([
    T.StructField("block_id", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("n_words", T.BinaryType()),
    T.StructField("positions", T.BinaryType()), T.StructField("words", T.ArrayType(T.BinaryType())),
    T.StructField("numbers", T.ArrayType(T.BinaryType())),
])


class _Block(dict):
    """Word numbers of each piece seen in this block."""

    def __init__(self, pattern):
        super().__init__()
        self.split, self.numbers = pattern.findall, {}
        self.ids, self.counts, self.positions, self.chars = [], [], array("I"), 0

    def __missing__(self, piece: str) -> tuple[int, ...]:
        numbers = self.numbers
        found = self[piece] = tuple(numbers.setdefault(w, len(numbers)) for w in self.split(piece))
        return found

    def add(self, row_id, text: str | None) -> None:
        start = len(self.positions)
        self.positions.extend(itertools.chain.from_iterable(map(self.__getitem__, PIECE.findall(text or ""))))
        self.ids.append(row_id)
        self.counts.append(len(self.positions) - start)
        self.chars += len(text or "")

    def row(self, block_id: int, buckets: int) -> list:
        seen = np.frombuffer(self.positions, "u4") if self.positions else np.zeros(0, "u4")
        order = np.argsort(-np.bincount(seen, minlength=len(self.numbers)), kind="stable")  # small numbers for common words
        rank = np.empty(len(order), "u4")
        rank[order] = np.arange(len(order), dtype="u4")
        by_bucket: list[list[bytes]] = [[] for _ in range(buckets)]
        numbers: list[list[int]] = [[] for _ in range(buckets)]
        for word, number in zip(map(str.encode, self.numbers), rank.tolist()):
            k = _bucket(word, buckets)
            by_bucket[k].append(word)
            numbers[k].append(number)
        return [block_id, self.ids, _pack(np.array(self.counts, "u4")), _pack(rank[seen]), [_pack_words(w) for w in by_bucket],
                [_pack(np.array(x, "u4")) for x in numbers]]


def _bucket(word: bytes, buckets: int) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word) % buckets


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str, buckets: int, block_chars: int) -> Iterator[pa.RecordBatch]:
    compiled, schema = regex.compile(pattern), _arrow(BLOCKS)
    serial = itertools.count(TaskContext.get().partitionId() << 33)
    block = _Block(compiled)
    for batch in batches:
        for row_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            block.add(row_id, text.as_py())
            if block.chars >= block_chars:
                yield _batch([block.row(next(serial), buckets)], schema)
                block = _Block(compiled)
    if block.ids:
        yield _batch([block.row(next(serial), buckets)], schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


# --- 2: words ------------------------------------------------------------------

ENCODED = "block_id long, numbers binary, lengths binary, tokens binary"


def _encode_lists(batches: Iterator[pa.RecordBatch], ranks) -> Iterator[pa.RecordBatch]:
    table = ranks.value
    known: dict[bytes, list[int]] = {}
    schema = pa.schema([("block_id", pa.int64()), ("numbers", pa.binary()), ("lengths", pa.binary()), ("tokens", pa.binary())])
    for batch in batches:
        for block_id, words, numbers in zip(*(c.to_pylist() for c in batch.columns)):
            found = []
            for word in _unpack_words(words):
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = encode_word(word, table)
                found.append(ids)
            lengths = np.fromiter(map(len, found), "u4", len(found))
            flat = np.fromiter(itertools.chain.from_iterable(found), "u4", int(lengths.sum()))
            yield _batch([[block_id, numbers, _pack(lengths), _pack(flat)]], schema)


# --- 3: texts ------------------------------------------------------------------

def _reassemble(batches: Iterator[pa.RecordBatch], id_name: str) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(id_name, pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    for batch in batches:
        for i in range(batch.num_rows):
            ids, counts, positions, parts = (batch.column(k)[i].as_py() for k in range(4))
            numbers, lengths, tokens = (np.concatenate([_unpack(p[k]) for p in parts]) for k in ("numbers", "lengths", "tokens"))
            starts = np.cumsum(lengths, dtype="i8") - lengths
            start_of, length_of = np.empty(len(numbers), "i8"), np.empty(len(numbers), "i8")
            start_of[numbers], length_of[numbers] = starts, lengths
            seen, ends = _unpack(positions), np.cumsum(_unpack(counts), dtype="i8")
            for low in range(0, len(ids), 512):
                first = int(ends[low - 1]) if low else 0
                last = ends[low:low + 512]
                part = seen[first:int(last[-1])]
                lens = length_of[part]
                flat = tokens[_ragged(start_of[part], lens)].astype("<u4")
                stops = np.concatenate([[0], np.cumsum(lens)])[last - first]
                offsets = np.concatenate([[0], stops])
                values = pa.BinaryArray.from_buffers(pa.binary(), len(last), [None, pa.py_buffer((offsets * 4).astype("i4").tobytes()), pa.py_buffer(flat.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(ids[low:low + 512], pa.int64()), pa.array(np.diff(offsets), pa.int64()), values], schema=schema)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(id_col, n_tokens, ids)`` of every text; ``ids`` holds little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    buckets = max(64, store.shuffle_partitions(spark))
    ranks = spark.sparkContext.broadcast(load_ranks(ranks_path))  # one entry per token of the vocabulary
    texts = small_batches(docs).select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    blocks = store.bucketed(
        texts.mapInArrow(lambda it: _blocks(it, pattern, buckets, block_chars), BLOCKS), "bpe_blocks", "block_id", store.shuffle_partitions(spark))
    lists = blocks.select("block_id", F.posexplode(F.arrays_zip("words", "numbers")).alias("bucket", "list"))
    lists = lists.repartition(store.shuffle_partitions(spark), "bucket").select("block_id", "list.words", "list.numbers")
    encoded = lists.mapInArrow(lambda it: _encode_lists(it, ranks), ENCODED)
    parts = encoded.groupBy("block_id").agg(F.collect_list(F.struct("numbers", "lengths", "tokens")).alias("parts"))
    return (blocks.select("block_id", "ids", "n_words", "positions").join(parts, "block_id").select("ids", "n_words", "positions", "parts")
            .mapInArrow(lambda it: _reassemble(it, id_col), f"`{id_col}` long, n_tokens long, ids binary"))


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes of ``ids_col``; an id outside the vocabulary fails the job, null ids give null."""
    spark = encoded.sparkSession
    tokens = sorted(((rank, token) for token, rank in load_ranks(ranks_path).items()))
    lengths = np.zeros(tokens[-1][0] + 1 if tokens else 0, "i8")
    for rank, token in tokens:
        lengths[rank] = len(token)
    table = spark.sparkContext.broadcast((b"".join(t for _, t in tokens), lengths))
    others = [c for c in encoded.columns if c != out]

    def run(batches):
        text, size = table.value
        flat, starts = np.frombuffer(text, np.uint8), np.cumsum(size) - size
        for batch in batches:
            found = []
            for packed in batch.column(others.index(ids_col)):
                packed = packed.as_py()
                if packed is None:
                    found.append(None)
                    continue
                ids = np.frombuffer(packed, "<u4")
                found.append(flat[_ragged(starts[ids], size[ids])].tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(others))), pa.array(found, pa.binary())], names=[*others, out])

    schema = T.StructType([*(encoded.schema[c] for c in others), T.StructField(out, T.BinaryType())])
    return small_batches(encoded).select(*others).mapInArrow(run, schema)


def unpacked(ids) -> list[int]:
    """The integers of one packed ``ids`` value."""
    return np.frombuffer(ids, "<u4").tolist()


def vocabulary(spark: SparkSession, ranks_path: str) -> DataFrame:
    """The token-byte table as a DataFrame ``(id, token)``."""
    return spark.createDataFrame([(r, bytearray(t)) for t, r in load_ranks(ranks_path).items()], "id int, token binary")
