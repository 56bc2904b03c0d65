"""Language ID: sparse multinomial logistic regression on TF-IDF of character n-grams.

Fitted by follow-the-regularised-leader with an elastic-net penalty, one text at a time, on a bounded sample of labelled
rows (``per_language`` texts of at most ``max_chars`` code points per language); one temperature then
calibrates the probabilities on texts held back from the fit. The document frequencies behind the IDF
weights are counted over all labelled rows to learn from, so nothing of a held-out or unlabelled text enters the model. Prediction reads every whole text once and shuffles nothing.

A null text, or one without a letter (a mark alone is none), is ``und`` with score 0. So is every text if no labelled text has a letter.
Rows that share an id are predicted each by itself; other columns are ignored.
"""

from __future__ import annotations

import dataclasses
import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlark.llm.batches import small_batches, with_text
from auditlark.llm.samples import per_class, uniform

UNKNOWN = "und"
ORDERS = (1, 2, 3)
CHUNK = 1_000_000


@functools.cache
def _letters() -> np.ndarray:
    """True for every code point that is a letter or a mark on one."""
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)])


def ngram_counts(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of the lower-cased text and their counts; all that is not a letter is a blank."""
    counts = np.zeros(1 << bits, "i8")
    text = text or ""
    for low in range(0, len(text), CHUNK):  # whole texts, in pieces that overlap by two characters
        piece = text[max(0, low - max(ORDERS) + 1):low + CHUNK].lower()
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "u4")
        letter = _letters()[points]
        points = np.where(letter, points, 32).astype("u8")
        skip = max(ORDERS) - 1 if low else 0
        for n in ORDERS:
            size = len(points) - n + 1
            if size <= 0:
                continue
            h = np.full(size, n, "u8")
            some = np.zeros(size, bool)
            for i in range(n):
                h = h * np.uint64(0x9E3779B97F4A7C15) + points[i:size + i]
                h ^= h >> np.uint64(29)
                some |= letter[i:size + i]
            h, some = (h * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - bits), some.copy()
            some[:max(0, skip - n + 1)] = False
            counts += np.bincount(h[some].astype("i8"), minlength=1 << bits)
    found = np.flatnonzero(counts)
    return found.astype("i4"), counts[found]


@dataclasses.dataclass
class Model:
    languages: list[str]
    weights: np.ndarray      # n-gram x language, float32
    bias: np.ndarray
    idf: np.ndarray
    temperature: float
    bits: int

    def vector(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[found]
        norm = np.sqrt((x * x).sum())
        return x / norm if norm else x

    def probabilities(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        z = (self.vector(found, counts) @ self.weights[found] + self.bias) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def document_frequencies(texts: DataFrame, text_col: str, bits: int) -> tuple[np.ndarray, int]:
    """In how many texts each n-gram occurs, and how many texts have any; one row per n-gram leaves each task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(1 << bits, "i8"), 0
        for batch in batches:
            for text in batch.column(0):
                found, _ = ngram_counts(text.as_py(), bits)
                seen[found] += 1
                n += bool(len(found))
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(found, -1)), pa.array(np.append(seen[found], n))], names=["gram", "n"])

    rows = texts.select(F.col(text_col).cast("string")).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    grams, n = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    frequency = np.zeros(1 << bits, "i8")
    frequency[grams[grams >= 0]] = n[grams >= 0]
    return frequency, int(n[grams < 0].sum())


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _ftrl(vectors, labels, k: int, size: int, epochs: int, alpha: float, beta: float, l1: float, l2: float, seed: int):
    """Per-coordinate follow-the-proximally-regularised-leader; the last coordinate is the bias, which is not penalised."""
    z, n = np.zeros((size + 1, k)), np.zeros((size + 1, k))

    def weights(rows):
        zr, nr = z[rows], n[rows]
        penalty = np.where(rows == size, 0.0, l1)[:, None]
        return np.where(np.abs(zr) <= penalty, 0.0, -(zr - np.sign(zr) * penalty) / ((beta + np.sqrt(nr)) / alpha + l2))

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(vectors)):
            found, x = vectors[i]
            rows, x = np.append(found, size), np.append(x, 1.0)
            w = weights(rows)
            p = _softmax(x @ w)
            p[labels[i]] -= 1
            g = x[:, None] * p
            g2 = g * g
            z[rows] += g - (np.sqrt(n[rows] + g2) - np.sqrt(n[rows])) / alpha * w
            n[rows] += g2
    w = weights(np.arange(size + 1))
    return w[:-1].astype("f4"), w[-1]


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search over its logarithm."""
    if not len(logits):
        return 1.0

    def loss(t: float) -> float:
        return -np.log(np.maximum(_softmax(logits / np.exp(t))[np.arange(len(labels)), labels], 1e-300)).mean()

    low, high, ratio = -2.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(texts: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bits: int = 16,
        per_language: int = 800, max_chars: int = 200_000, epochs: int = 3, alpha: float = 2.0, beta: float = 1.0,
        l1: float = 0.02, l2: float = 0.5, held_back: float = 0.15, seed: int = 7) -> Model:
    """Fit on a sample of the rows where ``train`` holds and a language is given; document frequencies are counted over all such rows."""
    rows = small_batches(texts).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), train.alias("train"))
    labelled = rows.where(F.col("train") & F.col("lang").isNotNull() & (F.length("text") <= max_chars)).select("id", "text", "lang")
    sample, _ = per_class(labelled, "id", "lang", per_language, seed)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [ngram_counts(t.as_py(), bits) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([f.tobytes() for f, _ in out], pa.binary()), pa.array([c.astype("i4").tobytes() for _, c in out], pa.binary())],
                names=["lang", "u", "found", "counts"])

    drawn = sample.select("lang", "text", uniform("id", seed + 1).alias("u")).mapInArrow(features, "lang string, u double, found binary, counts binary")
    drawn = sorted((r for r in drawn.toArrow().to_pylist() if r["found"]), key=lambda r: (r["u"], r["lang"], r["found"]))
    frequency, n = document_frequencies(rows.where(F.col("train") & F.col("lang").isNotNull()), "text", bits)
    idf = np.log((1 + n) / (1 + frequency)) + 1
    languages = sorted({r["lang"] for r in drawn})
    k = len(languages)
    model = Model(languages, np.zeros((1 << bits, k), "f4"), np.zeros(k), idf, 1.0, bits)
    if not k:
        return model
    pairs = [(np.frombuffer(r["found"], "i4"), np.frombuffer(r["counts"], "i4")) for r in drawn]
    vectors = [(f, model.vector(f, c)) for f, c in pairs]
    labels = np.array([languages.index(r["lang"]) for r in drawn])
    back = max(1, int(held_back * len(drawn))) if len(drawn) > 1 else 0
    model.weights, model.bias = _ftrl(vectors[back:], labels[back:], k, 1 << bits, epochs, alpha, beta, l1, l2, seed)
    logits = np.array([x @ model.weights[f] + model.bias for f, x in vectors[:back]]).reshape(back, k)
    model.temperature = _temperature(logits, labels[:back])
    return model


def predict(texts: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """All columns of ``texts`` with the likeliest language and its calibrated probability; existing columns of these names are replaced."""
    shared = texts.sparkSession.sparkContext.broadcast(model)  # 2^bits rows of as many weights as languages
    others = [c for c in texts.columns if c not in (lang_out, score_out)]
    rows, at = with_text(texts, others, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            languages, scores = [], []
            for text in batch.column(at):
                text = text.as_py() or ""
                if m.languages and any(map(str.isalpha, text)):
                    found, counts = ngram_counts(text, m.bits)
                    p = m.probabilities(found, counts)
                    best = int(p.argmax())
                    languages.append(m.languages[best])
                    scores.append(float(p[best]))
                else:
                    languages.append(UNKNOWN)
                    scores.append(0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(others)], pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*others, lang_out, score_out])

    from pyspark.sql import types as T

    schema = T.StructType([*(texts.schema[c] for c in others), T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())])
    return rows.mapInArrow(run, schema)
