"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

Every sentence has a logistic score from hashed word and word-part features; the document's score is
the noisy-or of its sentences, 1 - prod(1 - p). Only documents carry labels, and the sentence weights are fitted through the
noisy-or, so the model finds out by itself which sentences are to blame and returns them with their positions.

Fitted on a bounded sample of labelled rows: about ``per_class`` documents of each label with at most
``max_chars`` code points each; class weights restore the true shares. Scoring reads every whole text once and shuffles nothing.

A null or empty text, or one without a word, has score 0 and no sentences. Labels without text, rows without label and
null ids are not learned from; of several labels of one id the largest counts. Without labels of both kinds every score is 0.
"""

from __future__ import annotations

import dataclasses
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlark.llm.batches import with_text
from auditlark.llm.samples import per_class as draw

SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
WORD = re.compile(r"\w+")
FLOOR = 0.05          # sentences below it do not add to a document's score: a long clean text stays clean
KNOWN_WORDS = 400_000


def word_features(word: str, bits: int) -> list[int]:
    """The word, its beginnings of three to six letters, its last four and its inner runs of four."""
    parts = [f"={word}", *(f"^{word[:n]}" for n in range(3, min(7, len(word) + 1))), f"{word[-4:]}$", *(word[i:i + 4] for i in range(len(word) - 3))]
    mask = (1 << bits) - 1
    return [xxhash.xxh32_intdigest(p) & mask for p in parts]


def sentences(text: str | None) -> list[tuple[int, int]]:
    return [m.span() for m in SENTENCE.finditer(text or "")]


@dataclasses.dataclass
class Model:
    weights: np.ndarray
    bias: float
    bits: int

    def word_score(self, word: str) -> float:
        found = word_features(word, self.bits)
        return float(self.weights[found].sum() / np.sqrt(len(found)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def noisy_or(scores: np.ndarray) -> float:
    kept = np.maximum(0.0, (scores - FLOOR) / (1 - FLOOR))
    return float(-np.expm1(np.log1p(-np.minimum(kept, 1 - 1e-15)).sum()))


def _train(texts: list[str], labels: np.ndarray, weight: np.ndarray, bits: int, rounds: int, rate: float, l1: float, least: int) -> Model:
    """Proximal gradient with momentum on the log loss of the noisy-or; features of fewer than ``least`` texts stay at zero."""
    numbers: dict[str, int] = {}
    features: list[list[int]] = []
    seen = np.zeros(1 << bits, "i4")
    words, sentence_of, text_of = [], [], []
    for i, text in enumerate(texts):
        own: set[int] = set()
        for a, b in sentences(text):
            for word in set(WORD.findall(text[a:b].lower())):
                k = numbers.setdefault(word, len(numbers))
                if k == len(features):
                    features.append(word_features(word, bits))
                own.update(features[k])
                words.append(k)
                sentence_of.append(len(text_of))
            text_of.append(i)
        seen[list(own)] += 1
    text_of = np.array(text_of, "i8")
    labels = np.asarray(labels)
    if not len(text_of) or labels.min() == labels.max():
        return Model(np.zeros(1 << bits), -40.0, bits)
    size = np.array([len(f) for f in features])
    flat, word_of = np.fromiter(itertools.chain.from_iterable(features), "i8", int(size.sum())), np.repeat(np.arange(len(size)), size)
    scale = 1 / np.sqrt(size)
    used = seen[flat] >= least
    flat, word_of = flat[used], word_of[used]
    words, sentence_of = np.array(words, "i8"), np.array(sentence_of, "i8")
    used = np.bincount(word_of, minlength=len(size))[words] > 0
    words, sentence_of = words[used], sentence_of[used]
    n_s, n_t, n_w, all_ = len(text_of), len(texts), len(size), weight.sum()
    w, b, m, mb = np.zeros(1 << bits), -4.0, np.zeros(1 << bits), 0.0
    v, vb = np.zeros(1 << bits), 0.0
    for step in range(1, rounds + 1):
        score = np.bincount(word_of, w[flat], n_w) * scale
        z = b + np.bincount(sentence_of, score[words], n_s)
        total = np.bincount(text_of, np.logaddexp(0, z), n_t)  # -log of the probability that no sentence is toxic
        blame = np.where(labels == 1, -np.exp(-total) / -np.expm1(-np.maximum(total, 1e-12)), 1.0) * weight / all_
        g_z = _sigmoid(z) * blame[text_of]
        g_word = np.bincount(words, g_z[sentence_of], n_w) * scale
        g, g_b = np.bincount(flat, g_word[word_of], 1 << bits), g_z.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * g_b, 0.99 * vb + 0.01 * g_b * g_b
        c1, c2 = 1 - 0.9 ** step, 1 - 0.99 ** step
        w -= rate * (m / c1) / (np.sqrt(v / c2) + 3e-3)  # small gradients, those of rare features, take small steps
        w = np.maximum(w - rate * l1, 0)  # a word can only speak for toxicity: no neighbour talks a sentence clean
        b -= rate * (mb / c1) / (np.sqrt(vb / c2) + 3e-3)
    return Model(w, float(b), bits)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", bits: int = 18,
        per_class: int = 1500, max_chars: int = 100_000, rounds: int = 400, rate: float = 0.2, l1: float = 0.03, least: int = 3, seed: int = 11) -> Model:
    """``labels`` holds the rows to learn from only."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    sample, share = draw(known.groupBy("id").agg(F.max("label").alias("label")), "id", "label", per_class, seed)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.length("text") <= max_chars)
    rows = texts.join(F.broadcast(sample), "id").toArrow().to_pylist()  # the sample has some 2 * per_class rows
    rows.sort(key=lambda r: (r["id"], r["text"]))
    y = np.array([r["label"] for r in rows], "i8")
    weight = np.array([1 / share[r["label"]] for r in rows])
    return _train([r["text"] for r in rows], y, weight, bits, rounds, rate, l1, least)


FOUND = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))


def score(docs: DataFrame, model: Model, text_col: str = "text", cut: float = 0.5) -> DataFrame:
    """All columns of ``docs`` with ``score`` and ``offending``: start, end and score of the sentences at or above ``cut``, in text order."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^bits weights
    others = [c for c in docs.columns if c not in ("score", "offending")]
    rows, at = with_text(docs, others, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = shared.value, {}
        type_ = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            scores, blamed = [], []
            for text in batch.column(at):
                text, spans, z = text.as_py() or "", [], []
                for a, b in sentences(text):
                    total, some = m.bias, False
                    for word in set(WORD.findall(text[a:b].lower())):
                        some, s = True, known.get(word)
                        if s is None:
                            s = known[word] = m.word_score(word)
                        total += s
                    if some:
                        spans.append((a, b))
                        z.append(total)
                if len(known) > KNOWN_WORDS:
                    known.clear()
                p = _sigmoid(np.array(z))
                scores.append(noisy_or(p) if len(p) else 0.0)
                blamed.append([{"start": spans[i][0], "end": spans[i][1], "score": float(p[i])} for i in np.flatnonzero(p >= cut)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(others)], pa.array(scores, pa.float64()), pa.array(blamed, type_)], names=[*others, "score", "offending"])

    schema = T.StructType([*(docs.schema[c] for c in others), T.StructField("score", T.DoubleType()), T.StructField("offending", FOUND)])
    return rows.mapInArrow(run, schema)
