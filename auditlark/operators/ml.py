"""Training, evaluating and applying the text classifier."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IDF, CountVectorizerModel, ElementwiseProduct, IndexToString, NGram, Normalizer, RegexTokenizer, SQLTransformer,
    StringIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlark.functions import numbers as N
from auditlark.functions import text as X
from auditlark.functions.literals import constant
from auditlark.operators.ranking import stratified_split
from auditlark.rulepack import DEFAULT_PACK, RulePack

MAX_TERMS = 5000
WORD_PATTERN = r"(?U)\b\w\w+\b"


def _term_stages() -> list:
    return [
        RegexTokenizer(inputCol="text", outputCol="words", pattern=WORD_PATTERN, gaps=False, toLowercase=True),
        NGram(n=2, inputCol="words", outputCol="pairs"),
        SQLTransformer(statement="SELECT *, concat(words, pairs) AS terms FROM __THIS__"),
    ]


def _terms(texts: DataFrame) -> DataFrame:
    """The words and word pairs of every text, extracted once."""
    found = texts.select("text")
    for stage in _term_stages():
        found = stage.transform(found)
    return found.select(X.once(F.struct("terms")))


def _most_frequent(terms: DataFrame, limit: int) -> list[str]:
    counts = terms.select(F.explode("terms").alias("term")).groupBy("term").count()
    return sorted(r["term"] for r in counts.orderBy(F.desc("count"), "term").limit(limit).collect())


def sparse_values(vector: str) -> tuple[Column, Column]:
    """Places and values of a sparse vector column, without its zeros."""
    fields = F.unwrap_udt(F.col(vector))
    return fields["indices"], fields["values"]


def top_terms(texts: DataFrame, limit: int = MAX_TERMS) -> list[str]:
    """The most frequent words and word pairs, ties in alphabetical order."""
    return _most_frequent(_terms(texts), limit)


def tfidf_model(texts: DataFrame, limit: int = MAX_TERMS) -> PipelineModel:
    """Smooth tf-idf over words and word pairs, L2-normed.

    The vocabulary is the ``limit`` most frequent terms, a feature of the model. Spark's idf is ``ln((n + 1) / (df + 1))``;
    one is added to every weight, so that terms found in all texts keep a weight of one. Terms are extracted once to be counted and once
    for their document frequencies: kept, they would take several times the room of the texts.
    """
    terms = _terms(texts)
    counter = CountVectorizerModel.from_vocabulary(_most_frequent(terms, limit), inputCol="terms", outputCol="tf")
    idf = IDF(inputCol="tf", outputCol="unused").fit(counter.transform(terms)).idf.toArray()
    weigh = ElementwiseProduct(scalingVec=Vectors.dense(idf + 1.0), inputCol="tf", outputCol="weighted")
    return PipelineModel([*_term_stages(), counter, weigh, Normalizer(p=2.0, inputCol="weighted", outputCol="features")])


def train_classifier(train: DataFrame, label: str = "label", max_terms: int = MAX_TERMS, max_iter: int = 1000,
                     strength: float = 1.0, tolerance: float = 1e-4, path: str | None = None) -> PipelineModel:
    """Tf-idf and multinomial logistic regression with an L2 penalty of 1 / (C n), until a round gains less than ``tolerance``; saved at ``path``."""
    features = tfidf_model(train, max_terms)
    prepared = features.transform(train).select(F.col(label).cast("string").alias("label"), "features").persist()
    try:
        n_rows = prepared.count()
        indexer = StringIndexer(inputCol="label", outputCol="label_index", stringOrderType="alphabetAsc").fit(prepared)
        regression = LogisticRegression(
            featuresCol="features", labelCol="label_index", family="multinomial", maxIter=max_iter, tol=tolerance,
            regParam=1.0 / (strength * n_rows), standardization=False, predictionCol="prediction_index",
        ).fit(indexer.transform(prepared))
    finally:
        prepared.unpersist()
    back = IndexToString(inputCol="prediction_index", outputCol="prediction", labels=indexer.labels)
    model = PipelineModel([*features.stages, regression, back])
    if path:
        model.write().overwrite().save(path)
    return model


def class_names(model: PipelineModel) -> list[str]:
    return model.stages[-1].getLabels()


def train_and_evaluate(texts: DataFrame, key: str, label: str = "label", path: str | None = None, seed: int = 42,
                       **training) -> tuple[PipelineModel, DataFrame]:
    """Split, fit and optionally save; returns the model and the scored test rows."""
    split = stratified_split(texts, key, label, 80, seed)
    model = train_classifier(split.where("is_train"), label, path=path, **training)
    return model, model.transform(split.where(~F.col("is_train")))


# --- a linear classifier as tables: scored by a join, in any engine ------------------------------------------

COEFFICIENTS = "label string, term string, idf double, weight double"


def coefficient_table(model: PipelineModel) -> DataFrame:
    """A classifier as rows ``label, term, idf, weight``; the row without a term holds a label's intercept. At most the vocabulary per label."""
    stages = {type(s).__name__: s for s in model.stages}
    regression, vocabulary = stages["LogisticRegressionModel"], stages["CountVectorizerModel"].vocabulary
    idf = stages["ElementwiseProduct"].getScalingVec().toArray()
    weights, intercepts = regression.coefficientMatrix.toArray(), regression.interceptVector.toArray()
    rows = [(label, None, None, float(intercepts[k])) for k, label in enumerate(class_names(model))]
    rows += [(label, t, float(idf[i]), float(weights[k, i])) for k, label in enumerate(class_names(model)) for i, t in enumerate(vocabulary)]
    return _coefficient_rows(rows)


def term_weights(examples: DataFrame, label: str = "label", max_terms: int = MAX_TERMS) -> DataFrame:
    """Coefficients in closed form, by counting only: the log share of a term in a class (multinomial naive Bayes, add one), and the log share of the class.

    Any engine can repeat them exactly; as a start, or where a fit is not wanted. Terms are the ``max_terms`` most frequent ones of the examples: one pass
    finds them, a second one sums them per class. Only labels x vocabulary reach the driver.
    """
    rows = examples.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label"), _term_list(F.col("text")).alias("terms"))
    rows = rows.select("label", X.once(F.struct("terms")))
    vocabulary = _most_frequent(rows, max_terms)
    counted = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="terms", outputCol="tf").transform(rows) if vocabulary else rows
    summary = [Summarizer.metrics("sum", "numNonZeros").summary(F.col("tf")).alias("of")] if vocabulary else []
    classes = counted.groupBy("label").agg(F.count(F.lit(1)).alias("docs"), *summary).orderBy("label").collect()
    texts = sum(r["docs"] for r in classes)
    found = [(r["label"], None, None, math.log(r["docs"] / texts)) for r in classes]
    if vocabulary and classes:
        frequency = sum(r["of"]["numNonZeros"].toArray() for r in classes)
        idf = [math.log((texts + 1) / (k + 1)) + 1 for k in frequency]
        for r in classes:
            n = r["of"]["sum"].toArray()
            everything = n.sum() + len(vocabulary)
            found += [(r["label"], t, idf[i], math.log((n[i] + 1) / everything)) for i, t in enumerate(vocabulary)]
    return _coefficient_rows(found)


def _coefficient_rows(rows: list[tuple]) -> DataFrame:
    types = {"label": pa.string(), "term": pa.string(), "idf": pa.float64(), "weight": pa.float64()}
    return SparkSession.active().createDataFrame(pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(types.items())}))


def _term_list(text: Column) -> Column:
    """The words and word pairs of a text."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD_PATTERN), F.lit(0))

    def with_pairs(found: Column) -> Column:
        rest = F.greatest(F.size(found) - 1, F.lit(0))
        return F.concat(found, F.zip_with(F.slice(found, F.lit(1), rest), F.slice(found, F.lit(2), rest), lambda a, b: F.concat(a, F.lit(" "), b)))

    return X.let(words, with_pairs)


def linear_probabilities(texts: DataFrame, key: str, text: str, coefficients: DataFrame) -> DataFrame:
    """``key, label, probability``: every text scored by a table of coefficients.

    A text's known terms are counted and weighed where it is read, as one sparse vector times the matrix of the weights; only one row of sums per text is shuffled.
    ``key`` must be unique; a text without a known term has the probabilities of the intercepts alone.
    """
    rows = coefficients.collect()  # labels x vocabulary
    labels = sorted({r["label"] for r in rows})
    start = {r["label"]: r["weight"] for r in rows if r["term"] is None}
    place = {t: i for i, t in enumerate(sorted({r["term"] for r in rows if r["term"] is not None}))}
    matrix = np.full((len(place), len(labels) + 1), -np.inf)  # the idf of a term and its weights
    at = {c: k + 1 for k, c in enumerate(labels)}
    for r in rows:
        if r["term"] is not None:
            line = matrix[place[r["term"]]]
            line[0] = max(line[0], r["idf"])
            line[at[r["label"]]] = max(line[at[r["label"]]], r["weight"])
    matrix[np.isneginf(matrix)] = 0.0
    names = ["norm", *(f"s{k}" for k in range(len(labels)))]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, values = batch.column("places"), batch.column("n")
            size = np.diff(places.offsets.to_numpy())
            at, n = places.flatten().to_numpy(), values.flatten().to_numpy()
            value = n * matrix[at, 0]
            parts = np.concatenate([(value * value)[:, None], value[:, None] * matrix[at, 1:]], axis=1)
            first = np.concatenate([[0], np.cumsum(size)[:-1]])  # no text is without a place here
            total = np.add.reduceat(parts, first, axis=0) if len(size) else parts
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array(total[:, k]) for k in range(len(names)))], ["key", *names])

    every = texts.select(key)
    if place:
        terms = texts.select(F.col(key).alias("key"), _term_list(F.col(text)).alias("terms"))
        counted = CountVectorizerModel.from_vocabulary(list(place), inputCol="terms", outputCol="tf").transform(terms)
        places, n = sparse_values("tf")
        counted = counted.select("key", X.once(F.struct(places.alias("places"), n.alias("n")))).where(F.size("places") > 0)
        schema = T.StructType([T.StructField("key", texts.schema[key].dataType), *(T.StructField(name, T.DoubleType()) for name in names)])
        summed = counted.mapInArrow(sums, schema).groupBy(F.col("key").alias(key)).agg(
            F.sqrt(F.sum("norm")).alias("norm"), *(F.sum(name).alias(name) for name in names[1:]))
        every = every.join(summed, key, "left")
    else:
        every = every.select("*", *(F.lit(None).cast("double").alias(name) for name in names))
    scores = F.array(*(F.lit(float(start.get(c, 0.0))) + F.coalesce(F.col(f"s{k}") / F.col("norm"), F.lit(0.0)) for k, c in enumerate(labels)))

    def softmax(z: Column) -> Column:
        return X.let(F.transform(z, lambda v: F.exp(v - F.array_max(z))), lambda e: F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)))

    chances = every.select(key, X.once(F.struct(X.let(scores, softmax).alias("p"))))
    return chances.select(key, F.posexplode("p").alias("k", "probability")).select(key, F.get(constant(labels), F.col("k")).alias("label"), "probability")


def confident_classes(probabilities: DataFrame, clean: str = "clean", cut: float = 0.5) -> DataFrame:
    """The classes other than ``clean`` whose probability is above the cut."""
    return probabilities.where((F.col("label") != clean) & (F.col("probability") > cut))


def calibration(model: PipelineModel, train: DataFrame, label: str = "label") -> DataFrame:
    """``label, n_rows, expected_rows``: a fitted regression expects as many rows of each class as it was fitted on, as its intercepts are free."""
    names = class_names(model)
    scored = model.transform(train).select(F.col(label).cast("string").alias("label"), X.once(F.struct(vector_to_array("probability").alias("p"))))
    sums = scored.agg(*(F.sum(F.get("p", F.lit(k))).alias(f"p{k}") for k in range(len(names))), *(F.count_if(F.col("label") == c).alias(f"n{k}") for k, c in enumerate(names)))
    return sums.select(F.inline(F.array(*(F.struct(F.lit(c).alias("label"), F.col(f"n{k}").alias("n_rows"), F.col(f"p{k}").alias("expected_rows")) for k, c in enumerate(names)))))


def load_classifier(path: str) -> PipelineModel | None:
    """A saved model, or None when there is none; the path may be in any store that Spark reads."""
    try:
        SparkSession.active().read.text(f"{path}/metadata")
    except AnalysisException:
        return None
    return PipelineModel.load(path)


def model_detections(df: DataFrame, keys: list[str], text: str, model: PipelineModel | None, cut: float = 0.5,
                     clean: str = "clean", pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """Detection rows of the classifier: per key and class the highest
    probability above ``cut``. Without a model an empty frame of that shape."""
    if model is None:
        empty = df.select(*keys).limit(0)
        return empty.select(
            *keys, F.lit(0).alias("ordinal"), F.lit("").alias("type"), F.lit("ml_model").alias("method"),
            F.lit(None).cast("bigint").alias("count"), F.lit(None).cast("array<string>").alias("matched_terms"),
            F.lit(0.0).alias("confidence"),
        )
    names = class_names(model)
    first_ordinal = len(pack.patterns) + len(pack.keywords)  # model classes come after the pack's types
    scored = model.transform(df.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("text")))
    labels = F.array(*[F.lit(n) for n in names])
    chances = X.once(F.struct(vector_to_array("probability").alias("chances")))
    classes = scored.select(*keys, chances).select(*keys, F.posexplode("chances").alias("class", "p")).withColumn(
        "type", F.get(labels, F.col("class")))
    return (
        classes.where((F.col("type") != clean) & (F.col("p") > cut))
        .groupBy(*keys, "type", "class").agg(F.max("p").alias("p"))
        .select(
            *keys, (F.col("class") + first_ordinal).cast("int").alias("ordinal"), "type", F.lit("ml_model").alias("method"),
            F.lit(None).cast("bigint").alias("count"), F.lit(None).cast("array<string>").alias("matched_terms"),
            N.round_exact(F.col("p"), 3).alias("confidence"),
        )
    )
