"""The classifier on the documents: the language is the label to learn."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from auditlark.catalog.registry import query, quoted, sql_round, table
from auditlark.functions.numbers import round_exact
from auditlark.functions.text import WORD, once
from auditlark.operators import evaluate as E
from auditlark.operators import ml as ML
from auditlark.operators.ranking import hash_rank, stratified_split
from auditlark.session import scratch_folder

SQL_RANKED = """ranked AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(concat_ws('|', doc_id::VARCHAR, '42')), doc_id) AS rank,
count(*) OVER (PARTITION BY quality) AS group_size FROM labels)"""


@query("M3", f"WITH {SQL_RANKED} SELECT doc_id, quality::BIGINT AS quality, rank, group_size FROM ranked")
def hash_ranks(spark, folder):
    labels = table(spark, folder, "labels", ["doc_id", "quality"])
    return hash_rank(labels, "doc_id", "quality").select("doc_id", F.col("quality").cast("bigint").alias("quality"), "rank", "group_size")


@query("M3", f"WITH {SQL_RANKED} SELECT doc_id, quality::BIGINT AS quality, (rank - 1) * 100 < 80 * greatest(group_size - 1, 1) AS is_train FROM ranked")
def stratified_train_test_split(spark, folder):
    labels = table(spark, folder, "labels", ["doc_id", "quality"])
    return stratified_split(labels, "doc_id", "quality").select("doc_id", F.col("quality").cast("bigint").alias("quality"), "is_train")


def _examples(spark, folder):
    docs = table(spark, folder, "documents", ["doc_id", "text", "lang"], heavy=True)
    return docs.select("doc_id", "text", F.col("lang").alias("label"))


SQL_TFIDF = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), {quoted(WORD)}) AS ws FROM documents),
t AS (SELECT doc_id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS term FROM w),
tf AS (SELECT doc_id, term, count(*) AS n FROM t GROUP BY ALL),
vocabulary AS (SELECT term, count(*) AS df FROM tf GROUP BY term ORDER BY sum(n) DESC, term LIMIT 5000),
weights AS (SELECT doc_id, n * (ln(((SELECT count(*) FROM documents) + 1) / (df + 1)::DOUBLE) + 1) AS v FROM tf JOIN vocabulary USING (term)),
docs AS (SELECT doc_id, count(*) AS n_terms, max(v) / sqrt(sum(v * v)) AS top FROM weights GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_terms, 0) AS n_terms, coalesce({sql_round('top', 4)}, 0.0) AS top_weight FROM documents d LEFT JOIN docs ON d.doc_id = docs.doc_id"""


@query("M1", SQL_TFIDF)
def tfidf_features(spark, folder):
    texts = _examples(spark, folder)
    vectors = ML.tfidf_model(texts).transform(texts.select("doc_id", "text"))
    weights = vectors.select("doc_id", once(F.struct(ML.sparse_values("features")[1].alias("weights"))))
    return weights.select(
        "doc_id", F.size(F.filter("weights", lambda w: w != 0)).cast("bigint").alias("n_terms"),
        round_exact(F.coalesce(F.array_max("weights"), F.lit(0.0)), 4).alias("top_weight"))


SQL_LINEAR = f"""
w AS (SELECT doc_id, label, regexp_extract_all(lower(text), {quoted(WORD)}) AS ws FROM texts),
t AS (SELECT doc_id, label, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS term FROM w),
tf AS (SELECT doc_id, label, term, count(*) AS n FROM t GROUP BY ALL),
counts AS (SELECT label, term, sum(n) AS n FROM tf JOIN train USING (doc_id) GROUP BY ALL),
vocabulary AS (SELECT term, sum(n) AS total, count(*) AS df FROM tf JOIN train USING (doc_id) GROUP BY term ORDER BY total DESC, term LIMIT 5000),
classes AS (SELECT label, count(*) AS docs FROM texts JOIN train USING (doc_id) GROUP BY label),
sums AS (SELECT label, sum(n) AS in_class FROM counts JOIN vocabulary USING (term) GROUP BY label),
coefficients AS (SELECT c.label, v.term, ln(((SELECT sum(docs) FROM classes) + 1) / (df + 1)::DOUBLE) + 1 AS idf,
  ln((coalesce(k.n, 0) + 1) / (coalesce(in_class, 0) + (SELECT count(*) FROM vocabulary))::DOUBLE) AS weight
  FROM classes c CROSS JOIN vocabulary v LEFT JOIN sums s ON s.label = c.label LEFT JOIN counts k ON k.label = c.label AND k.term = v.term),
idfs AS (SELECT DISTINCT term, idf FROM coefficients),
norms AS (SELECT doc_id, sqrt(sum(n * idf * n * idf)) AS norm FROM tf JOIN idfs USING (term) GROUP BY doc_id),
dots AS (SELECT doc_id, c.label, sum(n * idf * weight) AS dot FROM tf JOIN coefficients c USING (term) GROUP BY ALL),
scores AS (SELECT x.doc_id, c.label, ln(docs / (SELECT sum(docs) FROM classes)::DOUBLE) + coalesce(dot / norm, 0.0) AS z
  FROM texts x CROSS JOIN classes c LEFT JOIN norms USING (doc_id) LEFT JOIN dots d ON d.doc_id = x.doc_id AND d.label = c.label),
tops AS (SELECT doc_id, max(z) AS top FROM scores GROUP BY doc_id),
chances AS (SELECT doc_id, label, exp(z - top) / sum(exp(z - top)) OVER (PARTITION BY doc_id) AS p FROM scores JOIN tops USING (doc_id))"""
SQL_LANGUAGES = f"""WITH lang_ranked AS (SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5(concat_ws('|', doc_id::VARCHAR, '42')), doc_id) AS rank,
  count(*) OVER (PARTITION BY lang) AS group_size FROM documents),
train AS (SELECT doc_id FROM lang_ranked WHERE (rank - 1) * 100 < 80 * greatest(group_size - 1, 1)),
texts AS (SELECT doc_id, lang AS label, text FROM documents), {SQL_LINEAR}"""


def _linear(spark, folder):
    """Coefficients counted on the training rows, kept as a table, and the probabilities of all documents."""
    split = stratified_split(_examples(spark, folder), "doc_id", "label")
    coefficients = ML.term_weights(split.where("is_train"))
    return ML.linear_probabilities(_examples(spark, folder), "doc_id", "text", coefficients)


@query("M2 M5", f"{SQL_LANGUAGES} SELECT doc_id, label, {sql_round('p', 6)} AS probability FROM chances")
def linear_probabilities(spark, folder):
    return _linear(spark, folder).withColumn("probability", round_exact(F.col("probability"), 6))


@query("M5 P5", f"{SQL_LANGUAGES} SELECT doc_id, label AS type, {sql_round('p', 3)} AS confidence FROM chances WHERE label <> 'en' AND p > 0.5")
def linear_detections(spark, folder):
    kept = ML.confident_classes(_linear(spark, folder), clean="en")
    return kept.select("doc_id", F.col("label").alias("type"), round_exact(F.col("probability"), 3).alias("confidence"))


@query("M2 M4", """WITH ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY md5(concat_ws('|', doc_id::VARCHAR, '42')), doc_id) AS rank,
  count(*) OVER (PARTITION BY lang) AS group_size FROM documents)
SELECT lang AS label, count(*) AS n_rows, 0.0::DOUBLE AS missed_share FROM ranked WHERE (rank - 1) * 100 < 80 * greatest(group_size - 1, 1) GROUP BY lang""")
def classifier_calibration(spark, folder):
    """The fitted regression is saved, loaded and held against the class sizes it was fitted on."""
    train = stratified_split(_examples(spark, folder), "doc_id", "label").where("is_train").select("doc_id", "text", "label")
    path = f"{scratch_folder(spark)}/classifier-{uuid.uuid4().hex}"
    ML.train_classifier(train, path=path)
    found = ML.calibration(ML.load_classifier(path), train)
    missed = F.abs(F.col("expected_rows") - F.col("n_rows")) / F.col("n_rows")
    return found.select("label", "n_rows", round_exact(missed, 1).alias("missed_share"))


@query("M2 M4 A16")
def classifier_report(spark, folder):
    _, scored = ML.train_and_evaluate(_examples(spark, folder), "doc_id")
    return E.classification_report(scored)


@query("M5 P5 U1")
def model_detections(spark, folder):
    split = stratified_split(_examples(spark, folder), "doc_id", "label")
    model = ML.train_classifier(split.where("is_train"))
    return ML.model_detections(split.where("NOT is_train"), ["doc_id"], "text", model, clean="en").select("doc_id", "type", "method", "confidence")
