"""From raw documents to token ids: every stage works on what the one before it kept.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of documents.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlark.llm import bpe, jaccard, langid, linededup, mixing, queries, store

CONFIDENT = 0.5
# Shares of tokens by language, and within each of documents of good and of poor quality.
LANGUAGES = {"en": 0.55, "de": 0.16, "es": 0.13, "fr": 0.16}
QUALITY = {1: 0.9, 0: 0.1}
TARGETS = {f"{lang}/{quality}": a * b for lang, a in LANGUAGES.items() for quality, b in QUALITY.items()}


def stage(f):
    """A stage owns the intermediate tables written for it. When the next one starts, its input is a table of its own, so those
    that the input does not read are deleted; a chain of stages that was never written keeps what it needs."""
    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        store.release("pipeline", docs)
        with store.owned("pipeline"):
            return f(spark, docs, sf_dir)

    return run_stage


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose likeliest language has under half the probability; fills a missing ``lang``.

    Learned from the rows that carry a language. Where none does, nothing can be told apart and every document with a letter stays.
    """
    model = langid.fit(docs, F.col("doc_id").isNotNull())
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.predict(docs, model, lang_out="__lang", score_out="__score")
    kept = found.where((F.col("__lang") != langid.UNKNOWN) & (F.col("__score") >= CONFIDENT))
    return kept.withColumn("lang", F.coalesce("lang", "__lang")).select(*docs.columns)


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages out of the texts; a document of which nothing but blanks is left goes, and so do copies of two lines and more."""
    kept = linededup.dedupe(docs)
    kept = kept.where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    return kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


@stage
def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similar five-word shingles the one with the smallest id stays; rows without id stay."""
    groups = jaccard.similar_groups(docs, words=5, threshold="0.8")
    copies = groups.where("doc_id != component_id").select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


@stage
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that the domains' tokens approach the target weights; every document stays at least once."""
    labels = queries.domain_labels(docs, queries.table(spark, sf_dir, "labels"))
    return mixing.expand(mixing.mix(docs, labels, TARGETS, keep_all=True, at_least=1), docs.columns)


@stage
def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text as packed little-endian 32-bit integers, and the digest of the bytes they decode to."""
    path = public_tokenizers.path(queries.RANKS)
    decoded = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path)
    return decoded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]

#: Fitted models and byte-pair merges have no SQL form; a brute-force version tests the result instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        kept = step(spark, docs, sf_dir)
        with store.owned("pipeline"):
            docs = store.written(kept, name)
    return STAGES[-1][1](spark, docs, sf_dir)
