"""How well privacy policies cover the required consumer rights.

A rule pack names a handful of rights. They travel as literals inside the
expression that scores a document, so each document is scored where it is
read: no join, no row per (paragraph, right) pair.
"""

from __future__ import annotations

import dataclasses
import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlark.functions import numbers as N
from auditlark.functions import text as X
from auditlark.functions.literals import constant
from auditlark.rulepack import APPEAL_CONFIDENCE, DEFAULT_PACK, RulePack

MAX_TERMS = 5000


def paragraph_rows(docs: DataFrame, keys: list[str], text: str, min_length: int = 30) -> DataFrame:
    """One row per paragraph with its position."""
    parts = X.once(F.struct(X.paragraphs(F.col(text), min_length).alias("__parts")))
    return docs.select(*keys, parts).select(*keys, F.posexplode("__parts").alias("para_no", "paragraph"))


def _terms(text: Column, length: int) -> Column:
    """The words of a text in lower case, cut to ``length`` characters so that a word's forms fall together, and all pairs of neighbours."""
    words = F.transform(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(X.WORD), F.lit(0)), lambda w: F.left(w, F.lit(length)))

    def with_pairs(found: Column) -> Column:
        rest = F.greatest(F.size(found) - 1, F.lit(0))
        return F.concat(found, F.zip_with(F.slice(found, F.lit(1), rest), F.slice(found, F.lit(2), rest), lambda a, b: F.concat(a, F.lit(" "), b)))

    return X.let(words, with_pairs)


@dataclasses.dataclass(frozen=True)
class TermTable:
    """Inverse paragraph frequencies of the terms that a score looks at, and the rights as vectors over them.

    It holds the terms (words and pairs) of the rights and the ``limit`` most frequent others of the paragraphs, so it is as bounded as the rule pack.
    A term weighs (1 + ln n) (ln((paragraphs + 1) / (those with it + 1)) + 1/2): what stands everywhere counts little.
    """

    idf: dict[str, float]
    rights: list[tuple[str, dict[str, float]]]
    stem_length: int

    @classmethod
    def count(cls, policies: DataFrame, text: str, pack: RulePack = DEFAULT_PACK, limit: int = MAX_TERMS, stem_length: int = 5) -> TermTable:
        """Counted over the paragraphs of all policies in one pass; only this table reaches the driver."""
        word = re.compile(X.PYTHON_WORD)
        rights = []
        for right, description, _ in pack.policy_rights:
            words = [w[:stem_length] for w in word.findall(description.lower())]
            rights.append((right, Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])))
        own = sorted({w for _, words in rights for w in words})
        paragraphs = policies.select(X.once(F.struct(X.paragraphs(F.col(text)).alias("parts")))).select(F.explode("parts").alias("part"))
        seen = paragraphs.select(F.explode(F.concat(F.array(F.lit("")), F.array_distinct(_terms(F.col("part"), stem_length)))).alias("word"))  # one blank word each
        counts = seen.groupBy("word").count().withColumn("own", F.col("word").isin("", *own))
        top = counts.orderBy(F.desc("own"), F.desc("count"), "word").limit(limit + len(own) + 1).collect()
        found = {r["word"]: r["count"] for r in top if r["own"]}
        n = found.pop("", 0)
        others = [(r["word"], r["count"]) for r in top if not r["own"]][:limit]
        frequency = {**dict.fromkeys(own, 0), **found, **dict(others)}
        idf = {w: math.log((n + 1) / (k + 1)) + 0.5 for w, k in frequency.items()}

        def unit(words: Counter) -> dict[str, float]:
            weights = {w: (1 + math.log(k)) * idf[w] for w, k in sorted(words.items())}
            norm = math.sqrt(sum(x * x for x in weights.values())) or 1.0
            return {w: x / norm for w, x in weights.items()}

        return cls(idf, [(r, unit(words)) for r, words in rights], stem_length)

    def scores(self, text: Column) -> Column:
        """Best cosine of a text's paragraphs per right, in the order of the rights."""
        own = sorted({w for _, weights in self.rights for w in weights})
        slot = {w: i for i, w in enumerate(own)}
        n_cells = max(1, len(self.idf) // 4)
        cells = [{} for _ in range(n_cells)]  # a map is searched from its start, so the table is many short maps
        for w, x in self.idf.items():
            cells[zlib.crc32(w.encode()) % n_cells][w] = {"idf": x, "slot": slot.get(w, -1)}
        table = F.from_json(F.lit(json.dumps(cells)), "array<map<string,struct<idf:double,slot:int>>>")
        vectors = F.from_json(F.lit(json.dumps([[weights.get(w, 0.0) for w in own] for _, weights in self.rights])), "array<array<double>>")

        def weighted(pair: Column) -> Column:
            cell = F.get(table, F.pmod(F.crc32(pair["word"].cast("binary")), F.lit(n_cells)).cast("int"))
            return X.let(F.try_element_at(cell, pair["word"]), lambda e: F.when(e.isNotNull(), F.struct(
                e["slot"].alias("slot"), ((1 + F.ln(pair["n"].cast("double"))) * e["idf"]).alias("w"))))

        def paragraph(terms: Column) -> Column:
            norm = F.sqrt(F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t["w"] * t["w"]))
            hits = F.filter(terms, lambda t: t["slot"] >= 0)
            dots = X.let(hits, lambda h: F.transform(vectors, lambda v: F.aggregate(h, F.lit(0.0), lambda acc, t: acc + t["w"] * F.get(v, t["slot"]))))
            return X.let(norm, lambda length: F.transform(dots, lambda d: F.when(length > 0, d / length).otherwise(F.lit(0.0))))

        per_paragraph = F.transform(X.paragraphs(text), lambda p: X.let(
            F.array_compact(F.transform(X.frequencies(_terms(p, self.stem_length)), weighted)), paragraph))
        return X.let(per_paragraph, lambda rows: F.transform(
            F.sequence(F.lit(0), F.lit(len(self.rights) - 1)), lambda k: F.array_max(F.transform(rows, lambda r: F.get(r, k)))))

    def paragraph_scores(self, rows: DataFrame, text: str) -> DataFrame:
        """The rows with ``scores``, a paragraph's cosine per right in the order of the rights, in place of the paragraph.

        The known terms of a paragraph are a sparse vector; a batch of them times the matrix of the rights gives the scores where the texts are read.
        """
        vocabulary = list(self.idf) or [""]
        matrix = np.zeros((len(vocabulary), len(self.rights) + 1))  # the idf of a term and its weights in the rights
        for i, w in enumerate(vocabulary):
            matrix[i] = [self.idf.get(w, 0.0), *(weights.get(w, 0.0) for _, weights in self.rights)]
        kept = [f for f in rows.schema.fields if f.name != text]
        schema = T.StructType([*kept, T.StructField("scores", T.ArrayType(T.DoubleType()))])
        n_rights = len(self.rights)

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                places, counts = batch.column("places"), batch.column("n")
                at, row = places.flatten().to_numpy(), np.repeat(np.arange(batch.num_rows), np.diff(places.offsets.to_numpy()))
                w = (1 + np.log(counts.flatten().to_numpy())) * matrix[at, 0]
                norm = np.sqrt(np.bincount(row, w * w, batch.num_rows))
                dots = [np.bincount(row, w * matrix[at, k + 1], batch.num_rows) for k in range(n_rights)]
                cosines = [np.divide(d, norm, out=np.zeros(batch.num_rows), where=norm > 0) for d in dots]
                flat = pa.array(np.stack(cosines, axis=1).ravel() if cosines else np.zeros(0))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * n_rights), flat)
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), lists], schema.names)

        listed = rows.select(*(f.name for f in kept), X.once(F.struct(_terms(F.col(text), self.stem_length).alias("terms"))))
        counted = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="terms", outputCol="tf").transform(listed)
        vector = F.unwrap_udt(F.col("tf"))
        found = counted.select(*(f.name for f in kept), X.once(F.struct(vector["indices"].alias("places"), vector["values"].alias("n"))))
        return found.mapInArrow(scored, schema)


def keyword_flags(text: Column, pack: RulePack = DEFAULT_PACK) -> Column:
    """Per right: does the whole policy hold one of its keywords?"""
    table = constant([[k.lower() for k in keywords] for _, _, keywords in pack.policy_rights])
    return X.let(F.lower(text), lambda t: F.transform(table, lambda ks: F.exists(ks, lambda k: F.contains(t, k))))


def coverage_from_text(
    policies: DataFrame, entity: str, text: str, pack: RulePack = DEFAULT_PACK, terms: TermTable | None = None
) -> DataFrame:
    """Coverage rows ``entity_id, right, best_score, keyword_found, covered``.

    A score is the cosine of TF-IDF vectors of a paragraph and a right's description. An
    entity may own any number of policy documents. Each is scored where it is
    read, against ``terms`` (counted over these policies unless given), and
    folds into one maximum and one flag per right before the shuffle; rows per
    right exist only after it.
    """
    terms = terms or TermTable.count(policies, text, pack)
    parts = policies.select(
        F.col(entity).alias("entity_id"),
        X.once(F.struct(X.paragraphs(F.col(text)).alias("parts"), keyword_flags(F.col(text), pack).alias("flags"))),
    ).select("entity_id", "flags", F.explode_outer("parts").alias("part"))
    scored = terms.paragraph_scores(parts, "part")
    places = range(len(pack.policy_rights))
    grouped = scored.groupBy("entity_id").agg(
        *[F.max(F.get("scores", F.lit(i))).alias(f"s{i}") for i in places],
        *[F.bool_or(F.get("flags", F.lit(i))).alias(f"k{i}") for i in places],
    )
    scores, flags = F.array(*[F.col(f"s{i}") for i in places]), F.array(*[F.col(f"k{i}") for i in places])
    rows = F.transform(constant([r for r, _, _ in pack.policy_rights]), lambda right, i: F.struct(
        right.alias("right"), F.greatest(F.get(scores, i), F.lit(0.0)).alias("best_score"),
        F.coalesce(F.get(flags, i), F.lit(False)).alias("keyword_found")))
    return _covered(grouped.select("entity_id", F.inline(rows)), pack.lexical_strong, pack.lexical_with_keyword)


def best_vector_match(
    vectors: DataFrame, entity: str, vector: str, rights: DataFrame, right: str, right_vector: str
) -> DataFrame:
    """Best cosine per entity and right over vector columns, at least 0.

    The rights, few as a rule pack's, enter every row as one scalar subquery; a task keeps one maximum per entity and right.
    """
    packed = rights.agg(F.sort_array(F.collect_list(F.struct(
        F.col(right).alias("right"), F.col(right_vector).cast("array<double>").alias("vector")
    ))))
    scores = F.transform("refs", lambda r: F.struct(r["right"].alias("right"), N.cosine(F.col("v"), r["vector"]).alias("score")))
    rows = vectors.select(F.col(entity).alias("entity_id"), F.col(vector).cast("array<double>").alias("v"), packed.scalar().alias("refs"))
    return rows.select("entity_id", F.inline(scores)).groupBy("entity_id", "right").agg(F.greatest(F.max("score"), F.lit(0.0)).alias("best_score"))


def coverage_from_scores(scores: DataFrame, policies: DataFrame, entity: str, text: str, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """Coverage rows for scores of any origin plus the keyword test on the policies."""
    names = constant([r for r, _, _ in pack.policy_rights])
    flags = (
        policies.select(F.col(entity).alias("entity_id"),
                        F.explode(F.arrays_zip(names.alias("right"), keyword_flags(F.col(text), pack).alias("flag"))).alias("f"))
        .groupBy("entity_id", F.col("f.right").alias("right"))
        .agg(F.bool_or("f.flag").alias("keyword_found"))
    )
    joined = scores.join(flags, ["entity_id", "right"], "left").withColumn(
        "keyword_found", F.coalesce("keyword_found", F.lit(False))
    )
    return _covered(joined, pack.similarity_strong, pack.similarity_with_keyword)


def encode(texts: DataFrame, text: str, make_encoder, output: str = "vector") -> DataFrame:
    """Add vectors from a user's encoder.

    ``make_encoder()`` runs once per task, so a model is loaded once there; it
    returns a function of a pandas Series of texts to a Series of float lists.
    """
    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = make_encoder()
        for batch in batches:
            yield encoder(batch)

    return texts.withColumn(output, run(F.col(text)))


def _covered(rows: DataFrame, strong: float, with_keyword: float) -> DataFrame:
    best = F.col("best_score")
    covered = (best >= strong) | (F.col("keyword_found") & (best >= with_keyword))
    return rows.select("entity_id", "right", "best_score", "keyword_found", covered.alias("covered"))


def missing_rights(coverage: DataFrame, required: DataFrame | None = None, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """MISSING_RIGHT rows: required rights an entity's policy does not cover.

    ``required`` (``entity_id, right``) limits the rights looked at; entities
    without a row there are held to the policy rights of the pack.
    """
    texts = F.map_from_entries(constant([{"right": r, "text": d} for r, d, _ in pack.described_rights]))
    standard = F.col("right").isin([r for r, _, _ in pack.policy_rights])
    if required is not None:
        listed = required.groupBy("entity_id").agg(F.collect_set("right").alias("listed"))
        coverage = coverage.join(listed, "entity_id", "left").where(
            F.coalesce(F.array_contains("listed", F.col("right")), standard)
        )
    else:
        coverage = coverage.where(standard)
    best = F.col("best_score")
    return coverage.where(~F.col("covered")).select(
        "entity_id",
        F.lit("MISSING_RIGHT").alias("type"),
        "right",
        F.when(F.col("right").isin(*pack.high_severity_rights), "HIGH").otherwise("MEDIUM").alias("severity"),
        N.round_exact(1 - best, 4).alias("confidence"),
        N.round_exact(best, 4).alias("similarity_score"),
        F.coalesce(F.try_element_at(texts, F.col("right")), F.concat(F.lit("right to "), F.col("right"))).alias("description"),
    )


def appeal_quality(policies: DataFrame, entity: str, text: str, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """Appeal clause per entity: ``has_appeal, quality, matched_terms, confidence``."""
    terms = list(pack.appeal_terms) + list(pack.appeal_detail_terms)
    names = [f"mask_{i}" for i in range(len(X.term_masks(F.lit(""), terms)))]
    masks = X.let(F.lower(F.coalesce(F.col(text), F.lit(""))), lambda t: F.struct(*[m.alias(n) for m, n in zip(X.term_masks(t, terms), names)]))
    per_entity = policies.select(F.col(entity).alias("entity_id"), X.once(masks)).groupBy("entity_id").agg(*[F.bit_or(n).alias(n) for n in names])
    numbered = X.mask_terms([("basic", pack.appeal_terms), ("detailed", pack.appeal_detail_terms)])
    basic, detailed = [X.seen_terms([F.col(n) for n in names], constant(row["terms"])) for row in numbered]
    confidence = F.create_map(*[x for q, c in APPEAL_CONFIDENCE
                                for x in (F.lit(q), F.lit(c))])
    return (
        per_entity.select("entity_id", basic.alias("basic"), detailed.alias("detailed"))
        .withColumn("quality", F.when(F.size("detailed") > 0, "DETAILED").when(F.size("basic") > 0, "BASIC").otherwise("MISSING"))
        .select(
            "entity_id",
            (F.col("quality") != "MISSING").alias("has_appeal"),
            "quality",
            F.concat("basic", "detailed").alias("matched_terms"),
            F.element_at(confidence, F.col("quality")).alias("confidence"),
        )
    )
