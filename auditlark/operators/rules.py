"""Extracting rules from statute texts, one row per corpus.

Documents are never joined into one text. Each leaves booleans, masks and
captured numbers; the corpus is a grouped aggregate over those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlark.functions import text as X
from auditlark.functions.literals import constant
from auditlark.rulepack import DEFAULT_PACK, RulePack


def _dictionary_terms(pack: RulePack) -> list[str]:
    return (
        list(pack.categories)
        + [t for _, terms in pack.statute_rights for t in terms]
        + [t for _, terms in pack.exemptions for t in terms]
    )


def document_features(docs: DataFrame, corpus: str, order: str, text: str, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """Per document: size, terms seen, threshold levels hit, captured days. No shuffle."""
    terms = _dictionary_terms(pack)

    def facts(t: Column, digits: Column) -> Column:
        fields = [m.alias(f"m{j}") for j, m in enumerate(X.term_masks(t, terms))]
        fields += [
            F.array_max(F.array(*[X.has_pattern(digits, p, pack.needs(p)) for p in patterns])).alias(f"level{i}")
            for i, (_, _, patterns) in enumerate(pack.threshold_levels)
        ]
        for key, patterns in pack.timelines:
            for i, p in enumerate(patterns):
                captured = F.regexp_extract(digits, X.REGEX_FLAGS + p, 1)
                days = F.when(captured != "", captured.try_cast("bigint"))
                if pack.needs(p):
                    days = F.when(X.contains_any(digits, pack.needs(p)), days)
                fields.append(days.alias(f"{key}_{i}"))
        return F.struct(*fields)

    return docs.select(
        F.col(corpus).alias("corpus_id"),
        F.col(order).alias("doc_order"),
        F.length(text).cast("bigint").alias("n_chars"),
        X.once(X.let(F.lower(F.coalesce(F.col(text), F.lit(""))), lambda t: X.let(
            X.number_words_to_digits(t, pack), lambda digits: facts(t, digits)))),
    )


def extract_rules(docs: DataFrame, corpus: str, order: str, text: str, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """One rule row per corpus: threshold, categories, rights, exemptions, timelines.

    ``order`` gives the reading order of the documents; the first capture of a
    pattern in that order counts.
    """
    features = document_features(docs, corpus, order, text, pack)
    n_masks = -(-len(_dictionary_terms(pack)) // X.TERMS_PER_MASK)
    captures = [(key, i) for key, patterns in pack.timelines for i, _ in enumerate(patterns)]
    grouped = features.groupBy("corpus_id").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum("n_chars"), F.lit(0)).cast("bigint").alias("total_text_length"),
        *[F.coalesce(F.bit_or(f"m{j}"), F.lit(0).cast("bigint")).alias(f"m{j}") for j in range(n_masks)],
        *[F.coalesce(F.bool_or(f"level{i}"), F.lit(False)).alias(f"level{i}")
          for i in range(len(pack.threshold_levels))],
        *[
            F.min_by(
                F.col(f"{key}_{i}"),
                F.when(F.col(f"{key}_{i}").isNotNull(), F.col("doc_order")),
            ).alias(f"{key}_{i}")
            for key, i in captures
        ],
    )
    return _rule_rows(grouped, n_masks, pack)


def _rule_rows(grouped: DataFrame, n_masks: int, pack: RulePack) -> DataFrame:
    masks = [F.col(f"m{j}") for j in range(n_masks)]
    groups = [("categories", pack.categories), *pack.statute_rights, *pack.exemptions]
    numbered = X.mask_terms(groups)
    n_rights = len(pack.statute_rights)
    categories = X.seen_terms(masks, constant(numbered[0]["terms"]))
    phrases = F.transform(constant(numbered[1:1 + n_rights]), lambda r: F.struct(
        r["name"].alias("right"), F.get(X.seen_terms(masks, r["terms"]), F.lit(0)).alias("phrase")))
    evidence = F.filter(phrases, lambda e: e["phrase"].isNotNull())
    named = F.filter(constant(numbered[1 + n_rights:]), lambda r: F.size(X.seen_terms(masks, r["terms"])) > 0)
    exemptions = F.map_from_entries(F.transform(named, lambda r: F.struct(r["name"].alias("key"), F.lit(True).alias("value"))))

    value, confidence = F.lit(None).cast("bigint"), F.lit(pack.threshold_unknown_confidence)
    for i, (level, level_confidence, _) in reversed(list(enumerate(pack.threshold_levels))):
        value = F.when(F.col(f"level{i}"), F.lit(level).cast("bigint")).otherwise(value)
        confidence = F.when(F.col(f"level{i}"), F.lit(level_confidence)).otherwise(confidence)

    default_key, default_days, default_source = pack.default_timeline
    days = []
    for key, patterns in pack.timelines:
        found = F.coalesce(*[F.col(f"{key}_{i}") for i in reversed(range(len(patterns)))])
        days.append((key, found))
    defaulted = dict(days)[default_key].isNull()
    entries = F.array_compact(F.array(*[
        F.when(d.isNotNull() | F.lit(key == default_key),
               F.struct(F.lit(key).alias("key"),
                        (F.coalesce(d, F.lit(default_days)) if key == default_key else d).cast("bigint").alias("days")))
        for key, d in days
    ]))
    # The mark for an assumed default counts as one more key.
    n_keys = F.size(entries) + F.when(defaulted, 1).otherwise(0)

    return grouped.select(
        "corpus_id",
        F.struct(value.alias("value"), F.lit("consumers").alias("unit"), confidence.alias("confidence"),
                 F.when(value.isNull(), F.lit("threshold not clearly identified")).alias("note")).alias("threshold"),
        F.struct(categories.alias("categories"), F.size(categories).alias("total_found"),
                 F.lit(len(pack.categories)).alias("total_possible"),
                 F.when(F.size(categories) > 0, 0.9).otherwise(0.4).alias("confidence")).alias("sensitive_data"),
        F.struct(F.array_sort(F.transform(evidence, lambda e: e["right"])).alias("rights"),
                 F.map_from_entries(evidence).alias("evidence"),
                 F.when(F.size(evidence) >= 4, 0.85).otherwise(0.6).alias("confidence")).alias("consumer_rights"),
        F.struct(exemptions.alias("exemptions"), F.lit(0.85).alias("confidence")).alias("exemption_rules"),
        F.struct(F.map_from_entries(entries).alias("timelines"),
                 F.when(defaulted, F.lit(default_source)).alias("response_days_source"),
                 F.when(n_keys > 1, 0.8).otherwise(0.5).alias("confidence")).alias("timeline_rules"),
        "n_docs",
        "total_text_length",
    )


def file_metadata(docs: DataFrame, file: str, text: str, page: str | None = None) -> DataFrame:
    """Pages and characters per file; a file without text is an error row."""
    return docs.groupBy(F.col(file).alias("file")).agg(
        (F.count(page) if page else F.count(F.lit(1))).alias("pages"),
        F.coalesce(F.sum(F.length(text)), F.lit(0)).cast("bigint").alias("chars_extracted"),
        F.when(F.count(text) == 0, F.lit("no text could be extracted")).alias("error"),
    )
