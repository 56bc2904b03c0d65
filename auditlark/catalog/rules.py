"""Rules extracted from statute texts; every document source is one corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlark.catalog.registry import DATA_PACK, joined, query, quoted, sql_any, sql_first, sql_kept, table
from auditlark.operators import rules as R
from auditlark.rulepack import DEFAULT_PACK


def sql_digits(text: str, pack) -> str:
    for word, digits in pack.number_words:
        text = f"replace({text}, {quoted(word)}, {quoted(digits)})"
    return text


def sql_corpora(pack, relation: str = "documents") -> str:
    """Per corpus: term flags, threshold levels, first captures."""
    terms = {
        "c": list(pack.categories),
        "r": [t for _, ts in pack.statute_rights for t in ts],
        "e": [t for _, ts in pack.exemptions for t in ts],
    }
    flags = [f"bool_or(contains(lc, {quoted(t)})) AS {g}{i}" for g, ts in terms.items() for i, t in enumerate(ts)]
    levels = [
        "bool_or(" + " OR ".join(f"regexp_matches(dg, {quoted(p)})" for p in patterns) + f") AS level{i}"
        for i, (_, _, patterns) in enumerate(pack.threshold_levels)
    ]
    captures = [
        f"arg_min(TRY_CAST(regexp_extract(dg, {quoted(p)}, 1) AS BIGINT), doc_id) FILTER (WHERE TRY_CAST(regexp_extract(dg, {quoted(p)}, 1) AS BIGINT) IS NOT NULL) AS {key}_{i}"
        for key, patterns in pack.timelines for i, p in enumerate(patterns)
    ]
    return (
        f"docs AS (SELECT source, doc_id, text, lower(text) AS lc, {sql_digits('lower(text)', pack)} AS dg FROM {relation}), "
        f"corpora AS (SELECT source AS corpus_id, count(*) AS n_docs, sum(length(text))::BIGINT AS total_text_length, "
        f"{', '.join(flags + levels + captures)} FROM docs GROUP BY source)"
    )


def sql_rules(pack, relation: str = "documents") -> str:
    position = 0
    evidence, rights = [], []
    for right, terms in pack.statute_rights:
        cases = " ".join(f"WHEN r{position + k} THEN {quoted(right + '=' + t)}" for k, t in enumerate(terms))
        evidence.append(f"CASE {cases} END")
        rights.append("CASE WHEN " + " OR ".join(f"r{position + k}" for k in range(len(terms))) + f" THEN {quoted(right)} END")
        position += len(terms)
    exemptions, position = [], 0
    for name, terms in pack.exemptions:
        exemptions.append("CASE WHEN " + " OR ".join(f"e{position + k}" for k in range(len(terms))) + f" THEN {quoted(name)} END")
        position += len(terms)
    categories = [f"CASE WHEN c{i} THEN {quoted(c)} END" for i, c in enumerate(pack.categories)]
    value = "CASE " + " ".join(f"WHEN level{i} THEN {v}" for i, (v, _, _) in enumerate(pack.threshold_levels)) + " END"
    confidence = "CASE " + " ".join(f"WHEN level{i} THEN {c}" for i, (_, c, _) in enumerate(pack.threshold_levels)) + f" ELSE {pack.threshold_unknown_confidence} END"
    days = {key: "coalesce(" + ", ".join(f"{key}_{i}" for i in reversed(range(len(p)))) + ")" for key, p in pack.timelines}
    default_key, default_days, default_source = pack.default_timeline
    found = " + ".join(f"(CASE WHEN {d} IS NOT NULL THEN 1 ELSE 0 END)" for d in days.values())
    return f"""
WITH {sql_corpora(pack, relation)}, lists AS (SELECT *, {sql_kept(categories)} AS cats, {sql_kept(rights)} AS rights,
     {sql_kept(evidence)} AS evidence, {sql_kept(exemptions)} AS exempt FROM corpora)
SELECT corpus_id, n_docs, total_text_length, CAST({value} AS BIGINT) AS threshold, CAST({confidence} AS DOUBLE) AS threshold_confidence,
       array_to_string(cats, ',') AS categories, CASE WHEN len(cats) > 0 THEN 0.9 ELSE 0.4 END::DOUBLE AS category_confidence,
       array_to_string(list_sort(rights), ',') AS rights, array_to_string(list_sort(evidence), ',') AS evidence,
       CASE WHEN len(rights) >= 4 THEN 0.85 ELSE 0.6 END::DOUBLE AS rights_confidence,
       array_to_string(list_sort(exempt), ',') AS exemptions,
       coalesce({days[default_key]}, {default_days})::BIGINT AS response_days, {days['cure_period_days']} AS cure_days,
       {days['appeal_response_days']} AS appeal_days,
       CASE WHEN {days[default_key]} IS NULL THEN {quoted(default_source)} END AS response_days_source,
       CASE WHEN {found} + (CASE WHEN {days[default_key]} IS NULL THEN 2 ELSE 0 END) > 1 THEN 0.8 ELSE 0.5 END::DOUBLE AS timeline_confidence
FROM lists"""


def _flat(rules):
    pairs = lambda m: F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")
    days = lambda key: F.try_element_at("timeline_rules.timelines", F.lit(key))
    return rules.select(
        "corpus_id", "n_docs", "total_text_length", F.col("threshold.value").alias("threshold"),
        F.col("threshold.confidence").alias("threshold_confidence"),
        joined("sensitive_data.categories").alias("categories"), F.col("sensitive_data.confidence").alias("category_confidence"),
        joined("consumer_rights.rights").alias("rights"), pairs(F.col("consumer_rights.evidence")).alias("evidence"),
        F.col("consumer_rights.confidence").alias("rights_confidence"),
        joined(F.array_sort(F.map_keys("exemption_rules.exemptions"))).alias("exemptions"),
        days("consumer_request_response_days").alias("response_days"), days("cure_period_days").alias("cure_days"),
        days("appeal_response_days").alias("appeal_days"), F.col("timeline_rules.response_days_source").alias("response_days_source"),
        F.col("timeline_rules.confidence").alias("timeline_confidence"),
    )


@query("A11 A12 A19 F4 F5 F6 F7 F8 F9 J13 W2 W3", sql_rules(DATA_PACK))
def statute_rules(spark, folder):
    docs = table(spark, folder, "documents", ["source", "doc_id", "text"], heavy=True)
    return _flat(R.extract_rules(docs, "source", "doc_id", "text", DATA_PACK))


@query("A11 A12 F4 F5 F6 F7 F8 F9 (fixed rule pack)", sql_rules(DEFAULT_PACK))
def statute_rules_fixed_pack(spark, folder):
    docs = table(spark, folder, "documents", ["source", "doc_id", "text"], heavy=True)
    return _flat(R.extract_rules(docs, "source", "doc_id", "text"))


@query("J13 W2", "SELECT doc_id, " + sql_first("lower(text)", [t for _, ts in DATA_PACK.statute_rights for t in ts]) + " AS first_phrase, "
       + "array_to_string(" + sql_kept(f"CASE WHEN {sql_any('lower(text)', ts)} THEN {quoted(n)} END" for n, ts in DATA_PACK.exemptions) + ", ',') AS exemptions, "
       + "array_to_string(" + sql_kept(f"CASE WHEN contains(lower(text), {quoted(c)}) THEN {quoted(c)} END" for c in DATA_PACK.categories) + ", ',') AS categories FROM documents")
def dictionary_probe(spark, folder):
    from auditlark.functions import text as X

    docs = table(spark, folder, "documents", ["doc_id", "text"], heavy=True)
    terms = [t for _, ts in DATA_PACK.statute_rights for t in ts]
    probed = docs.select("doc_id", X.once(X.let(F.lower("text"), lambda t: F.struct(
        X.first_term(t, terms).alias("first_phrase"),
        joined(F.array_compact(F.array(*[F.when(X.contains_any(t, ts), n) for n, ts in DATA_PACK.exemptions]))).alias("exemptions"),
        joined(F.array_compact(F.array(*[F.when(F.contains(t, F.lit(c)), c) for c in DATA_PACK.categories]))).alias("categories")))))
    return probed
