"""The named queries of the training-data operators, each over a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlark.llm import bpe, embeddings, hardneg, htmltext, imatch, jaccard, langid, licenses, linededup, mixing, toxicity, urlfilter, whitening
from auditlark.llm.samples import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- 1: embedding near-duplicates ----------------------------------------------------

@query
def op1_embedding_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"), threshold=0.95)


# --- 2: byte-level BPE -----------------------------------------------------------

RANKS = "byte_bpe_multi_50k.tiktoken"


@query
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    encoded = bpe.encode(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode(encoded, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


# --- 3: n-gram Jaccard join --------------------------------------------------------

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query
def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, folder, "documents"), words=3, threshold="0.9").select("doc_id", "n_shingles", "component_id", "class_id")


SQL["op3_ngram_jaccard"] = rf"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, list_sort(list_distinct(CASE
        WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
    FROM texts
), classes AS (
    SELECT doc_id, len(s) AS n, s, CASE WHEN len(s) > 0 THEN min(doc_id) OVER (PARTITION BY s) ELSE doc_id END AS class_id FROM sets
), shingles AS (
    SELECT doc_id, n, unnest(s) AS shingle FROM classes WHERE doc_id = class_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), ends AS (
    SELECT a, b FROM pairs UNION SELECT b, a FROM pairs
), reach AS (
    SELECT class_id AS node, class_id AS other FROM classes
    UNION
    SELECT r.node, e.b FROM reach r JOIN ends e ON r.other = e.a
), groups AS (
    SELECT node, min(other) AS component_id FROM reach GROUP BY node
)
SELECT c.doc_id, CAST(c.n AS BIGINT) AS n_shingles, g.component_id, c.class_id FROM classes c JOIN groups g ON c.class_id = g.node
"""


# --- 4: language ID ------------------------------------------------------------------

@query
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model = langid.fit(docs, F.coalesce(fold("doc_id", 4) != 2, F.lit(False)))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")


# --- 5: toxicity -----------------------------------------------------------------------

@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels").where(fold("doc_id", 5) != 0))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), F.size("offending").alias("n_offending"))


# --- 6: license scans ------------------------------------------------------------------------

@query
def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def _license_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def places(phrase: str) -> str:
        test = " AND ".join(f"w[i + {k}] = {quoted(x)}" for k, x in enumerate(phrase.split(" ")))
        return f"list_transform(list_filter(range(1, len(w) + 1), lambda i: {test}), lambda i: i - 1)"

    phrases = ", ".join(f"{places(p)} AS p{k}" for k, (p, _) in enumerate(licenses.PHRASES))
    every = "list_concat(" * (len(licenses.PHRASES) - 1) + "p0" + "".join(f", p{k})" for k in range(1, len(licenses.PHRASES)))
    base = "list_filter([" + ", ".join(f"CASE WHEN len(p{k}) > 0 THEN {quoted(x)} END" for k, (_, x) in enumerate(licenses.PHRASES)) + "], lambda x: x IS NOT NULL)"
    templates = ", ".join(f"({quoted(x)}, list_distinct(string_split({quoted(t)}, ' ')))" for x, t in licenses.TEMPLATES)
    words = f"regexp_extract_all(translate(%s, '{UPPER}', '{LOWER}'), '{licenses.WORD}')"
    return f"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, {words % "coalesce(text, '')"} AS w FROM documents
), placed AS (
    SELECT doc_id, len(w) AS n_words, {phrases} FROM texts
), base AS (
    SELECT doc_id, n_words, {every} AS places, {base} AS base FROM placed
), blocks AS (
    SELECT doc_id, {words % "line"} AS words FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
), templates(label, wanted) AS (
    VALUES {templates}
), found AS (
    SELECT doc_id, label, len(list_intersect(list_distinct(words), wanted)) / len(wanted) AS containment FROM blocks, templates
    WHERE len(list_intersect(list_distinct(words), wanted)) >= ceil(9 * len(wanted) / 10)
), per_doc AS (
    SELECT doc_id, list(DISTINCT label) AS own, max(containment) AS best FROM found GROUP BY doc_id
)
SELECT b.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
    array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(base, coalesce(own, [])))), ',') AS labels,
    CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(best, 0) END::DOUBLE AS score
FROM base b LEFT JOIN per_doc USING (doc_id)"""


SQL["op6_license_scan"] = _license_sql()


# --- 7: line dedup ----------------------------------------------------------------------------

@query
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = linededup.dedupe(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


SQL["op7_line_dedup"] = r"""
WITH docs AS (
    SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL
), wordy AS (
    SELECT *, list_filter(range(0, len(l)), lambda i: regexp_matches(l[i + 1], '[\p{L}\p{N}]')) AS w FROM docs
), spans AS (
    SELECT doc_id, l, unnest(list_concat(list_transform(range(1, len(w)), lambda k: [w[k], w[k + 1]]),
        CASE WHEN w[1] > 0 THEN [[0, w[2]]] ELSE [] END, CASE WHEN w[len(w)] < len(l) - 1 THEN [[w[len(w) - 1], len(l) - 1]] ELSE [] END)) AS se
    FROM wordy WHERE len(w) >= 2
), windows AS (
    SELECT doc_id, se[1] AS s, se[2] AS e, array_to_string(l[se[1] + 1:se[2] + 1], chr(10)) AS passage FROM spans
), placed AS (
    SELECT doc_id, s, e, count(*) OVER (PARTITION BY passage) AS n, row_number() OVER (PARTITION BY passage ORDER BY doc_id, s, e) AS place FROM windows
), gone AS (
    SELECT doc_id, unnest(range(s, e + 1)) AS i FROM placed WHERE n > 1 AND place > 1
    EXCEPT SELECT doc_id, unnest(range(s, e + 1)) FROM placed WHERE n > 1 AND place = 1
), lines AS (
    SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS i FROM docs
), kept AS (
    SELECT x.doc_id, count(*) AS n_lines, count(g.i) AS n_removed, string_agg(line, chr(10) ORDER BY x.i) FILTER (g.i IS NULL) AS text
    FROM lines x LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.i = x.i GROUP BY x.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, length(coalesce(k.text, '')) AS n_chars, sha256(coalesce(k.text, '')) AS text_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""


# --- 8: mixing to target weights ------------------------------------------------------------------

LANGUAGE_TARGETS = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}
QUALITY_TARGETS = {1: 0.9, 0: 0.1}
TARGETS = {f"{lang}/{quality}": a * b for lang, a in LANGUAGE_TARGETS.items() for quality, b in QUALITY_TARGETS.items()}


def domain_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table: language and quality of the documents that have a quality label."""
    return labels.select("doc_id", "quality").join(docs.select("doc_id", "lang"), "doc_id").select(
        "doc_id", F.concat_ws("/", "lang", F.col("quality").cast("string")).alias("domain"))


@query
def op8_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    mixed = mixing.mix(docs.select("doc_id", "text", "lang"), domain_labels(docs, table(spark, folder, "labels")), TARGETS)
    return mixed.select("doc_id", "n_tokens", "domain", "membership", "rate", "copies")


# --- 9: document fingerprints ------------------------------------------------------------------

@query
def op9_imatch(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.compare_edits(table(spark, folder, "documents"))


def _imatch_sql() -> str:
    subsets = [(d, r) for d in imatch.DENSITIES for r in range(imatch.REPEATS)]
    number = "CAST(('0x' || substr(md5(%s), 1, %d)) AS BIGINT)"
    chosen = ", ".join(f"{number % (f"term || '#{r}'", 8)} % {d} = 0 AS s{k}" for k, (d, r) in enumerate(subsets))
    drawn = ", ".join(f"CAST(('0x' || substr(md5(term), {k + 1}, 2)) AS BIGINT) % {d} = 0 AS t{k}" for k, (d, _) in enumerate(subsets))
    n_rest = len(subsets)
    words = f"trim(regexp_replace(translate(%s, '{UPPER}', '{LOWER}'), '{imatch.NO_WORD}', ' ', 'g'))"
    folded = lambda flag: number % (f"string_agg(term, ' ' ORDER BY term) FILTER (WHERE {flag})", 15)
    parts = ", ".join([f"{folded(f's{k}')} AS c{k}" for k in range(len(subsets))] + [f"{folded(f't{k}')} AS r{k}" for k in range(n_rest)])
    band, rest = ("[" + ", ".join(f"{x}{k}" for k in range(n)) + "]" for x, n in (("c", len(subsets)), ("r", n_rest)))
    joined = lambda array: f"array_to_string(list_transform({array}, lambda x: coalesce(CAST(x AS VARCHAR), '')), '.')"
    none = lambda array: f"len(list_filter({array}, lambda x: x IS NOT NULL)) = 0"

    def alike(a: str, b: str) -> str:
        def share(array: str, otherwise: str) -> str:
            zipped = f"list_zip({a}.{array}, {b}.{array})"
            some = f"len(list_filter({zipped}, lambda x: x[1] IS NOT NULL OR x[2] IS NOT NULL))"
            return f"CASE WHEN {some} > 0 THEN len(list_filter({zipped}, lambda x: x[1] = x[2])) / {some} ELSE {otherwise} END"

        agree = f"CAST({a}.words = {b}.words AS DOUBLE)"
        return f"""CASE WHEN {b}.band IS NULL THEN 0 WHEN NOT {none(f'{a}.band')} AND NOT {none(f'{b}.band')} THEN {share('band', agree)}
            WHEN {none(f'{a}.band')} AND {none(f'{b}.band')} THEN {share('rest', agree)} ELSE {agree} END::DOUBLE"""

    return f"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text FROM documents
), said AS (
    SELECT DISTINCT {words % "text"} AS w FROM texts
), terms AS (
    SELECT unnest(list_distinct(string_split(w, ' '))) AS term FROM said
), counts AS (
    SELECT term, count(*) AS n FROM terms WHERE term != '' GROUP BY term HAVING count(*) > 1
), lexicon AS (
    SELECT term, {chosen} FROM counts
    WHERE n >= {imatch.LOW} * (SELECT count(*) FROM said) AND n <= {imatch.HIGH} * (SELECT count(*) FROM said)
), ordered AS (
    SELECT doc_id, text, coalesce(lead(doc_id) OVER o, (SELECT min(doc_id) FROM texts)) AS next_id,
        coalesce(lead(text) OVER o, (SELECT arg_min(text, doc_id) FROM texts)) AS next_text
    FROM texts WINDOW o AS (ORDER BY doc_id)
), edits AS (
    SELECT doc_id, next_id, text, left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) AS edited FROM ordered
), sides AS (
    SELECT doc_id, 0 AS side, {words % "text"} AS w FROM edits UNION ALL SELECT doc_id, 1, {words % "edited"} FROM edits
), hits AS (
    SELECT doc_id, side, nullif(unnest(list_distinct(string_split(w, ' '))), '') AS term FROM sides
), drawn AS (
    SELECT h.*, {", ".join(f"s{k}" for k in range(len(subsets)))}, {drawn} FROM hits h LEFT JOIN lexicon USING (term)
), parts AS (
    SELECT doc_id, side, {parts} FROM drawn GROUP BY doc_id, side
), prints AS (
    SELECT doc_id, side, {band} AS band, {rest} AS rest, md5(w) AS words, {joined(band)} || '|' || CASE WHEN {none(band)} THEN {joined(rest)} ELSE '' END || '|' || md5(w) AS print
    FROM parts JOIN sides USING (doc_id, side)
)
SELECT e.doc_id, length(e.text) AS n_chars, sha256(e.edited) AS edited_sha256, p.print AS fingerprint, q.print AS edited_fingerprint,
    {alike("p", "q")} AS near_edited, {alike("p", "r")} AS near_next
FROM edits e JOIN prints p ON p.doc_id = e.doc_id AND p.side = 0 JOIN prints q ON q.doc_id = e.doc_id AND q.side = 1
LEFT JOIN prints r ON r.doc_id = e.next_id AND r.side = 0"""


SQL["op9_imatch"] = _imatch_sql()


# --- 10: main text of pages ----------------------------------------------------------------

@query
def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return htmltext.extract(pages.select("page_id", "url", "html"), htmltext.fit(pages)).select("page_id", "url", "text", "n_chars")


# --- 11: hard negatives --------------------------------------------------------------------

@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hardneg.mine(rows, F.col("vec_id") % 50 == 0)


SQL["op11_hard_negatives"] = """
WITH usable AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
    SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
    FROM usable a JOIN usable b ON a.id % 50 = 0 AND a.id != b.id
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), ranked AS (
    SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3"""


# --- 12: URL filters -----------------------------------------------------------------------

URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


@query
def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judge(table(spark, folder, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def _url_sql() -> str:
    rows = ", ".join(f"('{v}', '{r[:r.find('/')]}', '{r[r.find('/'):]}')" for v, r in URL_RULES)
    return f"""
WITH rules(verdict, host, path) AS (
    VALUES {rows}
), rest AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), fits AS (
    SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict, row_number() OVER (
        PARTITION BY p.page_id ORDER BY length(r.host) DESC NULLS LAST, length(r.path) DESC, r.verdict DESC) AS place
    FROM parts p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1"""


SQL["op12_url_filter"] = _url_sql()


# --- 13: whitening of embeddings -----------------------------------------------------------------

@query
def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))
