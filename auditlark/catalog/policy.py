"""Coverage of rights by policy texts and vectors, and what is left undisclosed."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlark.catalog.documents import sql_html_text
from auditlark.catalog.forensics import sql_detections, sql_scan
from auditlark.catalog.registry import DATA_PACK, joined, query, quoted, sql_any, sql_kept, sql_round, table
from auditlark.functions import numbers as N
from auditlark.functions import text as X
from auditlark.operators import forensics as FO
from auditlark.operators import policy as P
from auditlark.operators import violations as V

SQL_BLANK_LINE = r"\n\s*\n"
SQL_HEADING = r"(\n\s*(?:\d+\.|[A-Z][.)]\s|#{1,3}\s|Section\s))"


def sql_paragraphs(text: str) -> str:
    """Cut at marks put on every break, strip, keep 30 characters and more."""
    marked = (f"regexp_replace(regexp_replace({text}, {quoted(SQL_BLANK_LINE)}, chr(1), 'g'), {quoted(SQL_HEADING)}, chr(1) || '\\1', 'g')")
    parts = f"list_transform(string_split({marked}, chr(1)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g'))"
    kept = f"list_filter({parts}, lambda x: length(x) >= 30)"
    return f"CASE WHEN len({kept}) > 0 THEN {kept} ELSE [{text}] END"


@query("F10 P6", f"""
WITH p AS (SELECT doc_id, {sql_paragraphs('text')} AS ps FROM documents)
SELECT doc_id, i - 1 AS para_no, length(ps[i])::BIGINT AS n_chars, md5(ps[i]) AS text_md5 FROM p, unnest(range(1, len(ps) + 1)) AS u(i)""")
def policy_paragraphs(spark, folder):
    docs = table(spark, folder, "documents", ["doc_id", "text"], heavy=True)
    return P.paragraph_rows(docs, ["doc_id"], "text").select(
        "doc_id", F.col("para_no").cast("bigint").alias("para_no"), F.length("paragraph").cast("bigint").alias("n_chars"),
        F.md5("paragraph").alias("text_md5"))


def _sql_terms(text: str) -> str:
    words = f"list_transform(regexp_extract_all(lower({text}), {quoted(X.WORD)}), lambda w: left(w, 5))"
    return f"list_concat({words}, list_transform(range(1, len({words})), lambda i: ({words})[i] || ' ' || ({words})[i + 1]))"


def sql_coverage(pack=DATA_PACK, relation: str = "documents", entity: str = "source") -> str:
    rights = " UNION ALL ".join(f"SELECT {quoted(r)} AS \"right\", {_sql_terms(quoted(d))} AS st, {i} AS pos" for i, (r, d, _) in enumerate(pack.policy_rights))
    flags = "[" + ", ".join((sql_any("lower(text)", [k.lower() for k in ks]) if ks else "false") for _, _, ks in pack.policy_rights) + "]"
    return f"""
rights AS ({rights}),
docs AS (SELECT doc_id, {entity} AS source, {sql_paragraphs('text')} AS ps, {flags} AS flags FROM {relation}),
words AS (SELECT doc_id, i AS p, source, list_transform(regexp_extract_all(lower(ps[i]), {quoted(X.WORD)}), lambda w: left(w, 5)) AS ws
  FROM docs, unnest(range(1, len(ps) + 1)) AS u(i)),
paras AS (SELECT doc_id, p, source, list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS st FROM words),
tf AS (SELECT doc_id, p, source, stem, 1 + ln(count(*)) AS tf FROM (SELECT doc_id, p, source, unnest(st) AS stem FROM paras) GROUP BY ALL),
rtf AS (SELECT "right", pos, stem, 1 + ln(count(*)) AS tf FROM (SELECT "right", pos, unnest(st) AS stem FROM rights) GROUP BY ALL),
df AS (SELECT stem, count(*) AS df FROM tf GROUP BY stem),
vocabulary AS (SELECT own.stem, coalesce(df, 0) AS df FROM (SELECT DISTINCT stem FROM rtf) own LEFT JOIN df USING (stem)
  UNION ALL (SELECT stem, df FROM df WHERE stem NOT IN (SELECT stem FROM rtf) ORDER BY df DESC, stem LIMIT 5000)),
idf AS (SELECT stem, ln(((SELECT count(*) FROM paras) + 1) / (df + 1)::DOUBLE) + 0.5 AS idf FROM vocabulary),
weights AS (SELECT doc_id, p, source, stem, tf * idf AS w FROM tf JOIN idf USING (stem)),
norms AS (SELECT doc_id, p, sqrt(sum(w * w)) AS norm FROM weights GROUP BY ALL),
rweights AS (SELECT "right", pos, stem, tf * idf AS w FROM rtf JOIN idf USING (stem)),
rnorms AS (SELECT "right", sqrt(sum(w * w)) AS norm FROM rweights GROUP BY ALL),
scored AS (SELECT a.doc_id, a.p, source, b."right", sum(a.w * b.w) AS dot FROM weights a JOIN rweights b USING (stem) GROUP BY ALL),
top AS (SELECT source, "right", max(dot / (n.norm * r.norm)) AS best FROM scored JOIN norms n USING (doc_id, p) JOIN rnorms r USING ("right") GROUP BY ALL),
found AS (SELECT source, "right", bool_or(flags[pos + 1]) AS keyword_found FROM docs, rights GROUP BY ALL),
best AS (SELECT f.source AS entity_id, f."right", coalesce(best, 0.0) AS best_score, keyword_found FROM found f LEFT JOIN top t ON f.source = t.source AND f."right" = t."right"),
coverage AS (SELECT *, best_score >= {pack.lexical_strong} OR (keyword_found AND best_score >= {pack.lexical_with_keyword}) AS covered FROM best)"""


@query("J1 A20 F12 M7", f"WITH {sql_coverage()} SELECT entity_id, \"right\", {sql_round('best_score', 4)} AS best_score, keyword_found, covered FROM coverage")
def rights_coverage(spark, folder):
    docs = table(spark, folder, "documents", ["source", "text"], heavy=True)
    return P.coverage_from_text(docs, "source", "text", DATA_PACK).withColumn("best_score", N.round_exact(F.col("best_score"), 4))


def _sql_descriptions() -> str:
    return "CASE \"right\" " + " ".join(f"WHEN {quoted(r)} THEN {quoted(d)}" for r, d, _ in DATA_PACK.policy_rights) + " END"


@query("J3 F13", f"""WITH {sql_coverage()}
SELECT entity_id, 'MISSING_RIGHT' AS type, "right", CASE WHEN "right" IN ('use', 'reserve') THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       {sql_round('1 - best_score', 4)} AS confidence, {sql_round('best_score', 4)} AS similarity_score, {_sql_descriptions()} AS description
FROM coverage WHERE NOT covered""")
def missing_rights(spark, folder):
    docs = table(spark, folder, "documents", ["source", "text"], heavy=True)
    return P.missing_rights(P.coverage_from_text(docs, "source", "text", DATA_PACK), pack=DATA_PACK)


SQL_CENTROIDS = """
flat AS (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
means AS (SELECT label, i, avg(v::DOUBLE) AS m FROM flat GROUP BY ALL),
centroids AS (SELECT label AS ref, list(m ORDER BY i) AS vec FROM means GROUP BY label)"""


def label_centroids(vectors):
    """Mean vector per label; labels and dimensions bound its size."""
    flat = vectors.select("label", F.posexplode("embedding").alias("i", "v"))
    means = flat.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    packed = F.sort_array(F.collect_list(F.struct("i", "m")))
    return means.groupBy(F.col("label").alias("ref")).agg(F.transform(packed, lambda x: x["m"]).alias("vec"))


@query("J1 F11 A20 (vectors)", f"""WITH {SQL_CENTROIDS}
SELECT label AS entity_id, ref AS "right", {sql_round('greatest(max(list_cosine_similarity(embedding::DOUBLE[], vec)), 0.0)', 4)} AS best_score
FROM embeddings, centroids GROUP BY ALL""")
def vector_coverage(spark, folder):
    vectors = table(spark, folder, "embeddings", ["embedding", "label"], heavy=True)
    best = P.best_vector_match(vectors, "label", "embedding", label_centroids(vectors), "ref", "vec")
    return best.withColumn("best_score", N.round_exact(F.col("best_score"), 4))


@query("F11", f"""WITH {SQL_CENTROIDS}
SELECT vec_id, {sql_round('list_cosine_similarity(embedding::DOUBLE[], vec)', 4)} AS similarity FROM embeddings JOIN centroids ON label = ref""")
def similarity_to_label_mean(spark, folder):
    vectors = table(spark, folder, "embeddings", heavy=True)
    means = label_centroids(vectors)
    return vectors.join(means, F.col("label") == F.col("ref")).select(
        "vec_id", N.round_exact(N.cosine(F.col("embedding"), F.col("vec")), 4).alias("similarity"))


@query("F17", f"""
WITH d AS (SELECT source, lower(text) AS lc FROM documents),
f AS (SELECT source, {', '.join(f"bool_or(contains(lc, {quoted(t)})) AS a{i}" for i, t in enumerate((*DATA_PACK.appeal_terms, *DATA_PACK.appeal_detail_terms)))} FROM d GROUP BY source),
l AS (SELECT source, {sql_kept([f'CASE WHEN a{i} THEN {quoted(t)} END' for i, t in enumerate(DATA_PACK.appeal_terms)])} AS b,
      {sql_kept([f'CASE WHEN a{i + len(DATA_PACK.appeal_terms)} THEN {quoted(t)} END' for i, t in enumerate(DATA_PACK.appeal_detail_terms)])} AS dt FROM f)
SELECT source AS entity_id, len(b) + len(dt) > 0 AS has_appeal, CASE WHEN len(dt) > 0 THEN 'DETAILED' WHEN len(b) > 0 THEN 'BASIC' ELSE 'MISSING' END AS quality,
       array_to_string(list_concat(b, dt), ',') AS matched_terms, CASE WHEN len(dt) > 0 THEN 0.95 WHEN len(b) > 0 THEN 0.75 ELSE 0.9 END::DOUBLE AS confidence FROM l""")
def appeal_quality(spark, folder):
    docs = table(spark, folder, "documents", ["source", "text"], heavy=True)
    return P.appeal_quality(docs, "source", "text", DATA_PACK).withColumn("matched_terms", joined("matched_terms"))


PAGE_LANGUAGE = r'<html lang="(\w+)"'


@query("J2 S4", f"""
WITH keyed AS (SELECT lang || '|' || source AS k, text FROM documents),
scanned AS ({sql_scan('keyed', 'text', 'k', DATA_PACK)}), found AS ({sql_detections('scanned', 'k', DATA_PACK)}),
policies AS (SELECT regexp_extract(html, {quoted(PAGE_LANGUAGE)}, 1) AS entity_id, lower({sql_html_text('html')}) AS lc FROM pages),
disclosed AS (SELECT entity_id, {', '.join(f"bool_or({sql_any('lc', ts)}) AS d{i}" for i, (_, ts) in enumerate(DATA_PACK.disclosure_terms))} FROM policies GROUP BY entity_id)
SELECT split_part(k, '|', 1) AS entity_id, 'UNDISCLOSED_SENSITIVE_DATA' AS type, f.type AS data_category, split_part(k, '|', 2) AS source_file,
       'CRITICAL' AS severity, 0.9::DOUBLE AS confidence,
       'Detected ''' || f.type || ''' in business data but privacy policy does not disclose processing of this category.' AS description
FROM found f LEFT JOIN disclosed d ON split_part(k, '|', 1) = d.entity_id
WHERE CASE f.type {' '.join(f"WHEN {quoted(c)} THEN NOT coalesce(d{i}, false)" for i, (c, _) in enumerate(DATA_PACK.disclosure_terms))} ELSE false END""")
def undisclosed_data(spark, folder):
    docs = table(spark, folder, "documents", ["lang", "source", "text"], heavy=True)
    found = FO.detections(FO.scan(docs, F.col("text"), ["lang", "source"], DATA_PACK), ["lang", "source"], DATA_PACK)
    pages = table(spark, folder, "pages", ["page_id", "html"], heavy=True)
    policies = pages.select(F.regexp_extract("html", PAGE_LANGUAGE, 1).alias("entity_id"), X.html_to_text(F.col("html")).alias("text"))
    return V.undisclosed_data(found.withColumnRenamed("lang", "entity_id"), policies, "entity_id", "text", DATA_PACK)


@query("J12 A2 A11", """
WITH totals AS (SELECT event_type AS entity_id, sum(n)::BIGINT AS total FROM (SELECT event_type, user_id % 7 AS part, count(DISTINCT user_id) AS n FROM events GROUP BY ALL) GROUP BY 1),
rules AS (SELECT entity_id, total, CASE entity_id WHEN 'click' THEN 10 WHEN 'view' THEN 1000000000 WHEN 'error' THEN NULL WHEN 'signup' THEN 0 ELSE 25 END::BIGINT AS value FROM totals)
SELECT entity_id, 'THRESHOLD_TRIGGERED' AS type, 'INFO' AS severity, 0.95::DOUBLE AS confidence, total AS total_unique, value AS threshold,
       'Business processes data of ' || format('{:,}', total) || ' unique consumers, exceeding the CTDPA threshold of ' || format('{:,}', value) || '. Full CTDPA compliance is required.' AS description
FROM rules WHERE value <> 0 AND total >= value""")
def threshold_check(spark, folder):
    events = table(spark, folder, "events", ["event_type", "user_id"]).withColumn("source", F.pmod("user_id", F.lit(7)))
    report = FO.distinct_consumers(events, ["event_type", "source"], "user_id").withColumn("error", F.lit(None).cast("string"))
    totals = FO.total_consumers(report, ["event_type"]).withColumnRenamed("event_type", "entity_id")
    limit = F.when(F.col("entity_id") == "click", 10).when(F.col("entity_id") == "view", 1_000_000_000).when(
        F.col("entity_id") == "error", F.lit(None)).when(F.col("entity_id") == "signup", 0).otherwise(25)
    rules = totals.select("entity_id", limit.cast("bigint").alias("value"), F.lit(0.95).alias("confidence"))
    return V.threshold_violations(totals, rules)
