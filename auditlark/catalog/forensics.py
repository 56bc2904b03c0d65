"""Personal and sensitive data in tables and texts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from auditlark.catalog.registry import (
    DATA_PACK, joined, query, quoted, sql_any, sql_count, sql_kept, sql_round, table,
)
from auditlark.operators import forensics as FO
from auditlark.rulepack import DEFAULT_PACK
from auditlark.session import scratch_folder
from auditlark.sources.files import read_csv_files
from auditlark.sources.tables import read_tables, table_catalog


def sql_scan(relation: str, text: str, key: str, pack) -> str:
    """One row per key with p<i> counts and t<i> term flags."""
    counts = [f"sum({sql_count('x', p)}) AS p{i}" for i, (_, p) in enumerate(pack.patterns)]
    flags = [f"bool_or(contains(lc, {quoted(t)})) AS t{i}" for i, (_, t) in enumerate(pack.terms())]
    return (
        f"SELECT {key}, count(*) AS n_rows, {', '.join(counts + flags)} "
        f"FROM (SELECT {key}, coalesce({text}, '') AS x, lower(coalesce({text}, '')) AS lc FROM {relation}) GROUP BY {key}"
    )


def sql_detections(scan: str, key: str, pack) -> str:
    """Detection rows of a scan CTE."""
    parts = [
        f"SELECT {key}, {i} AS ordinal, {quoted(kind)} AS type, 'regex' AS method, CAST(p{i} AS BIGINT) AS n, "
        f"CAST([] AS VARCHAR[]) AS terms, CAST(0.95 AS DOUBLE) AS confidence FROM {scan} WHERE p{i} > 0"
        for i, (kind, _) in enumerate(pack.patterns)
    ]
    index = 0
    for n, (category, terms) in enumerate(pack.keywords):
        found = sql_kept([f"CASE WHEN t{index + k} THEN {quoted(t)} END" for k, t in enumerate(terms)])
        index += len(terms)
        parts.append(
            f"SELECT {key}, {len(pack.patterns) + n}, {quoted(category)}, 'keyword', NULL, terms, "
            f"least(CAST(0.5 AS DOUBLE) + CAST(0.15 AS DOUBLE) * len(terms), CAST(0.9 AS DOUBLE)) "
            f"FROM (SELECT {key}, {found} AS terms FROM {scan}) WHERE len(terms) > 0"
        )
    return " UNION ALL ".join(parts)


def sql_report(relation: str, text: str, key: str, pack) -> str:
    return f"""
WITH scanned AS ({sql_scan(relation, text, key, pack)}),
     found AS ({sql_detections('scanned', key, pack)}),
     summed AS (SELECT {key}, string_agg(type, ',' ORDER BY ordinal) AS kinds, count(*) AS n,
                       list_sum(list(confidence ORDER BY ordinal)) / count(*) AS mean FROM found GROUP BY {key})
SELECT s.{key}, s.n_rows, coalesce(u.kinds, '') AS pii_detected, coalesce(u.n, 0) AS n_types,
       coalesce({sql_round('u.mean', 3)}, 0.0) AS average_confidence
FROM scanned s LEFT JOIN summed u ON s.{key} = u.{key}"""


@query("S2 A3 A4 A5 F1 F2 U1 W1 P10", sql_report("documents", "text", "source", DATA_PACK))
def document_pii_report(spark, folder):
    docs = table(spark, folder, "documents", ["source", "text"], heavy=True)
    return FO.text_report(docs, "text", pack=DATA_PACK).select(
        "source", "n_rows", joined("pii_detected").alias("pii_detected"),
        F.size("pii_detected").cast("bigint").alias("n_types"), "average_confidence",
    )


@query("A3 A4 F1 F2 (fixed rule pack)", sql_report("documents", "text", "source", DEFAULT_PACK))
def document_pii_report_fixed_pack(spark, folder):
    docs = table(spark, folder, "documents", ["source", "text"], heavy=True)
    return FO.text_report(docs, "text").select(
        "source", "n_rows", joined("pii_detected").alias("pii_detected"),
        F.size("pii_detected").cast("bigint").alias("n_types"), "average_confidence",
    )


@query("A3 A4 F1 F2 U1", f"""
WITH scanned AS ({sql_scan('documents', 'text', 'source', DATA_PACK)}),
     found AS ({sql_detections('scanned', 'source', DATA_PACK)})
SELECT source, type, method, n AS match_count, array_to_string(terms, ',') AS matched_terms, confidence FROM found""")
def document_detections(spark, folder):
    docs = table(spark, folder, "documents", ["source", "text"], heavy=True)
    scanned = FO.scan(docs, F.col("text"), ["source"], DATA_PACK)
    return FO.detections(scanned, ["source"], DATA_PACK).select(
        "source", "type", "method", F.col("count").alias("match_count"),
        F.coalesce(joined("matched_terms"), F.lit("")).alias("matched_terms"), "confidence",
    )


@query("A3 F1 (markup and chat texts)", f"""
WITH texts AS (SELECT 'pages' AS source, html AS text FROM pages UNION ALL SELECT 'conversations', text FROM conversations
               UNION ALL SELECT 'events', props FROM events UNION ALL SELECT 'benchmark', text FROM benchmark),
     scanned AS ({sql_scan('texts', 'text', 'source', DEFAULT_PACK)}),
     found AS ({sql_detections('scanned', 'source', DEFAULT_PACK)})
SELECT source, type, method, n AS match_count, confidence FROM found""")
def mixed_text_detections(spark, folder):
    parts = [("pages", "html"), ("conversations", "text"), ("events", "props"), ("benchmark", "text")]
    texts = None
    for name, column in parts:
        part = table(spark, folder, name, [column], heavy=True).select(F.lit(name).alias("source"), F.col(column).alias("text"))
        texts = part if texts is None else texts.unionByName(part)
    return FO.detections(FO.scan(texts, F.col("text"), ["source"]), ["source"]).select(
        "source", "type", "method", F.col("count").alias("match_count"), "confidence")


# Keyword categories named like pattern types, so that two methods find one type.
CONTEST_PACK = DEFAULT_PACK.replace(keywords=(
    ("email", ("@", "example", ".com", "mail")),
    ("ip_address", (".1", ".2", ".3", ".4")),
    ("token", ("token",)),
))


@query("W1 U1", f"""
WITH scanned AS ({sql_scan('documents', 'text', 'doc_id', CONTEST_PACK)}),
     found AS ({sql_detections('scanned', 'doc_id', CONTEST_PACK)}),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, type ORDER BY confidence DESC,
                CASE method WHEN 'regex' THEN 0 ELSE 1 END) AS rn FROM found)
SELECT doc_id, type, method, confidence FROM ranked WHERE rn = 1""")
def best_detection_per_type(spark, folder):
    docs = table(spark, folder, "documents", ["doc_id", "text"], heavy=True)
    found = FO.detections(FO.scan(docs, F.col("text"), ["doc_id"], CONTEST_PACK), ["doc_id"], CONTEST_PACK)
    return FO.best_per_type(found, ["doc_id"]).select("doc_id", "type", "method", "confidence")


REPORT_COLUMNS = {
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
    "conversations": ("conv_id", "turn", "role", "text"),
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"),
    "documents": ("doc_id", "text", "lang", "source", "n_chars"),
    "pages": ("page_id", "url", "html"),
    "benchmark": ("item_id", "text"),
    "labels": ("doc_id", "quality", "toxic"),
    "embeddings": ("vec_id", "embedding", "label"),
}


def _sql_hint(column: str) -> str:
    cases = " ".join(f"WHEN {sql_any(f'lower({column})', hints)} THEN {quoted(kind)}" for kind, hints in DEFAULT_PACK.column_hints)
    return f"CASE {cases} END"


def _sql_table_report() -> str:
    columns = REPORT_COLUMNS
    ids = {"events": "user_id"}
    ctes, selects = [], []
    for name, cols in columns.items():
        cells = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
        ctes.append(f"{name}_t AS (SELECT '{name}' AS source, concat_ws(chr(1), {cells}) AS text FROM {name})")
        ctes.append(f"{name}_s AS ({sql_scan(name + '_t', 'text', 'source', DEFAULT_PACK)})")
        ctes.append(f"{name}_f AS ({sql_detections(name + '_s', 'source', DEFAULT_PACK)})")
        consumers = f"count(DISTINCT {ids[name]})" if name in ids else "count(*)"
        selects.append(f"""
SELECT '{name}.parquet' AS source, (SELECT count(*) FROM {name}) AS n_rows, CAST({len(cols)} AS BIGINT) AS n_cols,
       coalesce((SELECT string_agg(type, ',' ORDER BY ordinal) FROM {name}_f), '') AS pii_detected,
       coalesce((SELECT string_agg(column_name || ':' || hint, ',' ORDER BY i)
                 FROM (SELECT column_name, {_sql_hint('column_name')} AS hint, row_number() OVER () AS i FROM (DESCRIBE {name}))
                 WHERE hint IS NOT NULL), '') AS column_pii,
       coalesce({sql_round(f"(SELECT list_sum(list(confidence ORDER BY ordinal)) / count(*) FROM {name}_f)", 3)}, 0.0) AS average_confidence,
       (SELECT {consumers} FROM {name}) AS unique_consumers, CAST(NULL AS VARCHAR) AS error""")
    selects.append("""
SELECT 'missing.parquet', NULL, NULL, NULL, NULL, NULL, NULL, 'File not found'""")
    return "WITH " + ", ".join(ctes) + " UNION ALL ".join(selects)


@query("S1 A1 A3 A4 A5 A19 F3 W2 P10", _sql_table_report())
def table_pii_reports(spark, folder):
    tables, failed = read_tables(spark, [f"{folder}/{name}.parquet" for name in (*REPORT_COLUMNS, "missing")])
    report = failed.unionByName(FO.table_reports(tables))
    return report.select(
        "source", "n_rows", F.col("n_cols").cast("bigint").alias("n_cols"), joined("pii_detected").alias("pii_detected"),
        F.array_join(F.transform("column_pii", lambda c: F.concat(c["column"], F.lit(":"), c["likely_pii_type"])), ",").alias("column_pii"),
        "average_confidence", "unique_consumers", "error",
    )


FILE_TABLES = ("customer", "supplier", "nation", "events")


def _sql_file_reports() -> str:
    ctes, selects = [], []
    for name in FILE_TABLES:
        cols = REPORT_COLUMNS[name]
        cells = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
        ctes.append(f"{name}_t AS (SELECT '{name}' AS source, concat_ws(chr(1), {cells}) AS text FROM {name})")
        ctes.append(f"{name}_s AS ({sql_scan(name + '_t', 'text', 'source', DEFAULT_PACK)})")
        ctes.append(f"{name}_f AS ({sql_detections(name + '_s', 'source', DEFAULT_PACK)})")
        consumers = "count(DISTINCT user_id)" if name == "events" else "count(*)"
        hints = f"""(SELECT string_agg(c || ':' || hint, ',' ORDER BY i) FROM (SELECT c, i, {_sql_hint('c')} AS hint
            FROM (VALUES {', '.join(f"({quoted(c)}, {i})" for i, c in enumerate(cols))}) AS x(c, i)) WHERE hint IS NOT NULL)"""
        selects.append(f"""
SELECT '{name}' AS source, (SELECT count(*) FROM {name}) AS n_rows, {len(cols)}::BIGINT AS n_cols,
    coalesce((SELECT string_agg(type, ',' ORDER BY ordinal) FROM {name}_f), '') AS pii_detected, coalesce({hints}, '') AS column_pii,
    (SELECT {consumers} FROM {name}) AS unique_consumers, CAST(NULL AS VARCHAR) AS error""")
    selects.append(" SELECT 'part', NULL, NULL, NULL, NULL, NULL, 'Could not read CSV: ' || (SELECT count(*) FROM part WHERE p_partkey % 3 = 0) || ' malformed rows'")
    selects.append(" SELECT 'region', NULL, NULL, NULL, NULL, NULL, 'File not found'")
    return "WITH " + ", ".join(ctes) + " UNION ALL ".join(selects)


@query("S1 A1 A3 F3 (CSV files)", _sql_file_reports())
def csv_file_reports(spark, folder):
    """Tables written as CSV files of different layouts and read back in one scan; a file with broken lines and a missing one are error rows."""
    out = f"{scratch_folder(spark)}/csv-tables-{uuid.uuid4().hex}"
    for name in FILE_TABLES:
        df = table(spark, folder, name, list(REPORT_COLUMNS[name]))
        df.select(*(F.col(c).cast("string") for c in df.columns)).write.option("header", True).option("escape", '"').csv(f"{out}/{name}")
    extra = F.when(F.col("p_partkey") % 3 == 0, ",surplus").otherwise("")  # a cell too many
    lines = table(spark, folder, "part", ["p_partkey", "p_size"]).select(F.concat(F.concat_ws(",", "p_partkey", "p_size"), extra).alias("p_partkey,p_size"))
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "").csv(f"{out}/part")  # lines as they are, each file with the header
    files = read_csv_files(spark, out, expected=["region"])
    name = F.split("source", "/")[0].alias("source")
    status = files.status.groupBy(name).agg(  # all part files of a table have one header
        F.sum("n_rows").alias("n_rows"), F.sum("n_bad_rows").alias("n_bad_rows"), F.min("header").alias("header"), F.min("error").alias("error"))
    malformed = F.format_string("Could not read CSV: %d malformed rows", "n_bad_rows")
    status = status.withColumn("error", F.when(F.col("n_bad_rows") > 0, malformed).otherwise(F.col("error")))
    report = FO.file_reports(files.rows.withColumn("source", name), status)
    return report.select(
        "source", "n_rows", F.col("n_cols").cast("bigint").alias("n_cols"), joined("pii_detected").alias("pii_detected"),
        F.array_join(F.transform("column_pii", lambda c: F.concat(c["column"], F.lit(":"), c["likely_pii_type"])), ",").alias("column_pii"), "unique_consumers", "error")


@query("S1 A19", "SELECT 'region.parquet' AS source, count(*) AS n_rows, 2::BIGINT AS n_cols FROM region"
       " UNION ALL SELECT 'lineitem.parquet', count(*), 11 FROM lineitem"
       " UNION ALL SELECT 'orders.parquet', count(*), 6 FROM orders"
       " UNION ALL SELECT 'embeddings.parquet', count(*), 3 FROM embeddings")
def table_sizes(spark, folder):
    tables, _ = read_tables(spark, [f"{folder}/{n}.parquet" for n in ("region", "lineitem", "orders", "embeddings")])
    return table_catalog(tables)


@query("A3 (per column) A19", "WITH c AS (SELECT "
       + ", ".join(f"sum({sql_count('text', p)}) AS t{i}, sum({sql_count('source', p)}) AS s{i}" for i, (_, p) in enumerate(DEFAULT_PACK.patterns))
       + " FROM documents) "
       + " UNION ALL ".join(
           f"SELECT 'documents' AS source, '{c}' AS \"column\", {quoted(k)} AS type, CAST({c[0]}{i} AS BIGINT) AS match_count FROM c WHERE {c[0]}{i} > 0"
           for c in ("text", "source") for i, (k, _) in enumerate(DEFAULT_PACK.patterns)))
def column_pattern_counts(spark, folder):
    docs = table(spark, folder, "documents", heavy=True)
    return FO.column_scan(docs, "documents").withColumnRenamed("count", "match_count")


@query("F1 P10 (per row)", "SELECT doc_id, array_to_string(kinds, ',') AS pii_types FROM (SELECT doc_id, "
       + sql_kept([f"CASE WHEN regexp_matches(text, {quoted(p)}) THEN {quoted(k)} END" for k, p in DEFAULT_PACK.patterns])
       + " AS kinds FROM documents) WHERE len(kinds) > 0")
def row_pii_flags(spark, folder):
    docs = table(spark, folder, "documents", ["doc_id", "text"], heavy=True)
    flagged = FO.row_flags(docs, F.col("text")).where(F.size("pii_types") > 0)
    return flagged.select("doc_id", joined("pii_types").alias("pii_types"))


@query("A1", "SELECT event_type, count(DISTINCT user_id) AS unique_consumers FROM events GROUP BY event_type")
def distinct_consumers(spark, folder):
    return FO.distinct_consumers(table(spark, folder, "events", ["event_type", "user_id"]), ["event_type"])


@query("A2 P4", """
SELECT (SELECT count(DISTINCT o_custkey) FROM orders) + (SELECT count(DISTINCT user_id) FROM events)
     + (SELECT count(*) FROM supplier) AS total_unique_consumers""")
def total_consumers(spark, folder):
    tables, report = read_tables(spark, [f"{folder}/{n}.parquet" for n in ("orders", "events", "supplier", "missing")])
    rows = report.select("source", "unique_consumers", "error")
    for name, df in tables.items():
        named = df.select(F.lit(name).alias("source"), *df.columns)
        counted = FO.distinct_consumers(named, ["source"], "o_custkey" if name.startswith("orders") else None)
        rows = rows.unionByName(counted.withColumn("error", F.lit(None).cast("string")))
    return FO.total_consumers(rows, [])


@query("A2 (dedup)", "SELECT count(DISTINCT id) AS total_unique_consumers FROM"
       " (SELECT o_custkey AS id FROM orders UNION ALL SELECT user_id FROM events UNION ALL SELECT c_custkey FROM customer)")
def total_consumers_deduplicated(spark, folder):
    ids = [("orders", "o_custkey"), ("events", "user_id"), ("customer", "c_custkey")]
    union = None
    for name, column in ids:
        part = table(spark, folder, name, [column]).select(F.col(column).alias("id"))
        union = part if union is None else union.unionByName(part)
    return union.agg(F.count_distinct("id").alias("total_unique_consumers"))


@query("A6", "SELECT string_agg(type, ',' ORDER BY type) AS pii_types_detected FROM ("
       + " UNION ALL ".join(f"SELECT {quoted(k)} AS type WHERE EXISTS (SELECT 1 FROM documents WHERE regexp_matches(text, {quoted(p)}))"
                            for k, p in DEFAULT_PACK.patterns)
       + "".join(f" UNION SELECT {quoted(c)} AS type WHERE EXISTS (SELECT 1 FROM documents WHERE {sql_any('lower(text)', terms)})" for c, terms in DEFAULT_PACK.keywords) + ")")
def pii_types_over_sources(spark, folder):
    docs = table(spark, folder, "documents", ["source", "text"], heavy=True)
    report = FO.text_report(docs, "text")
    kinds = report.where(F.col("error").isNull()).select(F.explode("pii_detected").alias("type"))
    return kinds.agg(joined(F.array_sort(F.collect_set("type"))).alias("pii_types_detected"))


@query("W7", "SELECT doc_id, source FROM documents ORDER BY md5(concat_ws('|', CAST(doc_id AS VARCHAR), '42')), doc_id LIMIT 5")
def fixed_size_sample(spark, folder):
    return FO.fixed_sample(table(spark, folder, "documents", ["doc_id", "source"]), "doc_id", 5)


@query("W7 (per source)", """
SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source
       ORDER BY md5(concat_ws('|', CAST(doc_id AS VARCHAR), '42')), doc_id) AS rn FROM documents) WHERE rn <= 5""")
def fixed_size_sample_per_source(spark, folder):
    return FO.fixed_sample(table(spark, folder, "documents", ["doc_id", "source"]), "doc_id", 5, by=["source"])


def _sql_sampled_detections() -> str:
    return f"""
WITH sampled AS (SELECT source, string_agg(text, ' ' ORDER BY doc_id) AS text FROM (
       SELECT doc_id, source, text, row_number() OVER (PARTITION BY source
       ORDER BY md5(concat_ws('|', CAST(doc_id AS VARCHAR), '42')), doc_id) AS rn FROM documents) WHERE rn <= 5 GROUP BY source),
     scanned AS ({sql_scan('sampled', 'text', 'source', DATA_PACK)}),
     found AS ({sql_detections('scanned', 'source', DATA_PACK)})
SELECT source, type, method, confidence FROM found"""


@query("W7 A3 A4 (sampling option)", _sql_sampled_detections())
def sampled_detections(spark, folder):
    docs = table(spark, folder, "documents", ["doc_id", "source", "text"], heavy=True)
    picked = FO.fixed_sample(docs.select("doc_id", "source"), "doc_id", 5, by=["source"]).select("doc_id")
    sample = docs.join(picked, "doc_id", "left_semi")
    return FO.detections(FO.scan(sample, F.col("text"), ["source"], DATA_PACK), ["source"], DATA_PACK).select(
        "source", "type", "method", "confidence")
