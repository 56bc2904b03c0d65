"""Finding personal and sensitive data in tables and texts.

Every row is scanned once. Per source the scan leaves a handful of counters
and bit masks, so the shuffle carries one small row per source and task
whatever the size of a source is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlark.functions import numbers as N
from auditlark.functions import text as X
from auditlark.functions.literals import constant
from auditlark.rulepack import DEFAULT_PACK, RulePack, lookup_frame

METHOD_RANK = {"regex": 0, "keyword": 1, "ml_model": 2}

DETECTION = T.StructType([
    T.StructField("ordinal", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("matched_terms", T.ArrayType(T.StringType())),
    T.StructField("confidence", T.DoubleType()),
])


def cell_text(name: str, data_type: T.DataType) -> Column:
    """A cell as text. Doubles from 1e7 on keep plain digits, as in a CSV file."""
    cell = F.col(f"`{name}`")
    if isinstance(data_type, T.StringType):
        return cell
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        plain = F.rtrim(F.call_function("format_number", cell.cast("double"), F.lit("0.0###############")))
        return F.when(F.abs(cell).between(1e7, 1e16), plain).otherwise(cell.cast("string"))
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(cell)
    return cell.cast("string")


def row_text(df: DataFrame, columns: list[str] | None = None, cell_separator: str = X.CELL_SEPARATOR) -> Column:
    """All cells of a row in one string; nulls are left out."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    cells = [cell_text(f.name, f.dataType) for f in fields]
    return F.coalesce(cells[0], F.lit("")) if len(cells) == 1 else F.concat_ws(cell_separator, *cells)


def scan(
    df: DataFrame,
    text: Column,
    keys: list[str],
    pack: RulePack = DEFAULT_PACK,
    word_boundary: bool = False,
    headers: list[str] | None = None,
) -> DataFrame:
    """One row per key: row count, matches per pattern, terms seen.

    ``headers`` adds column names to what the keyword search sees.
    """
    terms = [t for _, t in pack.terms()]
    # Plain projections, which are compiled; each column is read several times by the next one, so Catalyst keeps them apart.
    probes = {p: f"__h{i}" for i, p in enumerate(dict.fromkeys(pack.probe(p) for _, p in pack.patterns if pack.probe(p)))}
    x, lowered = F.col("__x"), F.col("__lowered")
    rows = df.select(*keys, F.coalesce(text, F.lit("")).alias("__x"))
    rows = rows.select(*keys, "__x", F.lower("__x").alias("__lowered"), *(X.has_pattern(x, probe).alias(c) for probe, c in probes.items()))
    rows = rows.select(*keys, "__x", "__lowered", *probes.values(), X.may_hold_terms(lowered, terms).alias("__worth"))
    counts = [X.pattern_count(x, p, pack.needs(p), F.col(probes[pack.probe(p)]) if pack.probe(p) else None, pack.start(p)) for _, p in pack.patterns]
    masks = {f"__m{j}": F.when(F.col("__worth"), m) for j, m in enumerate(X.term_masks(lowered, terms, word_boundary))}
    rows = rows.select("*", *(m.alias(c) for c, m in masks.items()))
    header_text = F.lower(F.lit("\n".join(headers or [])))
    header_masks = X.term_masks(header_text, terms, word_boundary)
    seen = [
        F.coalesce(F.bit_or(F.when(F.col(m) != 0, F.col(m))), F.lit(0).cast("bigint")).bitwiseOR(header_masks[j]).alias(f"m{j}")
        for j, m in enumerate(masks)
    ]
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.coalesce(F.sum(count), F.lit(0).cast("bigint")).alias(f"p{i}")
            for i, count in enumerate(counts)
        ],
        *seen,
    )


def _detection(ordinal, kind, method: str, count, terms, confidence) -> Column:
    return F.struct(
        ordinal.cast("int").alias("ordinal"),
        kind.alias("type"),
        F.lit(method).alias("method"),
        count.cast("bigint").alias("count"),
        terms.cast("array<string>").alias("matched_terms"),
        confidence.cast("double").alias("confidence"),
    )


def regex_detections(pack: RulePack = DEFAULT_PACK) -> Column:
    """Array of pattern hits over the columns ``scan`` leaves."""
    counts = F.array(*[F.col(f"p{i}") for i in range(len(pack.patterns))])
    rows = constant([{"ordinal": i, "type": kind} for i, (kind, _) in enumerate(pack.patterns)])
    count = lambda r: F.get(counts, r["ordinal"].cast("int"))
    return F.transform(
        F.filter(rows, lambda r: count(r) > 0),
        lambda r: _detection(r["ordinal"], r["type"], "regex", count(r), F.lit(None), F.lit(0.95)))


def keyword_detections(pack: RulePack = DEFAULT_PACK) -> Column:
    """Array of keyword hits, one per category with any term seen."""
    first = len(pack.patterns)
    masks = [F.col(f"m{j}") for j in range(-(-len(pack.terms()) // X.TERMS_PER_MASK))]
    rows = [{"ordinal": first + n, **row} for n, row in enumerate(X.mask_terms(pack.keywords))]
    hits = F.transform(constant(rows), lambda r: F.struct(
        r["ordinal"].alias("ordinal"), r["name"].alias("name"), X.seen_terms(masks, r["terms"]).alias("seen")))
    confidence = lambda h: F.least(F.lit(0.5) + F.lit(0.15) * F.size(h["seen"]), F.lit(0.9))
    return F.transform(
        F.filter(hits, lambda h: F.size(h["seen"]) > 0),
        lambda h: _detection(h["ordinal"], h["name"], "keyword", F.lit(None), h["seen"], confidence(h)))


def detections(scanned: DataFrame, keys: list[str], pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """Detection rows (key columns and ``DETECTION`` fields) of a scan."""
    both = F.concat(regex_detections(pack), keyword_detections(pack))
    return scanned.select(*keys, F.inline(both))


def best_per_type(found: DataFrame, keys: list[str]) -> DataFrame:
    """Highest confidence per type; ties go to regex, then keyword, then model.

    The position of a type is that of its first detection by any method.
    """
    rank = F.element_at(F.create_map(*[x for m, r in METHOD_RANK.items() for x in (F.lit(m), F.lit(r))]), F.col("method"))
    group = Window.partitionBy(*keys, "type")
    placed = found.withColumns({
        "__place": F.row_number().over(group.orderBy(F.desc("confidence"), rank, "ordinal")), "__first": F.min("ordinal").over(group)})
    return placed.where("__place = 1").select(*keys, F.col("__first").alias("ordinal"), "type", "method", "count", "matched_terms", "confidence")


def best_in_row(details: Column) -> Column:
    """``best_per_type`` on the detection array of one source."""
    rank = lambda d: F.element_at(
        F.create_map(*[x for m, r in METHOD_RANK.items() for x in (F.lit(m), F.lit(r))]), d["method"])

    def beaten(d: Column) -> Column:
        better = lambda o: (o["type"] == d["type"]) & (
            (o["confidence"] > d["confidence"]) | ((o["confidence"] == d["confidence"]) & (rank(o) < rank(d))))
        return F.exists(details, better)

    def placed(d: Column) -> Column:
        same = F.filter(details, lambda o: o["type"] == d["type"])
        first = F.array_min(F.transform(same, lambda o: o["ordinal"]))
        return F.struct(first.alias("ordinal"), *[d[f.name].alias(f.name) for f in DETECTION.fields[1:]])

    return F.sort_array(F.transform(F.filter(details, lambda d: ~beaten(d)), placed))


def mean_confidence(details: Column) -> Column:
    """Mean over a source's details, added up in their order; 0 if none."""
    total = F.aggregate(details, F.lit(0.0), lambda acc, d: acc + d["confidence"])
    return F.when(F.size(details) > 0, N.round_exact(total / F.size(details), 3)).otherwise(F.lit(0.0))


def summarize(best: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: detected types, details and mean confidence.

    A key collects at most one row per type of the rule pack and the model.
    """
    row = F.struct(*[f.name for f in DETECTION.fields])
    details = F.col("detection_details")
    return (
        best.groupBy(*keys)
        .agg(F.sort_array(F.collect_list(row)).alias("detection_details"))
        .select(
            *keys,
            F.transform(details, lambda d: d["type"]).alias("pii_detected"),
            "detection_details",
            mean_confidence(details).alias("average_confidence"),
        )
    )


def consumer_column(columns: list[str], pack: RulePack = DEFAULT_PACK) -> str | None:
    return next((c for c in pack.consumer_id_columns if c in columns), None)


def distinct_consumers(
    df: DataFrame, keys: list[str], id_column: str | None = None, pack: RulePack = DEFAULT_PACK, approximate: bool = False
) -> DataFrame:
    """Distinct consumers per key; rows are counted when no id column exists.

    Reads the id column only. Kept apart from ``scan``, whose counters would
    otherwise be carried once per distinct id.
    """
    id_column = id_column or consumer_column(df.columns, pack)
    if id_column is None:
        count = F.count(F.lit(1))
    elif approximate:
        count = F.approx_count_distinct(id_column)
    else:
        count = F.count_distinct(F.col(id_column))
    return df.groupBy(*keys).agg(count.alias("unique_consumers"))


def total_consumers(report: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of the per-source counts over sources without error."""
    return report.where(F.col("error").isNull()).groupBy(*keys).agg(
        F.coalesce(F.sum("unique_consumers"), F.lit(0)).cast("bigint").alias("total_unique_consumers")
    )


def column_indicators(spark: SparkSession, source: str, columns: list[str], pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """Columns of a table whose names suggest a PII type, in column order."""
    catalog = lookup_frame(spark, {"source": (source,) * len(columns), "column": tuple(columns)})
    hint = X.column_hint(F.col("column"), pack)
    return catalog.select("source", "column", hint.alias("likely_pii_type")).where(F.col("likely_pii_type").isNotNull())


def indicator_array(columns: list[str], pack: RulePack = DEFAULT_PACK) -> Column:
    named = F.transform(constant(list(columns)), lambda c: F.struct(
        c.alias("column"), X.column_hint(c, pack).alias("likely_pii_type")))
    return F.filter(named, lambda s: s["likely_pii_type"].isNotNull())


REPORT_SCHEMA = (
    "source string, n_rows bigint, n_cols int, pii_detected array<string>, "
    "detection_details array<struct<ordinal:int,type:string,method:string,count:bigint,matched_terms:array<string>,confidence:double>>, "
    "column_pii array<struct<column:string,likely_pii_type:string>>, average_confidence double, "
    "unique_consumers bigint, error string"
)


def _conform(report: DataFrame) -> DataFrame:
    schema = T._parse_datatype_string(REPORT_SCHEMA)
    return report.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _best_hits(hits: DataFrame, keys: list[str]) -> DataFrame:
    """One detection per key and type, the most confident: as many as the model has classes."""
    best = hits.groupBy(*keys, "type").agg(F.max("confidence").alias("confidence"), F.min("ordinal").alias("ordinal"), F.min("method").alias("method"))
    return best.withColumns({"count": F.lit(None).cast("bigint"), "matched_terms": F.lit(None).cast("array<string>")})


def _hit_array(hits: DataFrame) -> Column:
    """Aggregate: the detection rows of a group that ``_best_hits`` made, one per class of the model."""
    return F.collect_list(F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DETECTION.fields]))


def report_from_scan(
    scanned: DataFrame, columns: list[str], pack: RulePack = DEFAULT_PACK, consumers: Column | None = None,
    model_hits: Column | None = None,
) -> DataFrame:
    """Report rows of a scan keyed by ``source``; the scan is read once.

    ``consumers`` is a column of the scan or a scalar subquery and defaults to
    the row count; ``model_hits`` likewise an array of ``DETECTION``.
    """
    found = F.concat(regex_detections(pack), keyword_detections(pack))
    kinds = [k for k, _ in pack.patterns] + [c for c, _ in pack.keywords]
    contested = len(set(kinds)) < len(kinds)
    if model_hits is not None:
        found = F.concat(found, F.coalesce(model_hits, F.array().cast(T.ArrayType(DETECTION))))
        contested = True
    unique = F.col("n_rows") if consumers is None else consumers
    rows = scanned.select("source", "n_rows", found.alias("found"), unique.alias("unique_consumers"))
    # Without shared types a scan row already holds the best hit of each type.
    details = best_in_row(F.col("found")) if contested else F.col("found")
    report = rows.withColumn("detection_details", details)
    return _conform(report.select(
        "*",
        F.lit(len(columns)).alias("n_cols"),
        F.transform("detection_details", lambda d: d["type"]).alias("pii_detected"),
        mean_confidence(F.col("detection_details")).alias("average_confidence"),
        indicator_array(columns, pack).alias("column_pii"),
        F.lit(None).cast("string").alias("error"),
    ))


def table_report(
    df: DataFrame,
    source: str,
    pack: RulePack = DEFAULT_PACK,
    model_hits: DataFrame | None = None,
    cell_separator: str = X.CELL_SEPARATOR,
    word_boundary: bool = False,
    include_headers: bool = False,
    approximate: bool = False,
) -> DataFrame:
    """PII report row of one whole table, all its columns scanned.

    Consumers and model hits (``DETECTION`` fields) are single values of the
    table and enter as scalar subqueries, so nothing is joined.
    """
    text = row_text(df, df.columns, cell_separator)
    scanned = scan(df.select(text.alias("row_text")), F.col("row_text"), [], pack, word_boundary,
                   df.columns if include_headers else None).withColumn("source", F.lit(source))
    id_column = consumer_column(df.columns, pack)
    consumers = None
    if id_column is not None:
        consumers = distinct_consumers(df.select(F.col(f"`{id_column}`").alias("consumer")), [], "consumer", pack, approximate).scalar()
    best = _best_hits(model_hits, []) if model_hits is not None else None
    hits = best.agg(_hit_array(best)).scalar() if model_hits is not None else None
    return report_from_scan(scanned, df.columns, pack, consumers, hits)


def table_reports(tables: dict[str, DataFrame], pack: RulePack = DEFAULT_PACK, cell_separator: str = X.CELL_SEPARATOR,
                  word_boundary: bool = False) -> DataFrame:
    """Report rows of many whole tables, one per name: their rows are laid under one another and scanned once.

    The scan's expression is built once, however many tables there are; partial sums leave one row per table and task.
    """
    spark = next(iter(tables.values())).sparkSession
    rows, ids, about = None, None, []
    for name, df in tables.items():
        part = df.select(F.lit(name).alias("source"), row_text(df, df.columns, cell_separator).alias("row_text"))
        rows = part if rows is None else rows.unionAll(part)
        about.append((name, df.columns))
        if id_column := consumer_column(df.columns, pack):
            some = df.select(F.lit(name).alias("source"), F.col(f"`{id_column}`").cast("string").alias("consumer"))
            ids = some if ids is None else ids.unionAll(some)
    known = spark.createDataFrame(about, "source string, columns array<string>")
    scanned = known.join(scan(rows, F.col("row_text"), ["source"], pack, word_boundary), "source", "left")
    counters = [c for c in scanned.columns if c not in ("source", "columns")]
    scanned = scanned.select("source", "columns", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counters])
    counted = ids.groupBy("source").agg(F.count_distinct("consumer").alias("unique_consumers")) if ids is not None else known.select("source", F.lit(None).cast("bigint").alias("unique_consumers"))
    named = [n for n, columns in about if consumer_column(columns, pack)]
    scanned = scanned.join(counted, "source", "left")
    unique = F.when(F.col("source").isin(*named), F.coalesce("unique_consumers", F.lit(0))).otherwise(F.col("n_rows"))
    report = report_from_scan(scanned, [], pack, unique)
    hints = F.filter(F.transform("columns", lambda c: F.struct(c.alias("column"), X.column_hint(c, pack).alias("likely_pii_type"))), lambda h: h["likely_pii_type"].isNotNull())
    columns = known.select("source", F.size("columns").alias("n_cols"), hints.alias("column_pii"))
    return _conform(report.drop("n_cols", "column_pii").join(columns, "source"))


def file_reports(rows: DataFrame, status: DataFrame, pack: RulePack = DEFAULT_PACK, cell_separator: str = X.CELL_SEPARATOR, word_boundary: bool = False) -> DataFrame:
    """Report rows of files of any layout: ``rows`` with ``source, cells``, ``status`` with ``source, n_rows, header, error`` of every file.

    A file with an error is a row with that error; the others are scanned once, together.
    """
    scanned = scan(rows.select("source", F.array_join("cells", cell_separator).alias("row_text")), F.col("row_text"), ["source"], pack, word_boundary)
    names = F.array(*(F.lit(c) for c in pack.consumer_id_columns))
    first = F.get(F.filter(names, lambda n: F.array_contains("header", n)), F.lit(0))
    about = status.where(F.col("error").isNull()).select("source", "header", (F.array_position("header", first) - 1).cast("int").alias("id_at"))
    ids = rows.join(about.where(F.col("id_at").isNotNull()).select("source", "id_at"), "source")
    counted = ids.groupBy("source").agg(F.count_distinct(F.get("cells", F.col("id_at"))).alias("distinct_ids"))
    scanned = about.join(scanned, "source", "left").join(counted, "source", "left")
    counters = [c for c in scanned.columns if c not in ("source", "header", "id_at", "distinct_ids")]
    scanned = scanned.select("source", "header", "id_at", "distinct_ids", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counters])
    unique = F.when(F.col("id_at").isNotNull(), F.coalesce("distinct_ids", F.lit(0))).otherwise(F.col("n_rows"))
    report = report_from_scan(scanned, [], pack, unique)
    hints = F.filter(F.transform("header", lambda c: F.struct(c.alias("column"), X.column_hint(c, pack).alias("likely_pii_type"))), lambda h: h["likely_pii_type"].isNotNull())
    columns = about.select("source", F.size("header").alias("n_cols"), hints.alias("column_pii"))
    good = _conform(report.drop("n_cols", "column_pii").join(columns, "source"))
    fields = T._parse_datatype_string(REPORT_SCHEMA).fields
    broken = status.where(F.col("error").isNotNull()).select(*(
        F.col(f.name) if f.name in ("source", "error") else F.lit(None).cast(f.dataType).alias(f.name) for f in fields))
    return good.unionByName(broken)


def text_report(
    df: DataFrame,
    text_column: str,
    source_column: str = "source",
    pack: RulePack = DEFAULT_PACK,
    id_column: str | None = None,
    word_boundary: bool = False,
    model_hits: DataFrame | None = None,
) -> DataFrame:
    """PII report rows of a text table, one per source value, in one scan."""
    keyed = df.withColumnRenamed(source_column, "source")
    id_column = id_column or consumer_column(df.columns, pack)
    scanned = scan(keyed, F.col(text_column), ["source"], pack, word_boundary)
    if id_column:
        scanned = scanned.join(distinct_consumers(keyed, ["source"], id_column, pack), "source", "left")
    if model_hits is not None:
        model_hits = _best_hits(model_hits, ["source"])
        scanned = scanned.join(model_hits.groupBy("source").agg(_hit_array(model_hits).alias("by_model")), "source", "left")
    return report_from_scan(
        scanned, df.columns, pack, F.col("unique_consumers") if id_column else None,
        F.col("by_model") if model_hits is not None else None)


def column_scan(df: DataFrame, source: str, pack: RulePack = DEFAULT_PACK, columns_per_pass: int = 24) -> DataFrame:
    """Matches per column and pattern: ``source, column, type, count``.

    One aggregate per block of columns; a block reads only its own columns, so
    the blocks together read the table once.
    """
    names = df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    blocks = [names[i:i + columns_per_pass] for i in range(0, len(names), columns_per_pass)]
    parts = []
    for block in blocks:
        counted = df.select(X.once(F.struct(*[
            X.let(F.coalesce(cell_text(c, types[c]), F.lit("")), lambda t: X.pattern_counts(t, pack)).alias(f"c{n}")
            for n, c in enumerate(block)
        ])))
        sums = [
            F.coalesce(F.sum(F.get(f"c{n}", F.lit(i))), F.lit(0).cast("bigint")).alias(f"c{n}_{i}")
            for n in range(len(block)) for i in range(len(pack.patterns))
        ]
        cells = [
            F.struct(F.lit(c).alias("column"), F.lit(kind).alias("type"), F.col(f"c{n}_{i}").alias("count"))
            for n, c in enumerate(block) for i, (kind, _) in enumerate(pack.patterns)
        ]
        parts.append(counted.agg(*sums).select(F.lit(source).alias("source"), F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts).where(F.col("count") > 0)


def row_flags(df: DataFrame, text: Column, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """The table plus ``pii_types``: the pattern types found in each row.

    No shuffle. Filters and generators on the result do not repeat the search,
    as nothing is pushed below the generator that computes it.
    """
    def flags(t: Column, possible) -> Column:
        hits = []
        for kind, pattern in pack.patterns:
            hit = X.has_pattern(t, pack.start(pattern) + pattern, pack.needs(pattern))
            likely = possible(pattern)
            hits.append(F.when(hit if likely is None else likely & hit, F.lit(kind)))
        return F.struct(F.array_compact(F.array(*hits)).alias("pii_types"))

    search = X.let(F.coalesce(text, F.lit("")), lambda t: X.with_probes(t, pack, lambda possible: flags(t, possible)))
    return df.select("*", X.once(search))


def fixed_sample(df: DataFrame, key: str, size: int, seed: int = 42, by: list[str] | None = None) -> DataFrame:
    """``size`` rows with the smallest key hash, overall or per group.

    Overall this is a top-k; per group the window's group limit keeps at most
    ``size`` rows per group and task before the shuffle.
    """
    order = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    if not by:
        return df.orderBy(order, key).limit(size)
    window = Window.partitionBy(*by).orderBy(order, F.col(key))
    return df.withColumn("__rn", F.row_number().over(window)).where(F.col("__rn") <= size).drop("__rn")


def without_values(report: DataFrame) -> DataFrame:
    """The published projection: types, counts and confidences, never values."""
    return report.select([f.name for f in T._parse_datatype_string(REPORT_SCHEMA).fields])
