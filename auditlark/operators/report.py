"""Scores, grades, recommendations, citations, overrides and the report itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlark.functions import numbers as N
from auditlark.functions import text as X
from auditlark.operators.violations import severity_count
from auditlark.rulepack import (
    DEFAULT_PACK, GRADE_BELOW_LADDER, GRADE_LADDER, GRADE_NO_FINDINGS, MAX_RISK_SCORE, RulePack, citation_frame,
    recommendation_frame, severity_weight_frame,
    NARRATIVE_GRADE, NARRATIVE_SUMMARY, NARRATIVE_VIOLATION,
)


# --- scores and grades ---------------------------------------------------

def with_weights(violations: DataFrame, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """Violations plus ``weight``; unknown severities weigh the default."""
    weights = severity_weight_frame(violations.sparkSession, pack)
    return violations.join(weights, "severity", "left").withColumn(
        "weight", F.coalesce("weight", F.lit(pack.default_severity_weight)).cast("bigint")
    )


def _ladder(score: Column, part: int) -> Column:
    column = F.lit(GRADE_BELOW_LADDER[part])
    for step in reversed(GRADE_LADDER):
        column = F.when(score >= step[0], step[part + 1]).otherwise(column)
    return column


def risk_grade(score: Column, n_violations: Column) -> Column:
    return F.when(n_violations == 0, GRADE_NO_FINDINGS[0]).otherwise(_ladder(score, 0))


def risk_label(score: Column, n_violations: Column) -> Column:
    return F.when(n_violations == 0, GRADE_NO_FINDINGS[1]).otherwise(_ladder(score, 1))


def risk_scores(violations: DataFrame, entities: DataFrame | None = None, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """Score 0 to 100, grade, label and PASS/FAIL per entity."""
    scored = with_weights(violations, pack).groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("total_violations"),
        severity_count("CRITICAL").alias("critical_violations"),
        severity_count("HIGH").alias("high_violations"),
        F.sum("weight").alias("weight"),
    )
    if entities is not None:
        scored = entities.select("entity_id").distinct().join(scored, "entity_id", "left").na.fill(0)
    score = F.least(F.col("weight"), F.lit(MAX_RISK_SCORE).cast("bigint"))
    return scored.withColumn("risk_score", score).select(
        "entity_id", "total_violations", "critical_violations", "high_violations", "risk_score",
        risk_grade(F.col("risk_score"), F.col("total_violations")).alias("risk_grade"),
        risk_label(F.col("risk_score"), F.col("total_violations")).alias("risk_label"),
        F.when(F.col("total_violations") > 0, "FAIL").otherwise("PASS").alias("overall_status"),
    )


# --- lookups on violations -----------------------------------------------

def recommendations(violations: DataFrame, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """One recommendation per violation whose type has one.

    A missing right has a text of its own or a generic one; the data category
    is filled into the text; types without a text are dropped. The violations' ``position`` is kept if they have one.
    """
    texts = recommendation_frame(violations.sparkSession, pack)
    right = F.when(F.col("type") == "MISSING_RIGHT", F.coalesce("right", F.lit(""))).otherwise("")
    joined = violations.withColumn("__right", right).join(
        texts.withColumnRenamed("right", "__right"), ["type", "__right"], "left"
    )
    is_right, is_data = F.col("type") == "MISSING_RIGHT", F.col("type") == "UNDISCLOSED_SENSITIVE_DATA"
    category = F.coalesce("data_category", F.lit("unknown"))
    generic = F.format_string("Add the '%s' right to your privacy policy.", F.col("__right"))
    return joined.select(
        "entity_id",
        F.col("type").alias("for_violation"),
        F.when(is_right, F.col("__right")).alias("right"),
        F.when(is_data, category).alias("data_category"),
        F.when(is_right, F.when(F.col("__right").isin(*pack.high_severity_rights), "HIGH").otherwise("MEDIUM"))
        .when(is_data, "CRITICAL").otherwise(F.coalesce("severity", F.lit("MEDIUM"))).alias("priority"),
        F.when(is_right, F.coalesce("text", generic))
        .when(is_data, F.replace(F.col("text"), F.lit("{data_category}"), category))
        .otherwise(F.col("text")).alias("recommendation"),
        *(["position"] if "position" in violations.columns else []),
    ).where(F.col("recommendation").isNotNull())


def with_citations(violations: DataFrame, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """Violations plus law ``section`` and ``quote``, by right or else by type."""
    laws = citation_frame(violations.sparkSession, pack)
    key = F.coalesce(F.nullif(F.col("right"), F.lit("")), F.col("type"))
    return violations.withColumn("citation_key", key).join(laws, "citation_key", "left").drop("citation_key")


def with_first_recommendation(violations: DataFrame, advice: DataFrame) -> DataFrame:
    """Violations plus the first recommendation of their type and, if they name one, right.

    Advice is reduced to one row per entity, type and right before the join, so
    repeated violations never multiply. ``position`` orders advice if present.
    """
    order = F.col("position") if "position" in advice.columns else F.col("recommendation")

    def first(name: str, *by: Column) -> DataFrame:
        """One piece of advice per group, chosen before the shuffle."""
        place = F.row_number().over(Window.partitionBy("entity_id", *by).orderBy(order, "priority", "recommendation"))
        chosen = advice.withColumn("__place", place).where("__place = 1")
        return chosen.select("entity_id", *by, F.struct("priority", "recommendation").alias(name))

    kind = F.col("for_violation").alias("type")
    advice = advice.select("*", kind, F.coalesce("right", F.lit("")).alias("__right")) if "type" not in advice.columns else advice.withColumns(
        {"type": F.col("for_violation"), "__right": F.coalesce("right", F.lit(""))})
    by_right, by_type = first("exact", F.col("type"), F.col("__right")), first("any", F.col("type"))
    right = F.coalesce("right", F.lit(""))
    joined = (
        violations.withColumn("__right", right)
        .join(by_right, ["entity_id", "type", "__right"], "left")
        .join(by_type, ["entity_id", "type"], "left")
    )
    chosen = F.when(F.col("__right") != "", F.col("exact")).otherwise(F.col("any"))
    return joined.select(
        *violations.columns,
        F.coalesce(chosen["priority"], F.col("severity")).alias("action_priority"),
        chosen["recommendation"].alias("action"),
    )


def violation_id(keys=("entity_id", "type", "right", "data_category", "source_file")) -> Column:
    """A stable hash of what a violation is about."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]))


def apply_overrides(violations: DataFrame, overrides: DataFrame, on: str = "violation_id") -> DataFrame:
    """Violations no reviewer has overridden."""
    return violations.join(overrides.select(on).distinct(), on, "left_anti")


def override_summary(violations: DataFrame, overrides: DataFrame, on: str = "violation_id") -> DataFrame:
    """Total, overridden and active violations per entity."""
    marked = violations.join(overrides.select(on).distinct().withColumn("__o", F.lit(True)), on, "left")
    return marked.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("__o")).alias("overridden"),
        F.count_if(F.col("__o").isNull()).alias("active"),
    )


def display_title() -> Column:
    """Type, then ' - right' and ' (category)' where present."""
    right, category = F.nullif(F.col("right"), F.lit("")), F.nullif(F.col("data_category"), F.lit(""))
    return F.concat(
        F.col("type"),
        F.coalesce(F.concat(F.lit(" - "), right), F.lit("")),
        F.coalesce(F.concat(F.lit(" ("), category, F.lit(")")), F.lit("")),
    )


# --- usage ---------------------------------------------------------------

def usage_rollup(usage: DataFrame, agent: str = "agent") -> DataFrame:
    """Tokens, cost and time per agent, and the total; ``is_total`` tells it from calls without an agent."""
    return usage.rollup(agent).agg(
        (F.grouping(agent) == 1).alias("is_total"),
        F.count(F.lit(1)).alias("n_calls"),
        F.sum("input_tokens").cast("bigint").alias("total_input_tokens"),
        F.sum("output_tokens").cast("bigint").alias("total_output_tokens"),
        (F.sum("input_tokens") + F.sum("output_tokens")).cast("bigint").alias("total_tokens"),
        F.sum("total_cost_usd").alias("total_cost_usd"),
        F.sum("duration_ms").cast("bigint").alias("total_duration_ms"),
    )


def cost_ranking(usage: DataFrame, agent: str = "agent") -> DataFrame:
    """Agents by cost, dearest first. Ranked after the aggregate: one row per agent."""
    cost = usage.groupBy(agent).agg(F.sum("total_cost_usd").alias("total_cost_usd"))
    return cost.withColumn(
        "cost_rank", F.rank().over(Window.orderBy(F.col("total_cost_usd").desc()))
    ).orderBy("cost_rank", agent)


COST = ("struct<total_cost_usd:double,total_input_tokens:bigint,total_output_tokens:bigint,total_tokens:bigint,total_duration_ms:bigint,model:string,"
        "per_agent:array<struct<agent:string,input_tokens:bigint,output_tokens:bigint,total_cost_usd:double,duration_ms:bigint>>>")


def empty_cost() -> Column:
    """The cost block of a report that has none: zeros, an unknown model and no agents."""
    zeros = [F.lit(0).alias(n) for n in ("total_cost_usd", "total_input_tokens", "total_output_tokens", "total_tokens", "total_duration_ms")]
    return F.struct(*zeros, F.lit("unknown").alias("model"), F.array().alias("per_agent")).cast(COST)


def cost_blocks(usage: DataFrame, model: str = "unknown") -> DataFrame:
    """``entity_id, _cost_summary``: totals of the usage records and one entry per agent, of which there are few."""
    sums = usage.groupBy("entity_id", "agent").agg(*(F.sum(c).alias(c) for c in ("input_tokens", "output_tokens", "total_cost_usd", "duration_ms")))
    entry = F.struct("agent", "input_tokens", "output_tokens", "total_cost_usd", "duration_ms")
    rows = sums.groupBy("entity_id").agg(
        F.sum("total_cost_usd").alias("total_cost_usd"), F.sum("input_tokens").alias("i"), F.sum("output_tokens").alias("o"), F.sum("duration_ms").alias("d"),
        F.sort_array(F.collect_list(entry)).alias("per_agent"))
    block = F.struct("total_cost_usd", F.col("i").alias("total_input_tokens"), F.col("o").alias("total_output_tokens"), (F.col("i") + F.col("o")).alias("total_tokens"),
                     F.col("d").alias("total_duration_ms"), F.lit(model).alias("model"), "per_agent")
    return rows.select("entity_id", block.cast(COST).alias("_cost_summary"))


# --- reports as rows, as JSON and back -----------------------------------

def latest_reports(reports: DataFrame, entity: str, generated_at: str) -> DataFrame:
    """The newest report of each entity; of equally new ones the largest. Each task keeps one row per entity before the shuffle."""
    rest = [c for c in reports.columns if c not in (entity, generated_at)]
    newest = Window.partitionBy(entity).orderBy(F.desc(generated_at), *[F.desc(c) for c in rest])
    ranked = reports.withColumn("__place", F.row_number().over(newest)).where("__place = 1")
    return ranked.select(entity, *[c for c in reports.columns if c != entity])


SUMMARY_FIELDS = (
    "executive_summary struct<overall_compliance_status:string,overall_status:string,risk_grade:string,risk_level:string,"
    "risk_assessment:struct<grade:string,label:string>,total_violations:string,critical_violations:string,critical:string,"
    "high_violations:string,high:string>, "
    "violations_summary struct<total_violations:string,critical_violations:string,critical:string,high_violations:string,high:string>, "
    "_cost_summary struct<total_cost_usd:string,model:string>"
)


def report_fields(reports: DataFrame, keys: list[str], document: str) -> DataFrame:
    """The shown fields of saved reports, whichever of their layouts they use.

    A document is parsed once; every field is the first of its names present.
    """
    parsed = reports.select(*keys, X.once(F.from_json(F.col(document), SUMMARY_FIELDS)))
    count = lambda *names: F.coalesce(*[F.col(n).try_cast("bigint") for n in names], F.lit(0).cast("bigint"))
    counted = lambda name: count(
        f"violations_summary.{name}_violations", f"violations_summary.{name}",
        f"executive_summary.{name}_violations", f"executive_summary.{name}")
    return parsed.select(
        *keys,
        F.coalesce("executive_summary.overall_compliance_status", "executive_summary.overall_status").alias("status"),
        F.coalesce("executive_summary.risk_grade", "executive_summary.risk_assessment.grade", F.lit("?")).alias("risk_grade"),
        F.coalesce("executive_summary.risk_level", "executive_summary.risk_assessment.label", F.lit("")).alias("risk_level"),
        count("violations_summary.total_violations", "executive_summary.total_violations").alias("total_violations"),
        counted("critical").alias("critical"),
        counted("high").alias("high"),
        F.coalesce(F.col("_cost_summary.total_cost_usd").try_cast("double"), F.lit(0.0)).alias("total_cost_usd"),
        F.coalesce("_cost_summary.model", F.lit("unknown")).alias("model"),
    )


def flatten_findings(reports: DataFrame, keys: list[str], document: str) -> DataFrame:
    """One row per finding of a saved report: its detections, its column
    indicators, and the entries of the older map layout."""
    layout = (
        "details:array<struct<file:string,error:string,"
        "detection_details:array<struct<type:string,method:string,count:bigint,confidence:double>>,"
        "column_pii_indicators:array<struct<column:string,likely_pii_type:string>>>>,"
        "pii_detected:map<string,struct<count:bigint,confidence:double>>"
    )
    parsed = reports.select(*keys, X.once(F.from_json(
        F.col(document), f"pii_detection_findings struct<{layout}>, pii_findings struct<{layout}>"))).select(
        *keys, F.coalesce("pii_detection_findings", "pii_findings").alias("findings")).select(
        *keys, F.col("findings.details").alias("details"), F.col("findings.pii_detected").alias("old"))

    def finding(kind, file, name, pii_type, method, count, confidence):
        return F.struct(
            F.lit(kind).alias("kind"), file.alias("file"), name.alias("column"), pii_type.alias("type"),
            method.alias("method"), count.cast("bigint").alias("count"), confidence.cast("double").alias("confidence"),
        )

    null = F.lit(None).cast("string")
    readable = F.filter(F.coalesce("details", F.array()), lambda d: d["error"].isNull())
    hits = F.flatten(F.transform(readable, lambda d: F.transform(
        F.coalesce(d["detection_details"], F.array()),
        lambda h: finding("detection", d["file"], null, h["type"], h["method"], h["count"], h["confidence"]))))
    columns = F.flatten(F.transform(readable, lambda d: F.transform(
        F.coalesce(d["column_pii_indicators"], F.array()),
        lambda c: finding("column", d["file"], c["column"], c["likely_pii_type"], null, F.lit(None), F.lit(None)))))
    old = F.transform(F.map_entries(F.coalesce("old", F.create_map().cast("map<string,struct<count:bigint,confidence:double>>"))),
                      lambda e: finding("map_entry", null, null, e["key"], null, e["value"]["count"], e["value"]["confidence"]))
    return parsed.select(*keys, X.once(F.struct(F.concat(hits, columns, old).alias("f")))).select(*keys, F.inline("f"))


def narrative_findings(raw: Column) -> dict[str, Column]:
    """Status, grade, summary and violations read from a report written as prose."""
    upper = F.upper(raw)
    blocks = F.regexp_extract_all(raw, F.lit(NARRATIVE_VIOLATION), F.lit(1))

    def violation(block: Column) -> Column:
        body = X.strip(block)
        title = X.strip(F.replace(F.get(F.split(body, "\n"), F.lit(0)), F.lit("*"), F.lit("")))
        severity = F.when(F.contains(F.upper(title), F.lit("CRITICAL")), "CRITICAL").when(
            F.contains(F.upper(title), F.lit("HIGH")), "HIGH").otherwise("MEDIUM")
        return F.struct(title.alias("type"), severity.alias("severity"),
                        F.replace(body, F.lit("*"), F.lit("")).alias("finding"))

    grade = F.upper(F.regexp_extract(raw, NARRATIVE_GRADE, 1))
    summary = F.regexp_extract(raw, NARRATIVE_SUMMARY, 1)
    return {
        "status": F.when(F.contains(upper, F.lit("NON-COMPLIANT")) | F.contains(upper, F.lit("NON_COMPLIANT")), "NON_COMPLIANT")
        .when(F.contains(upper, F.lit("COMPLIANT")), "COMPLIANT").otherwise("UNKNOWN"),
        "risk_grade": F.coalesce(F.nullif(grade, F.lit("")), F.lit("?")),
        "summary": F.replace(X.strip(summary), F.lit("*"), F.lit("")),
        "violations": F.transform(blocks, violation),
    }


def parse_narratives(reports: DataFrame, keys: list[str], raw: str) -> DataFrame:
    found = lambda text: F.struct(*[c.alias(n) for n, c in narrative_findings(text).items()])
    return reports.select(*keys, X.once(X.let(F.col(raw), found)))


REPORT_LAYOUT = ("struct<executive_summary:struct<overall_compliance_status:string,overall_status:string,risk_grade:string,risk_assessment:struct<grade:string>,summary:string>,"
                 "violations:array<struct<type:string,severity:string,finding:string,description:string>>,status:string,error:string,message:string,raw_response:string>")


def normalize_reports(reports: DataFrame, keys: list[str], document: str) -> DataFrame:
    """Reports of any shape in one: ``branch, status, risk_grade, summary, violations`` (type, severity, finding) and their number.

    The document becomes one variant, and what it holds decides the branch: ``structured`` (a summary and violations: taken as they are), ``failed`` (a status FAILED or an
    error), ``narrative`` (prose in ``raw_response``, or a text that is no JSON object at all: read by patterns, where the report has no such field of its own), else ``plain``.
    """
    text = F.col(document)
    variant = F.try_parse_json(text)
    is_object = F.coalesce(F.schema_of_variant(variant).startswith("OBJECT"), F.lit(False))
    parts = F.struct(is_object.alias("is_object"), F.when(is_object, variant).alias("v"))
    rows = reports.select(*keys, text.alias("__text"), X.once(parts))
    # Each field by itself: one of another type than expected is taken as absent and spoils no other.
    fields = {f.name: f.dataType for f in T._parse_datatype_string(REPORT_LAYOUT).fields}
    rows = rows.select(*keys, X.once(F.struct(
        *[F.try_variant_get("v", f"$.{n}", t.simpleString()).alias(n) for n, t in fields.items()],
        F.try_variant_get("v", "$.executive_summary", "variant").isNotNull().alias("has_summary"), F.try_variant_get("v", "$.violations", "variant").isNotNull().alias("has_violations"),
        F.coalesce(F.schema_of_variant(F.try_variant_get("v", "$.executive_summary", "variant")) != "OBJECT<>", F.lit(False)).alias("full_summary"),
        F.when(F.col("is_object"), F.try_variant_get("v", "$.raw_response", "string")).otherwise(F.col("__text")).alias("raw"))))
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    branch = (
        F.when(F.col("full_summary") & (F.size(F.coalesce("violations", F.array())) > 0), "structured")
        .when((F.coalesce("status", F.lit("")) == "FAILED") | filled(F.col("error")), "failed")
        .when(filled(F.col("raw")), "narrative").otherwise("plain"))
    told = X.let(F.coalesce("raw", F.lit("")), lambda t: F.struct(*[c.alias(n) for n, c in narrative_findings(t).items()]))
    rows = rows.withColumn("branch", branch).select("*", X.once(F.struct(F.when(F.col("branch") == "narrative", told).alias("told"))))

    own = F.col("executive_summary")
    trouble = F.concat(F.lit("Pipeline error: "), F.coalesce("error", F.lit("Unknown error")), F.lit(". "), F.coalesce("message", F.lit("")))
    fresh = ~F.col("has_summary")
    listed = F.transform(F.coalesce("violations", F.array()), lambda v: F.struct(v["type"].alias("type"), v["severity"].alias("severity"),
                                                                             F.coalesce(v["finding"], v["description"]).alias("finding")))
    found = F.when((F.col("branch") == "narrative") & ~F.col("has_violations"), F.col("told.violations")).otherwise(listed)
    shown = rows.select(
        *keys, "branch",
        F.when(fresh & (F.col("branch") == "failed"), "ERROR").when(fresh & (F.col("branch") == "narrative"), F.col("told.status"))
        .otherwise(F.coalesce(own["overall_compliance_status"], own["overall_status"])).alias("status"),
        F.when(fresh & (F.col("branch") == "failed"), "?").when(fresh & (F.col("branch") == "narrative"), F.col("told.risk_grade"))
        .otherwise(F.coalesce(own["risk_grade"], own["risk_assessment"]["grade"], F.lit("?"))).alias("risk_grade"),
        F.when(fresh & (F.col("branch") == "failed"), trouble).when((F.col("branch") == "narrative") & filled(F.col("told.summary")), F.col("told.summary"))
        .otherwise(F.coalesce(own["summary"], F.lit(""))).alias("summary"),
        found.alias("violations"))
    severity = lambda level: F.size(F.filter("violations", lambda v: v["severity"] == level)).cast("bigint")
    return shown.select("*", F.size("violations").cast("bigint").alias("total_violations"), *[severity(s.upper()).alias(f"{s}_violations") for s in ("critical", "high", "medium")])


NO_ANSWER = "No structured data found in report."
NO_CONTEXT = "No context available"


def evidence_lines(violations: DataFrame, scores: DataFrame, advice: DataFrame | None = None) -> DataFrame:
    """Audit answer as lines in the order of ``section, sort_key, line``: nothing is grouped, so entities of any size are alike.

    ``scores`` may have a ``summary``. The order of violations and advice is their ``position`` where they have one.
    """
    summary = F.coalesce(F.col("summary").cast("string"), F.lit("")) if "summary" in scores.columns else F.lit("")
    head = scores.select(
        "entity_id", F.lit(0).alias("section"), F.lit("").alias("sort_key"),
        F.concat_ws("\n",
                    F.concat(F.lit("Compliance Status: "), F.coalesce("overall_status", F.lit("Unknown"))),
                    F.concat(F.lit("Risk Grade: "), F.coalesce("risk_grade", F.lit("?"))),
                    F.concat(F.lit("Summary: "), summary)).alias("line"),
    )
    empty = F.lit("")

    def place(rows: DataFrame, *columns: str) -> Column:
        return F.lpad(F.col("position").cast("string"), 19, "0") if "position" in rows.columns else F.concat_ws("|", *(F.coalesce(c, empty) for c in columns))

    lines = violations.select(
        "entity_id", F.lit(1).alias("section"), place(violations, "type", "right", "data_category", "source_file").alias("sort_key"),
        F.concat(F.lit("Violation: "), F.coalesce("type", empty), F.lit(" - "), F.coalesce("right", empty),
                 F.lit(" ("), F.coalesce("severity", empty), F.lit(")")).alias("line"),
    )
    parts = [head, lines]
    if advice is not None:
        parts.append(advice.select(
            "entity_id", F.lit(2).alias("section"), place(advice, "for_violation", "right", "data_category").alias("sort_key"),
            F.concat(F.lit("Recommendation: "), F.coalesce("recommendation", empty)).alias("line")))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every


def evidence_text(violations: DataFrame, scores: DataFrame, advice: DataFrame | None = None, entities: DataFrame | None = None) -> DataFrame:
    """The lines of an entity as one text, for a judge that reads an answer whole: one row per entity, always.

    Entities without any line, where ``entities`` names them, have a text that says so.
    """
    lines = F.array_sort(F.collect_list(F.struct("section", "sort_key", "line")))
    answers = evidence_lines(violations, scores, advice).groupBy("entity_id").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("answer"))
    if entities is None:
        return answers
    return entities.select("entity_id").distinct().join(answers, "entity_id", "left").withColumn("answer", F.coalesce("answer", F.lit(NO_ANSWER)))


def contexts(blocks: DataFrame, details: DataFrame | None = None, limit: int = 2000) -> DataFrame:
    """What a judge may rely on, ``entity_id, position, context``: up to three labelled texts per entity, each block cut at ``limit`` characters.

    ``blocks`` has ``entity_id`` and any of ``regulatory_analysis``, ``pii_findings``, ``appeals_findings``. ``details`` (``entity_id, position, row``), the
    list in the PII findings, may be of any length: no more than ``limit`` of its rows can be in a text, as each has a character at least, so no more are gathered.
    An entity without any block has one text that says so.
    """
    labels = (("regulatory_analysis", "Regulatory Analysis"), ("pii_findings", "PII Findings"), ("appeals_findings", "Appeals Findings"))
    rows = blocks
    if details is not None:
        few = details.where(F.col("position") <= limit).groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct("position", "row"))).alias("__rows"))
        rows = rows.join(few, "entity_id", "left")

    def whole(name: str) -> Column:
        text = F.to_json(F.col(name))
        if name == "pii_findings" and details is not None:
            listed = F.array_join(F.transform(F.coalesce("__rows", F.array()), lambda r: r["row"]), ",")
            text = F.concat(F.left(text, F.length(text) - 1), F.lit(',"details":['), listed, F.lit("]}"))
        return text

    texts = [F.concat(F.lit(f"{label}: "), F.left(whole(name), F.lit(limit))) for name, label in labels if name in blocks.columns]
    found = X.let(F.array_compact(F.array(*texts)), lambda t: F.when(F.size(t) > 0, t).otherwise(F.array(F.lit(NO_CONTEXT))))
    return rows.select("entity_id", F.posexplode(found).alias("position", "context")).withColumn("position", F.col("position") + 1)


def context_text(label: str, value: Column, limit: int | None = None) -> Column:
    """A labelled context; a caller whose reader takes no more may cut its JSON at ``limit`` characters."""
    whole = F.to_json(value)
    return F.concat(F.lit(f"{label}: "), whole if limit is None else F.left(whole, F.lit(limit)))
