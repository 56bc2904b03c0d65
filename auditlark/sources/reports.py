"""Saved reports, and writing reports, exports and generated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlark.operators.report import COST, empty_cost


def write_reports(reports: DataFrame, path: str, generated_at: str = "generated_at") -> None:
    """Nested report rows as JSON, partitioned by run date; runs are added, never replaced."""
    reports.withColumn("run_date", F.to_date(generated_at)).write.mode("append").partitionBy("run_date").json(path)


def read_reports(spark: SparkSession, path: str, schema) -> DataFrame:
    """Saved reports with an explicit schema; a missing cost block, or a missing part of one, gets zeros, ``unknown`` and no agents."""
    return with_cost_defaults(spark.read.schema(schema).json(path))


def with_cost_defaults(reports: DataFrame) -> DataFrame:
    if "_cost_summary" not in reports.columns:
        return reports
    fields = reports.schema["_cost_summary"].dataType.fields
    known = {f.name for f in empty_cost_schema()}
    filled = F.struct(*[
        (F.coalesce(F.col(f"_cost_summary.{f.name}"), empty_cost()[f.name].cast(f.dataType)) if f.name in known else F.col(f"_cost_summary.{f.name}")).alias(f.name)
        for f in fields
    ])
    return reports.withColumn("_cost_summary", filled)


def empty_cost_schema() -> list[T.StructField]:
    return T._parse_datatype_string(COST).fields


def write_documents(lines: DataFrame, path: str, run: str) -> str:
    """Whole reports as files below ``path/report_<run>/entity_id=<entity>``; returns the run's folder.

    ``lines`` are ``entity_id, section, position, line``. An entity's lines are sorted by the shuffle and streamed into its file: no
    task holds a document, and a long one costs the time of writing it. Runs are added, never replaced.
    """
    out = f"{path}/report_{run}"
    ordered = lines.repartition("entity_id").sortWithinPartitions("entity_id", "section", "position")
    ordered.select("entity_id", F.col("line").alias("value")).write.mode("error").partitionBy("entity_id").text(out)
    return out


#: What saved reports of any age hold: later layouts add blocks, older ones lack them.
SAVED = (
    "metadata struct<report_title:string,generated_at:string,framework:string,scope:string>, "
    "executive_summary struct<overall_status:string,overall_compliance_status:string,risk_score:bigint,risk_grade:string,risk_label:string,"
    "risk_assessment:struct<grade:string,label:string>,total_violations:bigint,critical_violations:bigint,high_violations:bigint,summary:string>, "
    "regulatory_analysis struct<applicable_rules:struct<jurisdiction:string,threshold:struct<value:bigint,confidence:double>,rights:array<string>>>, "
    "pii_findings struct<files_analyzed:bigint,total_unique_consumers:bigint,pii_types_detected:array<string>,"
    "details:array<struct<source:string,n_rows:bigint,pii_detected:array<string>,error:string>>>, "
    "compliance_findings struct<status:string,risk_level:string,summary:struct<total_violations:bigint,critical:bigint,high:bigint,medium:bigint,info:bigint>,"
    "violations:array<struct<type:string,right:string,severity:string>>>, "
    "appeals_findings struct<appeal_procedure:struct<has_appeal:boolean,quality:string>,timeline_analysis:struct<total_requests:bigint,late_responses:bigint>,"
    "risk:string,violations:array<struct<type:string,severity:string>>>, "
    "violations array<struct<type:string,right:string,data_category:string,severity:string,confidence:double>>, "
    "recommendations array<struct<for_violation:string,right:string,priority:string,recommendation:string>>, "
    f"_cost_summary {COST}"
)


def read_documents_store(spark: SparkSession, path: str) -> DataFrame:
    """Saved reports of any layout: ``file, run, entity_id``, the blocks of ``SAVED`` (null where a report lacks one), and ``error`` for a file that is no JSON object.

    A document is read whole, as its reader would. Missing cost blocks get their defaults.
    """
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    name = F.col("_metadata.file_path")
    parsed = files.select(
        F.element_at(F.split(name, "/report_"), -1).alias("file"), F.regexp_extract(name, r"/report_([^/]+)/", 1).alias("run"),
        F.nullif(F.regexp_extract(name, r"/entity_id=([^/]+)/", 1), F.lit("")).alias("entity_id"),
        F.inline(F.array(F.struct(F.from_json("value", SAVED).alias("r"), (F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT")).alias("whole")))))
    saved = parsed.select("file", "run", F.url_decode("entity_id").alias("entity_id"), "r.*", F.when(~F.coalesce("whole", F.lit(False)), "Could not read report").alias("error"))
    cost = saved.withColumn("_cost_summary", F.coalesce("_cost_summary", empty_cost()))
    return with_cost_defaults(cost)


def newest_first(saved: DataFrame) -> DataFrame:
    """Stored reports by file name, the newest run first."""
    return saved.orderBy(F.desc("run"), F.desc("file"))


def newest_of_each(saved: DataFrame) -> DataFrame:
    """The report of the newest run per entity; each task keeps one per entity before the shuffle."""
    place = F.row_number().over(Window.partitionBy("entity_id").orderBy(F.desc("run"), F.desc("file")))
    return saved.where(F.col("error").isNull()).withColumn("__place", place).where("__place = 1").drop("__place")


def saved_report_names(spark: SparkSession, path: str) -> DataFrame:
    """Report files newest first, by name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file")).orderBy(F.desc("file"))


def summary_line() -> Column:
    """A report row as one Markdown block."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("## "), F.col("entity_id")),
        F.concat(F.lit("- Status: "), F.col("overall_status")),
        F.concat(F.lit("- Risk grade: "), F.col("risk_grade"), F.lit(" ("), F.col("risk_label"), F.lit(")")),
        F.concat(F.lit("- Risk score: "), F.col("risk_score").cast("string")),
        F.concat(F.lit("- Violations: "), F.col("total_violations").cast("string")),
    )


def export_summary(scores: DataFrame, path: str) -> None:
    scores.select(summary_line().alias("value")).write.mode("overwrite").text(path)


def export_violations(violations: DataFrame, path: str) -> None:
    violations.write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """A generated table as parquet or as CSV with header."""
    writer = df.write.mode("overwrite")
    (writer.option("header", True).csv(path) if file_format == "csv" else writer.format(file_format).save(path))
