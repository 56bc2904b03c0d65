"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the tables   (default /root/testdata/sf0.1)
BENCH_CPUS     cores of local mode    (default 8)
BENCH_QUERIES  comma-separated names  (default: the headline list)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from auditlark.catalog import load_all
from auditlark.session import get_session

HEADLINE = (
    "document_pii_report", "document_detections", "table_pii_reports", "column_pattern_counts", "row_pii_flags",
    "distinct_consumers", "total_consumers", "fixed_size_sample_per_source", "html_text", "assembled_policies",
    "latest_reports", "valid_response_days", "sla_summary", "sla_buckets", "statute_rules", "policy_paragraphs",
    "rights_coverage", "vector_coverage", "appeal_quality", "undisclosed_data", "severity_summary", "risk_scores",
    "recommendations", "violation_accuracy", "precision_recall", "classification_report", "usage_rollup",
    "narrative_violations", "json_payloads", "stratified_train_test_split", "model_detections", "generated_customers",
    "full_audit",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.auditlark.partitions": cpus, "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    catalog = load_all()
    spark.read.parquet(f"{folder}/documents.parquet").groupBy("source").count().write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        catalog[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "audit_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
