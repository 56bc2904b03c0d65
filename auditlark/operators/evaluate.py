"""Scoring an audit against expected results, grouped by any key columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlark.functions import jsontext as J
from auditlark.functions import numbers as N
from auditlark.rulepack import DEFAULT_PACK, STAGE_GATE, TOTAL_CLAUSES, RulePack


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def violation_keys(violations: DataFrame, keys: list[str]) -> DataFrame:
    """``type`` and ``subject`` (the right, else the data category) of each violation."""
    columns = violations.columns
    right = F.nullif(F.col("right"), F.lit("")) if "right" in columns else F.lit(None).cast("string")
    category = F.col("data_category") if "data_category" in columns else F.lit(None).cast("string")
    return violations.select(*keys, "type", F.coalesce(right, category, F.lit("")).alias("subject"))


def tag_sets(sets: dict[str, DataFrame], on: list[str]) -> DataFrame:
    """Each distinct key of any set once, with a flag per set.

    This is the full outer join of the sets as one grouped aggregate: each set
    is read once, duplicates fold before the only shuffle.
    """
    parts = [
        rows.select(*on, *[F.lit(other == name).alias(other) for other in sets]) for name, rows in sets.items()
    ]
    return reduce(DataFrame.unionByName, parts).groupBy(*on).agg(*[F.bool_or(name).alias(name) for name in sets])


def match_sets(detected: DataFrame, expected: DataFrame, on: list[str]) -> DataFrame:
    """Both sets' distinct keys with the flags ``detected`` and ``expected``."""
    return tag_sets({"detected": detected, "expected": expected}, on)


def _confusion() -> list[Column]:
    hit, want = F.col("detected"), F.col("expected")
    return [
        F.count_if(hit & want).alias("true_positives"),
        F.count_if(hit & ~want).alias("false_positives"),
        F.count_if(~hit & want).alias("false_negatives"),
    ]


def confusion_counts(matched: DataFrame, keys: list[str]) -> DataFrame:
    return matched.groupBy(*keys).agg(*_confusion())


def violation_accuracy(
    detected: DataFrame, expected: DataFrame, non_violations: DataFrame, keys: list[str], only_listed_types: bool = False
) -> DataFrame:
    """Accuracy of detected violations; non-violations left undetected are true negatives.

    ``only_listed_types`` scores only violation types the expectation mentions.
    """
    found, wanted, spared = (violation_keys(df, keys) for df in (detected, expected, non_violations))
    if only_listed_types:
        found = found.join(wanted.select("type").union(spared.select("type")).distinct(), "type", "left_semi")
    tagged = tag_sets({"detected": found, "expected": wanted, "spared": spared}, [*keys, "type", "subject"])
    quiet = F.count_if(F.col("spared") & ~F.col("detected")).alias("true_negatives")
    tp, fp, fn, tn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives", "true_negatives"))
    return tagged.groupBy(*keys).agg(*_confusion(), quiet).withColumn(
        "accuracy", N.round_exact(ratio(tp + tn, tp + fp + fn + tn), 4))


def precision_recall(matched: DataFrame, keys: list[str]) -> DataFrame:
    """Precision, recall and F1 (zero division gives 0) from matched sets."""
    tp, fp, fn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives"))
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return confusion_counts(matched, keys).withColumns({
        "precision": N.round_exact(p, 4), "recall": N.round_exact(r, 4), "f1": N.round_exact(f1, 4),
    })


def type_lists(matched: DataFrame, keys: list[str], subject: str) -> DataFrame:
    """Sorted detected, expected, missed and extra values; values per key are rule-pack types."""
    value = F.col(subject)
    lists = {
        "detected_list": F.col("detected"), "expected_list": F.col("expected"),
        "missed": F.col("expected") & ~F.col("detected"), "extra": F.col("detected") & ~F.col("expected"),
    }
    return matched.groupBy(*keys).agg(*[
        F.array_sort(F.collect_list(F.when(cond, value))).alias(name) for name, cond in lists.items()
    ])


def pii_type_sets(detected: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Matched PII types, lower-cased; empty names are left out."""
    fold = lambda df: df.select(*keys, F.lower("type").alias("type")).where(F.col("type") != "")
    return match_sets(fold(detected), fold(expected), [*keys, "type"])


def array_overlap(detected: Column, expected: Column) -> dict[str, Column]:
    """The same comparison on array columns of one row."""
    return {
        "both": F.array_sort(F.array_intersect(detected, expected)),
        "missed": F.array_sort(F.array_except(expected, detected)),
        "extra": F.array_sort(F.array_except(detected, expected)),
    }


def flagged_rights(violations: DataFrame, keys: list[str]) -> DataFrame:
    """Rights an audit reported as missing, lower-cased."""
    return violations.where(F.col("type") == "MISSING_RIGHT").select(*keys, F.lower("right").alias("right")).distinct()


def coverage_check(expected: DataFrame, violations: DataFrame, keys: list[str]) -> DataFrame:
    """Per expected right: correct when it is covered or flagged, not both or neither."""
    flagged = flagged_rights(violations, keys).withColumn("detected_missing", F.lit(True))
    return (
        expected.select(*keys, F.lower("right").alias("right"), "covered")
        .join(flagged, [*keys, "right"], "left")
        .withColumn("detected_missing", F.coalesce("detected_missing", F.lit(False)))
        .withColumn("correct", F.col("covered") != F.col("detected_missing"))
    )


def coverage_score(checked: DataFrame, keys: list[str], total: int = TOTAL_CLAUSES) -> DataFrame:
    return checked.groupBy(*keys).agg(F.count_if("correct").alias("correct")).select(
        *keys, "correct", F.lit(total).cast("bigint").alias("total"),
        N.round_exact(ratio(F.col("correct"), F.lit(total)), 4).alias("score"),
    )


def classification_report(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means.

    Works on the class-by-class counts, so only those are shuffled.
    """
    cells = predictions.select(F.col(label).cast("string").alias("label"), F.col(prediction).cast("string").alias("prediction")) \
        .groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp"),
                 F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("tp"),
                 F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")),
    )))
    per_class = sides.groupBy("class").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted"))
    p, r = ratio(F.col("tp"), F.col("predicted")), ratio(F.col("tp"), F.col("support"))
    per_class = per_class.withColumns({"p": p, "r": r}).withColumn(
        "f", F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0))
    s = F.col("support")
    # The rollup's total row turns into the three summary rows: classes are read once.
    rolled = per_class.rollup("class").agg(
        F.grouping("class").alias("is_total"),
        F.sum("tp").alias("tp"), F.sum(s).alias("support"),
        *[F.avg(c).alias(f"macro_{c}") for c in "prf"],
        *[ratio(F.sum(F.col(c) * s), F.sum(s)).alias(f"weighted_{c}") for c in "prf"],
    )
    accuracy = ratio(F.col("tp"), F.col("support"))

    def line(name: Column, *values: Column) -> Column:
        return F.struct(name.alias("class"), *[v.alias(n) for n, v in zip("prf", values)], s.alias("support"))

    macro = [F.col(f"macro_{c}") for c in "prf"]
    lines = F.when(F.col("is_total") == 0, F.array(line(F.col("class"), *macro))).otherwise(F.array(
        line(F.lit("accuracy"), accuracy, accuracy, accuracy),
        line(F.lit("macro avg"), *macro),
        line(F.lit("weighted avg"), *[F.col(f"weighted_{c}") for c in "prf"]),
    ))
    return rolled.select(F.inline(lines)).select(
        "class", N.round_exact(F.col("p"), 4).alias("precision"), N.round_exact(F.col("r"), 4).alias("recall"),
        N.round_exact(F.col("f"), 4).alias("f1"), "support",
    )


def stage_status(metrics: DataFrame, keys: list[str], gate: float = STAGE_GATE) -> DataFrame:
    """One row per audit stage with its status and score.

    ``metrics`` holds per key: ``has_rules``, ``has_appeal``, ``has_summary``,
    ``has_violations`` (booleans), ``pii_f1``, ``violation_accuracy`` and
    ``coverage_score`` (null when not evaluated).
    """
    def gated(*scores: Column) -> Column:
        known, passed = F.lit(True), F.lit(True)
        for s in scores:
            known, passed = known & s.isNotNull(), passed & (s >= gate)
        return F.when(~known, "NOT_EVALUATED").when(passed, "PASS").otherwise("NEEDS_IMPROVEMENT")

    present = lambda flag: F.when(F.coalesce(flag, F.lit(False)), "PASS").otherwise("PARTIAL")
    f1, accuracy, score = F.col("pii_f1"), F.col("violation_accuracy"), F.col("coverage_score")
    none = F.lit(None).cast("double")
    rows = [
        ("Regulatory Analyst", present(F.col("has_rules")), none),
        ("Data Forensics", gated(f1), f1),
        ("Compliance Auditor", gated(accuracy, score), F.least(accuracy, score)),
        ("Appeals Processor", present(F.col("has_appeal")), none),
        ("Report Generator", present(F.col("has_summary") & F.col("has_violations")), none),
    ]
    return metrics.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(n).alias("stage"), s.alias("status"), v.cast("double").alias("score")) for n, s, v in rows
    ])))


def validate_ground_truth(submissions: DataFrame, document: str, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    """Submissions plus ``is_valid`` and a message naming the first missing key."""
    message = J.missing_key_message(F.col(document), pack.ground_truth_keys)
    return submissions.withColumn("message", message).withColumn("is_valid", F.col("message") == "Valid")
