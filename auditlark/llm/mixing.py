"""Mixing by soft membership: how often to take each document so that the domains' tokens match target weights.

1. A naive Bayes classifier over a few text statistics learns the domains from a labelled table: one grouped count per feature.
   Its posteriors make every document, labelled or not, a member of all domains in parts.
2. Documents with equal statistics have equal posteriors; they form a cell. Cells are bounded by the number of statistic values
   (``max_cells``), not by the corpus, and carry their token sums.
3. Projected gradient on the least squares between the expected share of each domain's tokens and its target, in the metric of the
   domains' overlap among the cells that still have a rate, plus a ridge. A step that does not bring the targets closer is taken back and
   the ridge raised, which makes it a shorter step along the plain gradient; else the ridge falls. So every step kept descends. Every trial is
   one aggregation over the cells; a cell's rate follows from the list of the steps kept, which is as long as steps times domains. The
   fit ends when the targets are met or no step brings them closer; what is missed then is logged.
4. A document is taken floor(rate + u) times, u a number in [0, 1) drawn from its id, and ``at_least`` times.

Null or empty texts have no tokens and take no part in the fit; they get the rate of their cell. Domains without target weight are
driven to zero, targets without any member are ignored. Of several labels of one id each counts. Without labels, or without tokens, every rate
is 1. Rows that share an id are drawn alike. Other columns pass through.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlark.functions.text import once
from auditlark.llm import store
from auditlark.llm.samples import uniform

NO_CAPITALS = "[^A-Z]+"
NO_SYMBOLS = r"""[^!"#$%&()*+/:;<=>?@\[\]^_{|}~]+"""
RIDGE, LOWEST, HIGHEST = 1e-3, 1e-6, 1e3   # of the first step, and its range; in shares of the tokens
GAIN = 1e-5           # of the squared miss: three kept steps in a row below it end the fit
OTHER = "\0"          # languages of no labelled row
FEATURES = ("f_lang", "f_size", "f_capitals", "f_symbols", "f_word")


def token_count(text: Column) -> Column:
    """Pieces between blanks and line feeds; none in an empty text."""
    apart = F.length(text) - F.length(F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit("")))
    return F.when(text == "", 0).otherwise(apart + 1).cast("long")


def statistics(docs: DataFrame, text_col: str, lang_col: str | None, languages: list[str]) -> DataFrame:
    """``docs`` with ``n_tokens`` and the binned statistics; languages beyond the listed ones are one value, rows without one another."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, ""))

    # Every text is gone through once for each measure; the bins work on the numbers.
    measures = once(F.struct(token_count(text).alias("n_tokens"), F.greatest(F.length(text), F.lit(1)).alias("__size"),
                             left(NO_CAPITALS).alias("__capitals"), left(NO_SYMBOLS).alias("__symbols")))

    def binned(value: Column, cuts: tuple[float, ...]) -> Column:
        return sum(((value >= c).cast("int") for c in cuts[1:]), (value >= cuts[0]).cast("int"))

    size = F.col("__size")
    own = F.col(f"`{lang_col}`").cast("string") if lang_col and languages else None
    lang = F.when(own.isNull(), "").when(own.isin(*languages), own).otherwise(OTHER) if own is not None else F.lit("")
    return docs.select("*", measures).select(
        *(F.col(f"`{c}`") for c in docs.columns), "n_tokens", lang.alias("f_lang"), F.least(F.lit(16), F.floor(F.log2(size.cast("double"))).cast("int")).alias("f_size"),
        binned(F.col("__capitals") / size, (0.05, 0.15, 0.4)).alias("f_capitals"), binned(F.col("__symbols") / size, (0.005, 0.03, 0.1)).alias("f_symbols"),
        binned(size / (F.col("n_tokens") + 1), (5.0, 6.0, 7.0, 8.0, 10.0)).alias("f_word"))


def _posteriors(cells: DataFrame, labelled: DataFrame, domains: list[str]) -> DataFrame:
    """``cells`` with the array ``p`` of domain probabilities; naive Bayes with add-one smoothing."""
    k = len(domains)
    total = labelled.groupBy("domain").count().collect()  # one row per domain
    n = {r["domain"]: r["count"] for r in total}
    everything = sum(n.values())
    start = F.lit([math.log((n[d] + 1) / (everything + k)) for d in domains])
    values = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in FEATURES))).alias("v")
    counts = labelled.select("domain", values).groupBy("v.feature", "v.value", "domain").count()
    per_domain = [F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("count"))), F.lit(0)) for d in domains]
    evidence = counts.groupBy("feature", "value").agg(F.array(*(F.log((c + 1.0) / F.lit(float(n[d] + 20))) for c, d in zip(per_domain, domains))).alias("e"))
    seen = cells.select(*FEATURES, values).select(*FEATURES, "v.feature", "v.value").join(evidence, ["feature", "value"], "left")
    none = F.lit([math.log(1.0 / (n[d] + 20)) for d in domains])
    logs = seen.groupBy(*FEATURES).agg(F.array(*(F.sum(F.coalesce("e", none)[i]) for i in range(k))).alias("logs"))
    logs = logs.withColumn("logs", F.zip_with("logs", start, lambda a, b: a + b)).withColumn("top", F.array_max("logs"))
    odds = logs.select(*FEATURES, F.transform("logs", lambda x: F.exp(x - F.col("top"))).alias("odds"))
    odds = odds.withColumn("all", F.aggregate("odds", F.lit(0.0), lambda s, x: s + x))
    return cells.join(odds.select(*FEATURES, F.transform("odds", lambda x: x / F.col("all")).alias("p")), list(FEATURES))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _rate(steps: list[list[float]]) -> Column:
    """The rate after all projected steps, each a weight per domain."""
    if not steps:
        return F.lit(1.0)
    listed = F.expr("array(" + ", ".join("array(" + ", ".join(f"{x!r}D" for x in s) + ")" for s in steps) + ")")
    return F.aggregate(listed, F.lit(1.0), lambda r, g: F.greatest(F.lit(0.0), r - _dot(F.col("p"), g)))


def fit(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
        keep_all: bool = False, trials: int = 300, tolerance: float = 1e-4, max_cells: int = 200_000) -> tuple[DataFrame, list[str], list[str]]:
    """The cells with ``p`` and ``rate``, the domains in the order of ``p``, and the languages told apart.

    ``labels`` has ``id_col`` and ``domain``. The targets are shares of the present number of tokens, or, with ``keep_all``, of the
    smallest number at which no domain loses tokens. The cells are written and small.
    """
    known = labels.select(F.col(id_col).alias("__id"), "domain").where("__id IS NOT NULL AND domain IS NOT NULL")
    languages = []
    if lang_col:  # those of labelled rows: no other tells the classifier anything
        tagged = docs.select(F.col(id_col).alias("__id"), F.col(lang_col).cast("string").alias("lang")).where("lang IS NOT NULL")
        languages = sorted(r[0] for r in tagged.join(known.select("__id").distinct(), "__id", "left_semi").select("lang").distinct().collect())
    rows = store.written(statistics(docs, text_col, lang_col, languages).select(F.col(id_col).alias("__id"), "n_tokens", *FEATURES), "statistics")
    labelled = rows.join(known, "__id").select("domain", *FEATURES)
    domains = sorted(r[0] for r in known.select("domain").distinct().collect() if r[0] in targets) or []
    labelled = labelled.where(F.col("domain").isin(*domains)) if domains else labelled.limit(0)
    cells = rows.groupBy(*FEATURES).agg(F.sum("n_tokens").alias("tokens"))
    if not domains:
        return cells.select(*FEATURES, F.array().cast("array<double>").alias("p"), F.lit(1.0).alias("rate")), [], languages
    cells = store.written(_posteriors(cells, labelled, domains).coalesce(2), "cells")
    if cells.count() > max_cells:
        raise ValueError("more combinations of statistics than max_cells")

    cells.persist()

    everything = cells.agg(F.sum("tokens").cast("double")).first()[0]

    def measured(rate: Column) -> tuple[np.ndarray, np.ndarray]:
        """Expected share of each domain, and how much domains overlap in the cells with a rate: one row per pair of domains."""
        now = cells.select("tokens", "p", once(F.struct(rate.alias("rate")))).select("tokens", "rate", "p", F.posexplode("p").alias("i", "a"))
        now = now.select("tokens", "rate", "i", "a", F.posexplode("p").alias("j", "b"))
        part = F.col("tokens") * F.col("a") * F.col("b") / F.lit(everything)
        pairs = now.groupBy("i", "j").agg(F.sum(part * F.col("rate")).alias("taken"), F.sum(F.when(F.col("rate") > 0, part).otherwise(0.0)).alias("overlap"))
        taken, overlap = np.zeros(len(domains)), np.zeros((len(domains), len(domains)))
        for r in pairs.collect():
            taken[r["i"]] += r["taken"]  # over all j the memberships of a cell add up to one
            overlap[r["i"], r["j"]] = r["overlap"]
        return taken, overlap

    taken: list[list[float]] = []
    if everything:
        now, overlap = measured(F.lit(1.0))
        goal = np.array([targets[d] for d in domains], "f8")
        goal = goal / goal.sum() if goal.sum() else goal
        if keep_all:
            goal = goal * max((n / g for n, g in zip(now, goal) if g), default=1.0)
        ridge, idle, miss = RIDGE, 0, now - goal
        for _ in range(trials):
            if np.abs(miss).max() < tolerance or ridge > HIGHEST or idle == 3:
                break
            step = np.linalg.solve(overlap + ridge * np.eye(len(domains)), miss).tolist()
            now, there = measured(_rate([*taken, step]))
            gain = 1 - ((now - goal) @ (now - goal)) / (miss @ miss)
            if gain <= 0:
                ridge *= 4
                continue
            taken.append(step)
            miss, overlap, ridge, idle = now - goal, there, max(LOWEST, ridge / 3), idle + 1 if gain < GAIN else 0
        if np.abs(miss).max() >= tolerance:
            logging.getLogger(__name__).warning("targets missed by %s", {d: round(float(x), 6) for d, x in zip(domains, miss)})
    cells.unpersist()
    return cells.select(*FEATURES, "p", _rate(taken).alias("rate")), domains, languages


def mix(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
        keep_all: bool = False, at_least: int = 0, seed: int = 23) -> DataFrame:
    """``docs`` with ``n_tokens``, ``domain`` (the likeliest), ``membership`` (its probability), ``rate`` and ``copies``."""
    cells, domains, languages = fit(docs, labels, targets, id_col, text_col, lang_col, keep_all)
    added = ("n_tokens", "domain", "membership", "rate", "copies")
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in added + FEATURES))
    rows = statistics(kept, text_col, lang_col, languages).join(F.broadcast(cells), list(FEATURES))  # at most max_cells rows
    best = F.array_max("p")
    name = F.get(F.lit(domains), F.array_position("p", best).cast("int") - 1) if domains else F.lit(None).cast("string")
    draw = F.coalesce(uniform(id_col, seed), F.lit(0.5))
    return rows.select(
        *(F.col(f"`{c}`") for c in kept.columns), "n_tokens", name.alias("domain"), (best if domains else F.lit(0.0)).alias("membership"), "rate",
        F.greatest(F.lit(at_least), F.floor(F.col("rate") + draw).cast("int")).alias("copies"))


def expand(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as often as its ``copies`` say, with the given columns."""
    return mixed.where("copies > 0").select(*(F.col(f"`{c}`") for c in columns), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy")).drop("__copy")
