"""URL filters: a trie over reversed host labels and path segments, with longest-match precedence.

A rule names a host and the start of a path and allows or blocks. It fits its host and all hosts below it. The trie goes down from the
last label of the host to the first; every node that ends a rule's host has a second trie over the rule's whole path segments, and at its nodes
the beginnings that the next segment must have. Of the rules that fit, the one with the longest host wins, then the one with the
longest path; where the same host and path is both allowed and blocked, it is blocked. URLs no rule fits get ``otherwise``.

A pass matches every URL against one broadcast trie of at most ``rules_per_pass`` rules, each cut off by no length: longer lists take more passes, which keep the
best match so far, so the result does not depend on the number of passes. Nothing is shuffled; a host that a third of all pages share costs no more than others.

The host is what stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, with A-Z lower-cased and a port as part of it; the path
goes from there to the next ``?``, ``#`` or the end. A null URL or one without ``://`` has an empty host and path, which only a rule without host and path
would fit. Rows stay as they are, repeated ones and those without id too; existing columns of the added names are replaced.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlark.llm import store
from auditlark.llm.batches import small_batches

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VERDICTS = ("allow", "block")
ADDED = ("host", "path", "rule", "verdict")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path of a URL; both empty where there is no ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*).*$"
    plain = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(plain, parts, 1), UPPER, LOWER), F.regexp_extract(plain, parts, 2)


def split_rule(rule: str) -> tuple[str, str]:
    """Host and path of a rule as written, ``example.org/en/1``."""
    at = rule.find("/")
    host, path = (rule, "") if at < 0 else (rule[:at], rule[at:])
    return host.translate(str.maketrans(UPPER, LOWER)), path


@dataclasses.dataclass(slots=True)
class Segments:
    """A node of the path trie: deeper whole segments, and the beginnings of the next one that end a rule."""
    below: dict[str, Segments] = dataclasses.field(default_factory=dict)
    ends: dict[str, tuple[str, str]] = dataclasses.field(default_factory=dict)
    longest: int = 0


@dataclasses.dataclass(slots=True)
class Labels:
    """A node of the host trie: the labels in front of it, and the paths of rules for this host."""
    below: dict[str, Labels] = dataclasses.field(default_factory=dict)
    paths: Segments | None = None


class Trie:
    """Rules as ``(verdict, rule)``. It travels as its list of rules, so no depth is too much for pickling."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root, self.rules = Labels(), list(rules)
        for verdict, rule in self.rules:
            if verdict not in VERDICTS:
                raise ValueError(f"a rule's verdict is one of {VERDICTS}, not {verdict!r}")
            self._add(verdict, rule)

    def __reduce__(self):
        return Trie, (self.rules,)

    def _add(self, verdict: str, rule: str) -> None:
        host, path = split_rule(rule)
        node = self.root
        for label in reversed(host.split(".")):
            node = node.below.setdefault(label, Labels())
        at = node.paths = node.paths or Segments()
        *whole, last = path.split("/")
        for segment in whole:
            at = at.below.setdefault(segment, Segments())
        known = at.ends.get(last)
        if known is None or verdict == "block":
            at.ends[last] = (host + path, verdict)
        at.longest = max(at.longest, len(last))

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """``(rule, verdict)`` of the longest rule that fits."""
        node, hosts = self.root, []
        for label in reversed(host.split(".")):
            node = node.below.get(label)
            if node is None:
                break
            if node.paths:
                hosts.append(node.paths)
        segments = path.split("/")
        for at in reversed(hosts):
            found = None
            for segment in segments:
                for size in range(min(len(segment), at.longest), -1, -1):
                    end = at.ends.get(segment[:size])
                    if end:
                        found = end
                        break
                at = at.below.get(segment)
                if at is None:
                    break
            if found:
                return found
        return None


def _longer(a: tuple[str, str] | None, b: tuple[str, str] | None) -> tuple[str, str] | None:
    """The rule that takes precedence; rules that fit the same URL differ in the length of host or path unless they are the same."""
    if a is None or b is None:
        return a or b

    def rank(found):
        host, path = split_rule(found[0])
        return len(host), len(path), found[1] == "block"

    return max(a, b, key=rank)


def judge(pages: DataFrame, rules: Iterable[tuple[str, str]] | DataFrame, url_col: str = "url", otherwise: str = "allow",
          rules_per_pass: int = 500_000) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``.

    ``rules`` are pairs of verdict and rule, or a DataFrame ``(verdict, rule)``, of which each pass fetches its part; null ones are left out.
    """
    spark = pages.sparkSession
    others = [c for c in pages.columns if c not in ADDED]
    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    rows = small_batches(pages).select(*(F.col(f"`{c}`") for c in others), host.alias("host"), path.alias("path"),
                                       F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in rows.schema.fields)])
    first = len(others)
    if isinstance(rules, DataFrame):
        listed = store.written(rules.select("verdict", "rule").where("verdict IS NOT NULL AND rule IS NOT NULL").distinct(), "url_rules")
        passes = max(1, -(-listed.count() // max(1, rules_per_pass // 2)))
        parts = (((r[0], r[1]) for r in listed.where(F.pmod(F.xxhash64("rule"), F.lit(passes)) == k).toLocalIterator()) for k in range(passes))
    else:
        listed = [(v, r) for v, r in rules if v is not None and r is not None]
        passes = max(1, -(-len(listed) // rules_per_pass))
        parts = (listed[k::passes] for k in range(passes))

    for k, part in enumerate(parts):
        shared = spark.sparkContext.broadcast(Trie(part))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trie = shared.value
            for batch in batches:
                found = [_longer(trie.match(h, p), (r, v) if r is not None else None)
                         for h, p, r, v in zip(*(batch.column(first + i).to_pylist() for i in range(4)))]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:first + 2], pa.array([f and f[0] for f in found], pa.string()), pa.array([f and f[1] for f in found], pa.string())],
                    names=batch.schema.names)

        rows = rows.mapInArrow(run, schema)
        if k + 1 < passes:
            rows = store.written(rows, "url_matches")
    return rows.withColumn("verdict", F.coalesce("verdict", F.lit(otherwise)))
