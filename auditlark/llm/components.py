"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlark.llm import store


def _lowest(links: DataFrame) -> DataFrame:
    """Per node its smallest neighbour or itself; partial aggregation spares hot nodes the shuffle."""
    return links.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` of every node that has a link; the component is its smallest node.

    Alternates two rewritings until nothing changes: each node hangs its larger neighbours onto
    its smallest one, then its smaller neighbours. Both keep components, the number of links never
    grows, and a group of any size becomes a star within a few rounds. Nulls and self-links link nothing.
    """
    ends = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a != b")
    star = store.written(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_lowest(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a != b").distinct()
        low = _lowest(large)
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
        star = store.written(small.where("a != b").distinct(), "links")
        now = star.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = star.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return roots.unionByName(star.select(F.col("a").alias("node"), F.col("b").alias("component")))
