"""Bounded samples of labelled rows for fitting models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def uniform(key: str | Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the key only, so a repeated task draws the same rows."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(key.cast("string"), F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))


def per_class(rows: DataFrame, id_col: str, label: str, cap: int, seed: int = 7) -> tuple[DataFrame, dict]:
    """About ``cap`` rows of every class, drawn by id, and each class's share kept.

    One aggregation counts the classes, which must be few; classes below the cap are kept whole.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    share = {k: min(1.0, cap / n) for k, n in counts.items()}
    wanted = F.lit(0.0)
    for k, s in share.items():
        wanted = F.when(F.col(label) == k, F.lit(s)).otherwise(wanted)
    return rows.where(uniform(id_col, seed) < wanted), share
