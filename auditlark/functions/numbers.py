"""Rounding, day differences, vector products and portable hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditlark.functions.literals import constant

def round_exact(value: Column, digits: int) -> Column:
    """Round the exact binary value, ties to even, to at most seven digits.

    ``round`` works on the shortest decimal form and rounds ties up, so 2.675
    would become 2.68. Here the product with the power of ten is split into
    its rounded value and its exact error (halves of 26 bits multiply without
    rounding); where the product looks like a tie the error decides.
    """
    power = F.lit(float(10 ** digits))

    def rounded(x: Column) -> Column:
        product = x * power
        shifted = x * F.lit(134217729.0)
        high = shifted - (shifted - x)
        error = (high * power - product) + (x - high) * power
        below = F.floor(product).cast("double")
        tie = product - below == 0.5
        whole = F.when(tie & (error > 0), below + 1).when(tie & (error < 0), below).otherwise(F.rint(product))
        return F.when(F.abs(product) < float(1 << 52), whole / power).otherwise(x)

    return F.get(F.transform(F.array(value.cast("double")), rounded), F.lit(0))


def whole_days(start: Column, end: Column) -> Column:
    """Floor of the whole days between two zone-free timestamps.

    Dates and times of day are compared apart, so no session time zone and no
    clock change can shift the result.
    """
    def time_of_day(t: Column) -> Column:
        return t - t.cast("date").cast("timestamp_ntz")

    days = F.datediff(end.cast("date"), start.cast("date"))
    return (days - F.when(time_of_day(end) < time_of_day(start), 1).otherwise(0)).cast("bigint")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 for a zero vector."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(F.lit(0.0))


def uniform_int(key: Column, salt: str, seed: int = 42) -> Column:
    """A repeatable number in [0, 2^32) for a row key: any partitioning, any engine."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(salt), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def pick(key: Column, salt: str, values, seed: int = 42) -> Column:
    """One of the values, chosen by the row key."""
    return F.element_at(
        constant(list(values)), (F.pmod(uniform_int(key, salt, seed), F.lit(len(values))) + 1).cast("int")
    )


def number_between(key: Column, salt: str, low: int, high: int, seed: int = 42) -> Column:
    return F.pmod(uniform_int(key, salt, seed), F.lit(high - low + 1)) + F.lit(low)


def chance(key: Column, salt: str, percent: int, seed: int = 42) -> Column:
    return F.pmod(uniform_int(key, salt, seed), F.lit(100)) < percent
