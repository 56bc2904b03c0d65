"""JSON inside text columns: finding it, unwrapping it, reading it by key chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditlark.functions import text as X
from auditlark.rulepack import FENCED_BLOCK


def is_json(text: Column) -> Column:
    """Is the whole text one JSON value?

    The parser stops after the first value and ignores what follows. So the
    text is parsed as the first of two array elements, and the second must be found.
    """
    mark = F.md5(text)
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(', "'), mark, F.lit('"]')))
    return F.coalesce(F.try_variant_get(pair, "$[1]", "string") == mark, F.lit(False))


def _first_balanced(text: Column, opening: str, closing: str) -> Column:
    """The text from the first opening bracket to the one that closes it, else null."""
    start = F.instr(text, opening)
    rest = F.substr(text, F.greatest(start, F.lit(1)))
    chunks = F.regexp_extract_all(rest, F.lit(rf"[^\{opening}\{closing}]*[\{opening}\{closing}]"), F.lit(0))
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("length"), F.lit(0).alias("end"))

    def step(acc, chunk):
        depth = acc["depth"] + F.when(F.right(chunk, F.lit(1)) == opening, 1).otherwise(-1)
        length = acc["length"] + F.length(chunk)
        end = F.when((acc["end"] == 0) & (depth == 0), length).otherwise(acc["end"])
        return F.struct(depth.alias("depth"), length.alias("length"), end.alias("end"))

    end = F.aggregate(chunks, zero, step)["end"]
    return F.when((start > 0) & (end > 0), F.substr(rest, F.lit(1), end))


def json_payload(text: Column) -> Column:
    """The JSON a text carries: the whole text, else the first valid fenced
    block, else the first balanced object, else the first balanced array.
    Null when none of them is valid JSON."""
    blocks = F.filter(
        F.transform(F.regexp_extract_all(text, F.lit(FENCED_BLOCK), F.lit(1)), X.strip), is_json
    )
    valid = lambda candidate: X.let(candidate, lambda c: F.when(is_json(c), c))
    return F.coalesce(
        F.when(is_json(text), text),
        F.get(blocks, F.lit(0)),
        valid(_first_balanced(text, "{", "}")),
        valid(_first_balanced(text, "[", "]")),
    )


def json_payload_or_text(text: Column) -> Column:
    """As ``json_payload``, but falls back to the text itself, or ``{}`` without text."""
    return F.coalesce(json_payload(text), F.nullif(text, F.lit("")), F.lit("{}"))


def unwrap_json(text: Column) -> Column:
    """JSON that was encoded as a string once or more, as an object or array.

    Each level of encoding doubles the backslashes before the inner quotes, so a
    text has fewer levels than its length has binary digits. A plain string is wrapped as ``{"raw": ...}``; malformed text is null.
    """
    def string_in(c: Column) -> Column:
        """The text inside a JSON string, null for any other value."""
        variant = F.try_parse_json(c)
        return F.when(is_json(c) & (F.schema_of_variant(variant) == "STRING"), F.try_variant_get(variant, "$", "string"))

    def unwrap(c: Column) -> Column:
        return X.let(string_in(c), lambda inner: F.when(is_json(inner), inner).otherwise(c))

    def finish(c: Column) -> Column:
        wrapped = F.to_json(F.struct(string_in(c).alias("raw")))
        return F.when(string_in(c).isNotNull(), wrapped).when(is_json(c), c)

    levels = F.ceil(F.log2(F.length(text) + 2)).cast("int")
    bare = F.aggregate(F.sequence(F.lit(1), levels), text, lambda c, _: X.let(c, unwrap))
    return X.let(bare, finish)


def missing_key_message(document: Column, required) -> Column:
    """'Valid', or the first required key that the JSON object lacks."""
    keys = F.coalesce(F.json_object_keys(document), F.array().cast("array<string>"))
    absent = F.array_except(F.array(*[F.lit(k) for k in required]), keys)
    return F.when(F.size(absent) == 0, "Valid").otherwise(
        F.concat(F.lit("Missing required key: '"), F.get(absent, F.lit(0)), F.lit("'"))
    )
