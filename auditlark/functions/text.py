"""Text expressions: matching, counting, splitting, cleaning and scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditlark.functions.literals import constant
from auditlark.rulepack import DEFAULT_PACK, PARAGRAPH_BREAK, RulePack

# Unicode character classes, and a dot that stops at line feeds only.
REGEX_FLAGS = "(?Ud)"
# Every character that is white space in Unicode, and the four separators that Python strips too.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# A cell separator that no PII pattern can match, so that none joins two cells.
CELL_SEPARATOR = "\u0001"
TERMS_PER_MASK = 60
# Up to this length one pattern of all terms is cheaper than a search for each of them.
SHORT_TEXT = 400


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``.

    Catalyst inlines a projected column into the single lambda that reads it,
    where it would be computed again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(fields: Column) -> Column:
    """The fields of a struct as columns that are computed exactly once per row.

    A plain projection may be merged into the aggregate above it, and some
    aggregates (``bit_or``) then evaluate their input twice. Nothing is merged
    across a generator, and one over a single struct neither adds nor drops rows.
    """
    return F.inline(F.array(fields))


def regex_quote(term: str) -> str:
    return "".join(ch if ch.isalnum() or ch == " " else "\\" + ch for ch in term)


def strip(text: Column) -> Column:
    """Remove every kind of blank at both ends (``trim`` removes spaces only)."""
    return F.btrim(text, F.lit(BLANKS))


def contains_any(text: Column, terms) -> Column:
    """Does the text hold any term? Bind a computed text with ``let`` first."""
    if len(terms) == 1:
        return F.contains(text, F.lit(terms[0]))
    return F.exists(constant(list(terms)), lambda t: F.contains(text, t))


def matched_terms(text: Column, terms) -> Column:
    """All terms the text holds, in declared order."""
    return F.filter(constant(list(terms)), lambda t: F.contains(text, t))


def first_term(text: Column, terms) -> Column:
    """The first term, in declared order, that the text holds; else null."""
    return F.get(matched_terms(text, terms), F.lit(0))


def pattern_count(text: Column, pattern: str, needs=(), possible: Column | None = None, start: str = "") -> Column:
    """Number of non-overlapping matches; 0 for null text.

    ``needs`` (literals, any of them) and ``possible`` (a boolean) say when a
    match can exist at all, ``start`` (a lookahead) where one can begin.
    """
    hits = F.regexp_count(text, F.lit(REGEX_FLAGS + start + pattern)).cast("bigint")
    if needs:
        hits = F.when(contains_any(text, needs), hits)
    if possible is not None:
        hits = F.when(possible, hits)
    return F.coalesce(hits, F.lit(0).cast("bigint"))


def with_probes(text: Column, pack: RulePack, body) -> Column:
    """``body(possible)`` with every distinct probe of the pack tried once on
    the text; ``possible(pattern)`` is None for a pattern without a probe."""
    wanted = list(dict.fromkeys(pack.probe(p) for _, p in pack.patterns if pack.probe(p)))
    if not wanted:
        return body(lambda pattern: None)
    tried = F.array(*[has_pattern(text, probe) for probe in wanted])

    def chosen(results: Column):
        return lambda pattern: F.get(results, F.lit(wanted.index(pack.probe(pattern)))) if pack.probe(pattern) else None

    return let(tried, lambda results: body(chosen(results)))


def pattern_counts(text: Column, pack: RulePack = DEFAULT_PACK) -> Column:
    """Matches per pattern as an array in the pack's order."""
    return with_probes(text, pack, lambda possible: F.array(*[
        pattern_count(text, p, pack.needs(p), possible(p), pack.start(p)) for _, p in pack.patterns
    ]))


def has_pattern(text: Column, pattern: str, needs=()) -> Column:
    hit = F.rlike(text, F.lit(REGEX_FLAGS + pattern))
    return contains_any(text, needs) & hit if needs else hit


def term_masks(text: Column, terms, word_boundary: bool = False) -> list[Column]:
    """Which terms occur, as bit masks of up to ``TERMS_PER_MASK`` terms.

    ``bit_or`` over a mask is one long per group, where one flag per term
    would be dozens of aggregation buffers. The fold over a constant array is
    about three times as fast as the same tests written out one by one, whose
    generated method grows too long to be compiled.
    """
    def mask(chunk):
        needles = [rf"{REGEX_FLAGS}\b{regex_quote(t)}\b" for t in chunk] if word_boundary else list(chunk)
        hit = F.rlike if word_boundary else F.contains
        bits = constant([{"needle": n, "bit": 1 << i} for i, n in enumerate(needles)])
        return F.aggregate(
            bits, F.lit(0).cast("bigint"), lambda acc, x: F.when(hit(text, x["needle"]), acc.bitwiseOR(x["bit"])).otherwise(acc)
        )

    return [mask(terms[start:start + TERMS_PER_MASK]) for start in range(0, len(terms), TERMS_PER_MASK)]


def any_term_pattern(terms) -> str:
    """One pattern for any of the terms, sorted by their first characters so that most places of a text cost one test."""
    by_first = {}
    for term in dict.fromkeys(terms):
        by_first.setdefault(term[0], []).append(term[1:])
    starts = "".join(regex_quote(c) for c in by_first)
    rests = (regex_quote(c) + "(?:" + "|".join(map(regex_quote, rest)) + ")" for c, rest in by_first.items())
    return f"(?=[{starts}])(?:{'|'.join(rests)})"


def may_hold_terms(text: Column, terms) -> Column:
    """False for a short text without any of the terms, which one pattern tells; most cells of tables are such."""
    if not terms or not all(terms):
        return F.lit(bool(terms))
    return (F.length(text) > SHORT_TEXT) | F.rlike(text, F.lit(any_term_pattern(terms)))


def mask_terms(groups: list[tuple[str, tuple]]) -> list[dict]:
    """A table of (name, terms) with the mask position of every term, the terms
    of all groups being numbered through."""
    rows, position = [], 0
    for name, terms in groups:
        places = range(position, position + len(terms))
        rows.append({"name": name, "terms": [
            {"term": t, "word": i // TERMS_PER_MASK, "bit": 1 << (i % TERMS_PER_MASK)} for t, i in zip(terms, places)
        ]})
        position += len(terms)
    return rows


def seen_terms(masks: list[Column], terms: Column) -> Column:
    """Terms of one ``mask_terms`` row whose bits are set, in declared order."""
    words = F.array(*masks)
    hit = lambda t: F.get(words, t["word"].cast("int")).bitwiseAND(t["bit"]) != 0
    return F.transform(F.filter(terms, hit), lambda t: t["term"])


def column_hint(name: Column, pack: RulePack = DEFAULT_PACK) -> Column:
    """PII type a column name suggests: the first type with a hint in it."""
    table = constant([{"type": kind, "hints": list(hints)} for kind, hints in pack.column_hints])
    return let(F.lower(strip(name)), lambda n: F.get(
        F.filter(table, lambda row: F.exists(row["hints"], lambda h: F.contains(n, h))), F.lit(0))["type"])


def number_words_to_digits(text: Column, pack: RulePack = DEFAULT_PACK) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), pack.number_words, F.lower(text))


def paragraphs(text: Column, min_length: int = 30) -> Column:
    """Paragraphs of at least ``min_length`` characters; else the whole text."""
    parts = F.filter(F.transform(F.split(text, PARAGRAPH_BREAK), strip), lambda p: F.length(p) >= min_length)
    return let(parts, lambda kept: F.when(F.size(kept) > 0, kept).otherwise(F.array(text)))


# Markup that is dropped whole, then tags, then the entities worth decoding.
MARKUP_BLOCKS = (r"(?is)<script\b[^>]*>.*?</script\s*>", r"(?is)<style\b[^>]*>.*?</style\s*>", r"(?s)<!--.*?-->",
                 r"(?s)<[^>]*>")
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def html_to_text(markup: Column) -> Column:
    text = reduce(lambda c, p: F.regexp_replace(c, p, " "), MARKUP_BLOCKS, markup)
    text = reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES, text)
    return F.trim(F.regexp_replace(text, r"\s+", " "))


WORD = r"[\p{L}\p{N}_]{2,}"
PYTHON_WORD = r"\w{2,}"


def frequencies(words: Column) -> Column:
    """``(word, n)`` of the distinct words of a list: it is sorted and cut where the word changes, so long texts cost no more per word."""
    def runs(ordered: Column) -> Column:
        size = F.size(ordered)
        starts = F.filter(F.sequence(F.lit(0), size - 1), lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        return F.when(size > 0, let(starts, lambda at: F.zip_with(
            at, F.concat(F.slice(at, F.lit(2), F.size(at)), F.array(size)), lambda i, j: F.struct(F.get(ordered, i).alias("word"), (j - i).alias("n")))))

    return F.coalesce(let(F.sort_array(words), runs), F.array().cast("array<struct<word:string,n:int>>"))
