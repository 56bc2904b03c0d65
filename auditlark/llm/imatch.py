"""I-Match fingerprints with several randomised lexicon subsets.

The lexicon holds the terms within a band of inverse document frequency, counted over all distinct texts (as lower-cased words): common terms
carry no identity, rare ones break under small edits. Each of several random subsets of it, of several densities, gives one
component: the hash of the document's distinct terms in that subset, sorted. Two documents are alike in the share of components that agree; sparse subsets
survive edits of long texts, dense ones tell short texts apart.

All that happens to a text happens in its row: its terms are sorted once, looked up in the lexicon and hashed; only counts, and the texts that meet their
neighbours, are shuffled. The lexicon travels as a constant. Its size has a bound that does not grow with the corpus: a term in it is in at
least ``low`` of all documents, so there are at most (mean distinct terms per document) / ``low`` of them.

A text without a component over the lexicon, as all of a group of near copies that holds more than the band's share of texts, has as many over subsets of all its terms
instead; every fingerprint ends with the hash of all words. Likeness is that of the two fingerprints as returned: of components over the same terms, or, where one text has the one kind and one the
other, or neither has any, whether the words are equal. Null text counts as empty; equal texts have equal
fingerprints. Of rows that share an id the one with the smallest text hash counts; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlark.functions.text import let, once
from auditlark.llm import store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOW, HIGH = 0.002, 0.2
DENSITIES = (8, 16, 32, 64, 128, 256)
REPEATS = 4


def words(text: Column) -> Column:
    """Lower-cased words, one blank between them."""
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), NO_WORD, " "))


def _number(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def lexicon(texts: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: float = LOW, high: float = HIGH, densities=DENSITIES, repeats: int = REPEATS) -> DataFrame:
    """``(term, subsets)`` of the terms in the band; bit ``k`` of ``subsets`` tells whether subset ``k`` holds the term."""
    said = words(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    marked = texts.select(F.col(f"`{id_col}`").cast("string").alias("id"), once(F.struct(said.alias("words")))).select("id", "words", F.xxhash64("words").alias("mark"))
    # Of equal texts one counts: rows of the smallest id share the weight. Only hashes and ids are grouped; texts stay where they are read.
    places = marked.groupBy("mark", "id").count()
    seen = store.written(places.groupBy("mark").agg(F.min(F.struct("id", "count")).alias("first"), F.sum("count").alias("rows")).select("mark", "first.*", "rows"), "marks")
    n = seen.count()
    repeated = seen.where("rows > 1").select("mark", F.col("id").alias("first"), (1 / F.col("count")).alias("share"))
    weight = F.when(F.col("share").isNull(), 1.0).when(F.col("id").eqNullSafe(F.col("first")), F.col("share")).otherwise(0.0)
    once_each = marked.join(repeated, "mark", "left").withColumn("weight", weight).where("weight > 0")
    terms = once_each.select("weight", F.explode(F.array_distinct(F.split("words", " "))).alias("term")).where("term != ''")
    counts = terms.groupBy("term").agg(F.round(F.sum("weight")).cast("long").alias("count")).where("count > 1")
    kept = counts.where((F.col("count") >= F.lit(low * n)) & (F.col("count") <= F.lit(high * n)))
    subsets, k = F.lit(0), 0
    for density in densities:
        for r in range(repeats):
            chosen = _number(F.concat("term", F.lit(f"#{r}")), 8) % density == 0
            subsets = subsets.bitwiseOR(F.when(chosen, 1 << k).otherwise(0))
            k += 1
    return store.written(kept.select("term", subsets.alias("subsets")), "lexicon")


class Fingerprinter:
    """The components of texts, as an expression over one row."""

    def __init__(self, terms: DataFrame, densities=DENSITIES, repeats: int = REPEATS):
        self.n_band = len(densities) * repeats
        listed = [(r["term"], r["subsets"]) for r in terms.collect() if r["subsets"]]  # bounded, see above
        self.cells = max(1, len(listed) // 4)
        cells: list[dict[str, int]] = [{} for _ in range(self.cells)]  # a map is searched from its start, so the lexicon is many short maps
        for term, subsets in listed:
            cells[zlib.crc32(term.encode()) % self.cells][term] = subsets
        self.table = F.from_json(F.lit(json.dumps(cells)), "array<map<string,bigint>>")

    def components(self, text: Column) -> Column:
        """``band``, ``rest``: arrays that are null where a subset has no term of the text, ``rest`` null where ``band`` has any; ``words``: the hash of all of them."""
        def subsets(term: Column) -> Column:
            cell = F.get(self.table, F.pmod(F.crc32(term.cast("binary")), F.lit(self.cells)).cast("int"))
            return F.coalesce(F.try_element_at(cell, term), F.lit(0).cast("bigint"))

        def folded(chosen: Column) -> Column:
            return let(chosen, lambda c: F.when(F.size(c) > 0, _number(F.array_join(F.transform(c, lambda x: x["term"]), " "), 15)))

        def rest(terms: Column) -> Column:
            """Subset ``k`` draws by the two digits of a term's hash that begin at ``k``, so its draws are its own."""
            drawn = F.transform(terms, lambda t: F.struct(t.alias("term"), F.md5(t.cast("binary")).alias("draw")))
            densities = [density for density in DENSITIES for _ in range(REPEATS)]
            return let(drawn, lambda d: F.array(*(
                folded(F.filter(d, lambda x: F.conv(F.substring(x["draw"], k + 1, 2), 16, 10).cast("int") % density == 0)) for k, density in enumerate(densities))))

        def found(terms: Column) -> Column:
            hits = F.filter(F.transform(terms, lambda t: F.struct(t.alias("term"), subsets(t).alias("subsets"))), lambda x: x["subsets"] != 0)
            band = let(hits, lambda h: F.transform(F.sequence(F.lit(0), F.lit(self.n_band - 1)), lambda k: folded(
                F.filter(h, lambda x: F.call_function("shiftright", x["subsets"], k).bitwiseAND(F.lit(1).cast("bigint")) != 0))))
            return let(band, lambda b: F.struct(b.alias("band"), F.when(_none(b), rest(terms)).alias("rest")))

        def of(said: Column) -> Column:
            distinct = F.sort_array(F.filter(F.array_distinct(F.split(said, " ")), lambda t: t != ""))
            return let(distinct, lambda t: let(found(t), lambda f: F.struct(f["band"].alias("band"), f["rest"].alias("rest"), F.md5(said.cast("binary")).alias("words"))))

        return let(words(F.coalesce(text, F.lit(""))), of)


def _none(components: Column) -> Column:
    return F.forall(components, lambda x: x.isNull())


def rendered(name: str) -> Column:
    """A fingerprint as text: the components over the lexicon, else those over all terms, and the hash of the words."""
    def joined(components: Column) -> Column:
        return F.coalesce(F.array_join(F.transform(components, lambda x: F.coalesce(x.cast("string"), F.lit(""))), "."), F.lit(""))

    return F.concat_ws("|", joined(F.col(f"{name}.band")), joined(F.col(f"{name}.rest")), F.col(f"{name}.words"))


def likeness(a: str, b: str) -> Column:
    """Share of the components either has that agree, of the same kind; else whether the words do."""
    def share(x: Column, y: Column, otherwise: Column) -> Column:
        same = F.aggregate(F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False)).cast("int")), F.lit(0), lambda s, v: s + v)
        some = F.aggregate(F.zip_with(x, y, lambda p, q: (p.isNotNull() | q.isNotNull()).cast("int")), F.lit(0), lambda s, v: s + v)
        return F.when(some > 0, same / some).otherwise(otherwise)

    words_agree = (F.col(f"{a}.words") == F.col(f"{b}.words")).cast("double")
    rests = F.col(f"{a}.rest").isNotNull().cast("int") + F.col(f"{b}.rest").isNotNull().cast("int")
    return F.coalesce(F.when(rests == 0, share(F.col(f"{a}.band"), F.col(f"{b}.band"), words_agree))
                      .when(rests == 2, share(F.col(f"{a}.rest"), F.col(f"{b}.rest"), words_agree)).otherwise(words_agree), F.lit(0.0))


def following(ids: DataFrame, id_col: str, buckets: int = 64) -> DataFrame:
    """``(id, next_id)`` in ascending order, the first following the last; ordered within ranges, never in one task."""
    some = ids.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"))
    cuts = some.agg(F.percentile_approx("id", [k / buckets for k in range(1, buckets)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    bucket = F.size(F.filter(F.lit(cuts), lambda c: c < F.col("id"))) if cuts else F.lit(0)
    placed = some.distinct().withColumn("bucket", bucket)
    firsts = {r["bucket"]: r["first"] for r in placed.groupBy("bucket").agg(F.min("id").alias("first")).collect()}  # one per range
    after, first = {}, min(firsts.values(), default=None)
    for b in sorted(firsts, reverse=True):
        after[b] = first
        first = firsts[b]
    beyond = F.lit(None).cast("long")
    for b, value in after.items():
        beyond = F.when(F.col("bucket") == b, F.lit(value)).otherwise(beyond)
    following_id = F.lead("id").over(Window.partitionBy("bucket").orderBy("id"))
    return placed.select("id", F.coalesce(following_id, beyond).alias("next_id"))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, next_id, text, edited)``: the last quarter of each text replaced by as much of the start of the next document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Both joins read the same texts dealt by id; the filter on both sides keeps them one shuffle.
    known = docs.where(F.col(id_col).isNotNull())
    one = known.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(F.struct(F.xxhash64(text).alias("mark"), text.alias("text"))).alias("v")).select("id", "v.text")
    order = store.written(following(known.select(F.col(id_col).cast("long").alias("id")), "id"), "order")
    sizes = known.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.length(text)).alias("most"))
    wanted = order.join(sizes, "id").select(F.col("id").alias("for_id"), F.col("next_id").alias("id"), F.floor(F.col("most") / 4).cast("int").alias("most"))
    starts = one.join(wanted, "id").select(F.col("for_id").alias("id"), F.col("id").alias("next_id"), F.substring("text", F.lit(1), F.col("most")).alias("start"))
    loose = docs.where(F.col(id_col).isNull()).agg(F.min(F.struct(F.xxhash64(text).alias("mark"), text.alias("text"))).alias("v")).where("v IS NOT NULL")
    loose = loose.select(F.lit(None).cast("long").alias("id"), "v.text", F.lit(None).cast("long").alias("next_id"), F.lit(None).cast("string").alias("start"))
    rows = one.join(starts, "id", "left").unionByName(loose)
    n = F.length("text")
    part = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - part), F.substring(F.coalesce("start", F.lit("")), F.lit(1), part))
    return rows.select("id", "next_id", "text", edited.alias("edited"))


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they and the next document's are."""
    prints = Fingerprinter(lexicon(docs, id_col, text_col, low, high))
    rows = edited_pairs(docs, id_col, text_col).select(
        "id", "next_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        once(F.struct(prints.components(F.col("text")).alias("text"), prints.components(F.col("edited")).alias("edited"))))
    both = store.written(rows, "fingerprints")
    other = both.select(F.col("id").alias("next_id"), F.col("text").alias("next"))
    out = both.join(other, "next_id", "left")
    return out.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", rendered("text").alias("fingerprint"), rendered("edited").alias("edited_fingerprint"),
        likeness("text", "edited").alias("near_edited"), likeness("text", "next").alias("near_next"))
