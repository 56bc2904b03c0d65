"""Line dedup by repeated passages of lines.

A passage is a run of ``min_lines`` or more lines with a letter or digit, with whatever lines stand between them. Every ``min_lines``
neighbouring such lines are one window, so a passage, wherever it begins and ends, is the union of its windows. A window that stands anywhere
else too keeps its first place (smallest id, then position) and is removed at the others, once its bytes have been compared with those of
the first place. As windows overlap, this removes whole repeated runs. The lines of a first place stay, also where another window would take them, so every
repeated window still stands somewhere.
Lines without a letter or digit before the first and after the last window of a text have windows of their own, so a whole copy is emptied.

Only hashes are grouped over the corpus, with partial counts, so a window that a third of all documents hold costs one row per task.
Texts move twice, to meet the decisions made about their own windows.

A null text stays null, texts with fewer than ``min_lines`` lines with a letter or digit stay as they are. A row repeated wholly is the same
place, so all its copies keep the same text; rows without id come first in the order. Other columns pass through.

Chunks between boundaries that rolling hashes of the line hashes choose were tried first. A passage then goes only where a whole chunk lies in it: most repeated
passages lost nothing, so every line is a boundary here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlark.functions.text import let
from auditlark.llm import store


def windows(text: Column, min_lines: int) -> Column:
    """The windows of a text: first line ``s``, last line ``e`` and the hash ``key`` of the lines between."""
    def placed(lines: Column) -> Column:
        last = F.size(lines) - 1

        def spans(wordy: Column) -> Column:
            m = F.size(wordy)
            begin, end = F.get(wordy, F.lit(0)), F.get(wordy, m - 1)
            inner = F.transform(F.sequence(F.lit(0), m - min_lines), lambda k: F.struct(F.get(wordy, k).alias("s"), F.get(wordy, k + min_lines - 1).alias("e")))
            head = F.when(begin > 0, F.array(F.struct(F.lit(0).alias("s"), F.get(wordy, F.lit(min_lines - 1)).alias("e")))).otherwise(F.array())
            tail = F.when(end < last, F.array(F.struct(F.get(wordy, m - min_lines).alias("s"), last.alias("e")))).otherwise(F.array())
            return F.when(m >= min_lines, F.concat(inner, head, tail))

        wordy = F.filter(F.sequence(F.lit(0), last), lambda i: F.get(lines, i).rlike(r"[\p{L}\p{N}]"))
        return F.transform(let(wordy, spans), lambda w: F.struct(w["s"].alias("s"), w["e"].alias("e"), F.xxhash64(_joined(lines, w["s"], w["e"])).alias("key")))

    return let(F.split(text, "\n"), placed)


def _joined(lines: Column, s: Column, e: Column) -> Column:
    return F.array_join(F.slice(lines, s + 1, e - s + 1), "\n")


def dedupe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 2) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text_col``, and the columns ``n_lines`` and ``n_removed`` (lines before, lines taken out)."""
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    text = F.col(f"`{text_col}`").cast("string")
    keyed = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    places = keyed.select("id", "mark", F.explode(windows(F.col("text"), min_lines)).alias("w")).select("id", "mark", "w.*")
    places = store.written(places, "window_places")

    place = F.struct("id", "s", "e", "mark")
    repeated = places.groupBy("key").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").select("key", "first")
    repeated = store.written(repeated, "repeated_windows")
    marked = places.join(repeated, "key").select("id", "mark", "s", "e", "key", place.eqNullSafe(F.col("first")).alias("first"))
    by_text = marked.groupBy("id", "mark").agg(F.collect_set(F.struct("s", "e", "key", "first")).alias("marked"))  # as many as the text has lines

    def same(a: DataFrame, b: DataFrame):
        return a["id"].eqNullSafe(b["id"]) & (a["mark"] == b["mark"])

    held = keyed.join(by_text, same(keyed, by_text)).select(keyed["id"], keyed["mark"], F.split("text", "\n").alias("lines"), "marked")
    cut = F.transform("marked", lambda w: F.struct(w["s"].alias("s"), w["e"].alias("e"), w["key"].alias("key"), w["first"].alias("first"),
                                                   _joined(F.col("lines"), w["s"], w["e"]).alias("passage")))
    held = store.written(held.select("id", "mark", F.explode(cut).alias("w")).select("id", "mark", "w.*"), "repeated_texts")
    kept = held.where("first").groupBy("key").agg(F.first("passage").alias("kept"))
    gone = held.where("NOT first").join(kept, "key").where("passage = kept").select("id", "mark", "s", "e", F.lit(False).alias("first"))
    firsts = held.where("first").select("id", "mark", "s", "e", "first")
    spans = lambda first: F.collect_set(F.when(F.col("first") == first, F.struct("s", "e")))
    gone = gone.unionByName(firsts).groupBy("id", "mark").agg(spans(False).alias("gone"), spans(True).alias("stay")).where(F.size("gone") > 0)
    gone = gone.select(F.col("id").alias("__gone_id"), F.col("mark").alias("__gone_mark"), F.col("gone").alias("__gone"), F.col("stay").alias("__stay"))

    rows = docs.select(*(F.col(f"`{c}`") for c in others), F.col(f"`{id_col}`").cast("long").alias("__id"), F.xxhash64(text).alias("__mark"))
    rows = rows.join(gone, F.col("__id").eqNullSafe(F.col("__gone_id")) & (F.col("__mark") == F.col("__gone_mark")), "left")
    n_lines = F.when(text.isNull(), 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)

    def left(lines: Column) -> Column:
        covered = lambda spans: F.flatten(F.transform(spans, lambda w: F.sequence(w["s"], w["e"])))
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.array_except(covered("__gone"), covered("__stay")))
        return let(stay, lambda x: F.struct(F.array_join(F.transform(x, lambda i: F.get(lines, i)), "\n").alias("text"), F.size(x).alias("n")))

    rows = rows.withColumn("__left", F.when(F.col("__gone").isNotNull(), let(F.split(text, "\n"), left)))
    return rows.select(
        *(F.coalesce(F.col("__left.text"), text).alias(c) if c == text_col else F.col(f"`{c}`") for c in others),
        n_lines.cast("long").alias("n_lines"), F.when(F.col("__gone").isNotNull(), n_lines - F.col("__left.n")).otherwise(0).cast("long").alias("n_removed"))
