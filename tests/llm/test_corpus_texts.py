"""BPE round trips, language ID, toxicity, line dedup, licenses, fingerprints, mixing, pages."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from auditlark.llm import bpe, htmltext, imatch, langid, licenses, linededup, mixing, queries, toxicity

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
EMPTY = "doc_id long, text string, lang string"


def test_bpe_equals_the_library_and_decodes(texts, awkward):
    rng = random.Random(3)
    odd = ["'ll I'LL don't ", " \n\n  a  b\t\t c \x1c\x1d x　 y  z", "x" * 4000 + "  " + "ab" * 2000, "<|endoftext|> " + "\n" * 300 + "!" * 500,
           "".join(chr(rng.choice([32, 10, 97, 233, 0x4E2D, 0x1F600, 48, 0x660, 39, 115, 0x2028])) for _ in range(3000))]
    rows = awkward + [(100 + i, t) for i, t in enumerate(odd)]
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})
    out = bpe.decode(bpe.encode(texts(rows), PATH, public_tokenizers.PATTERN, block_chars=5000), PATH).collect()
    expected = sorted((repr(d), encoding.encode_ordinary(t or ""), (t or "").encode()) for d, t in rows)
    assert sorted((repr(r.doc_id), bpe.unpacked(r.ids), bytes(r.decoded)) for r in out) == expected
    assert all(r.n_tokens == len(bpe.unpacked(r.ids)) for r in out)


def test_bpe_of_nothing(spark):
    assert bpe.decode(bpe.encode(spark.createDataFrame([], EMPTY), PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_long_words_merge_as_short_ones():
    ranks, rng = bpe.load_ranks(PATH), random.Random(5)
    for _ in range(200):
        word = "".join(rng.choice("abcdeinstr") for _ in range(rng.randrange(2, 40))).encode()
        assert bpe._encode_long(word, ranks) == bpe.encode_word(word, ranks) or word in ranks


def samples(rng, n):
    alphabets = {"aa": "abcde", "bb": "efghi", "cc": "äöüxyz"}
    return [(i, " ".join("".join(rng.choice(alphabets[lang]) for _ in range(5)) for _ in range(30)), lang) for i in range(n) for lang in [rng.choice(list(alphabets))]]


def test_language_id_on_held_out_texts(spark):
    rows = samples(random.Random(1), 300) + [(1000, None, "aa"), (1001, "", None), (1002, "12 !?", "bb"), (1003, "abcde " * 60_000, None)]
    df = spark.createDataFrame(rows, EMPTY).withColumn("score", F.lit("old"))
    model = langid.fit(df, F.col("doc_id") % 3 != 0, bits=12)
    found = {r.doc_id: r for r in langid.predict(df, model).collect()}
    assert all(found[i].lang_pred == lang for i, t, lang in rows[:300] if i % 3 == 0)
    assert [found[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "aa"]
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_id_learns_nothing_from_held_out_texts(spark):
    rows = samples(random.Random(4), 200)
    other = [(i, t if i % 3 else "zzz " * 50, lang if i % 3 else None) for i, t, lang in rows]
    one, two = (langid.fit(spark.createDataFrame(r, EMPTY), F.col("doc_id") % 3 != 0, bits=12) for r in (rows, other))
    assert (one.weights == two.weights).all() and (one.idf == two.idf).all() and one.temperature == two.temperature


def test_language_id_chunks_do_not_change_counts(monkeypatch):
    text = "Zwei Wörter, then Some more of them. " * 20
    whole = [x.tolist() for x in langid.ngram_counts(text, 12)]
    monkeypatch.setattr(langid, "CHUNK", 37)
    assert [x.tolist() for x in langid.ngram_counts(text, 12)] == whole


def test_language_id_without_labels(spark):
    empty = spark.createDataFrame([], EMPTY)
    assert langid.predict(empty, langid.fit(empty, F.lit(True), bits=8)).count() == 0
    some = spark.createDataFrame([(1, "text", None)], EMPTY)
    assert langid.predict(some, langid.fit(some, F.lit(True), bits=8)).first().lang_pred == "und"


def test_toxicity_finds_documents_and_sentences(spark, awkward):
    rng = random.Random(8)
    plain = ["house", "river", "green", "walks", "table", "stone", "bread", "light", "seven", "music"]
    bad = ["zorgle", "snarfed", "vilebit"]
    rows, labels, marked = [], [], {}
    for i in range(500):
        parts = [" ".join(rng.choice(plain) + rng.choice(["", "s", "ed"]) for _ in range(8)) for _ in range(rng.randrange(1, 12))]
        toxic = i % 4 == 0
        if toxic:
            k = rng.randrange(len(parts))
            parts[k] += " " + rng.choice(bad) + " " + rng.choice(plain)
            marked[i] = k
        rows.append((i, ". ".join(parts) + "."))
        labels.append((i, int(toxic)))
    labels += [(0, 0), (None, 1), (3, None), (9999, 1)]
    docs = spark.createDataFrame(rows + [(1000 + (d or 0), t) for d, t in awkward], "doc_id long, text string").withColumn("offending", F.lit("old"))
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, known.where("doc_id % 5 != 0 OR doc_id IS NULL"))
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(0, 500, 5)]
    assert sum((found[i].score >= 0.5) == (i % 4 == 0) for i in held) >= 0.95 * len(held)
    for i in (i for i in held if i % 4 == 0 and found[i].score >= 0.5):
        text = rows[i][1]
        assert any(any(b in text[s.start:s.end] for b in bad) for s in found[i].offending)
    assert all(found[1000 + (d or 0)].score == 0 for d, t in awkward if not (t or "").strip())
    nothing = toxicity.fit(docs, known.limit(0))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}


def test_line_dedup_removes_repeated_chunks_only(texts, awkward):
    rng = random.Random(6)
    lines = [f"line {i} of words" for i in range(400)]
    shared = "\n".join(rng.sample(lines, 40))
    rows = awkward + [(100, "\n".join(lines[:20]) + "\n" + shared + "\nend"), (101, "start\n" + shared + "\n" + "\n".join(lines[50:70])), (102, shared), (102, shared), (103, "one"), (104, "one")]
    df = texts(rows)
    found = linededup.dedupe(df)
    assert set(df.columns) | {"n_lines", "n_removed"} == set(found.columns)
    got = {}
    for r in found.collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sorted(map(repr, (r.doc_id for x in got.values() for r in x))) == sorted(repr(d) for d, _ in rows)
    kept = {d: r[0].text for d, r in got.items()}
    for d, t in rows:
        if d not in (100, 101, 102):
            assert kept[d] == t
    assert kept[100] == rows[len(awkward)][1]
    assert 20 < got[101][0].n_removed <= 40 and len(kept[101].split("\n")) + got[101][0].n_removed == got[101][0].n_lines
    assert len({r.text for r in got[102]}) == 1


@pytest.mark.parametrize("size", [2, 3, 4, 5, 6])
def test_line_dedup_removes_whole_passages(texts, size):
    rng = random.Random(size)
    rows, fresh = [], iter(range(10_000))
    for i in range(20):  # each passage stands in two otherwise different documents, the second time with blank lines around it
        passage = [f"shared {next(fresh)} {rng.random()}" for _ in range(size)]
        passage = passage[:1] + [""] * (i % 3) + passage[1:]
        for d in (i, 100 + i):
            own = [[f"own {next(fresh)}" for _ in range(rng.randrange(1, 5))] for _ in range(2)]
            rows.append((d, "\n".join(own[0] + passage + own[1])))
    rows += [(200, "once only\nmenu\nelse"), (201, "menu\nother"), (202, "a b\na b")]
    found = {r.doc_id: r for r in linededup.dedupe(texts(rows)).collect()}
    for d, t in rows:
        expected = [x for x in t.split("\n") if not x.startswith("shared") and x] if 100 <= d < 200 else t.split("\n")
        assert found[d].text.split("\n") == expected and found[d].n_removed == len(t.split("\n")) - len(expected)


def brute_dedupe(texts):
    """Texts by id without the repeated windows of two lines, as the docstring says."""
    def spans(lines):
        wordy = [i for i, x in enumerate(lines) if any(c.isalnum() for c in x)]
        if len(wordy) < 2:
            return []
        found = list(zip(wordy, wordy[1:]))
        return found + [(0, wordy[1])] * (wordy[0] > 0) + [(wordy[-2], len(lines) - 1)] * (wordy[-1] < len(lines) - 1)

    lines = {d: t.split("\n") for d, t in texts.items()}
    places = {}
    for d in sorted(lines):
        for s, e in spans(lines[d]):
            places.setdefault("\n".join(lines[d][s:e + 1]), []).append((d, s, e))
    gone, stay = set(), set()
    for where in places.values():
        if len(where) > 1:
            first, *others = sorted(where)
            stay |= {(first[0], i) for i in range(first[1], first[2] + 1)}
            gone |= {(d, i) for d, s, e in others for i in range(s, e + 1)}
    return {d: "\n".join(x for i, x in enumerate(own) if (d, i) not in gone - stay) for d, own in lines.items()}


def test_a_kept_passage_is_not_eaten_by_another(spark):
    docs = spark.createDataFrame([(1, "A\nB\nX"), (2, "A\nB\nC\nY"), (3, "B\nC\nD")], "doc_id long, text string")
    kept = {r.doc_id: r.text for r in linededup.dedupe(docs).collect()}
    assert kept == {1: "A\nB\nX", 2: "B\nC\nY", 3: "D"}  # B C still stands in the second


def test_line_dedup_equals_brute_force(spark, tmp_path):
    rng = random.Random(21)
    rows = {i: "\n".join(rng.choice(["", "--", "a", "b b", "c", "d", "e e", "f", "g", "h"]) for _ in range(rng.randrange(1, 25))) for i in range(150)}
    rows |= {200 + i: rows[rng.randrange(150)] for i in range(20)}
    df = spark.createDataFrame([*((i, t, "en", "s", 1) for i, t in rows.items()), (900, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    expected = brute_dedupe(rows)
    assert {r.doc_id: r.text for r in linededup.dedupe(df).collect() if r.doc_id != 900} == expected
    df.write.parquet(f"{tmp_path}/documents.parquet")
    import hashlib
    found = {r.doc_id: r.text_sha256 for r in queries.op7_line_dedup(spark, str(tmp_path)).collect()}
    assert found == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in (expected | {900: ""}).items()}
    assert linededup.dedupe(df.limit(0)).count() == 0


def test_license_scan(texts, awkward):
    rows = awkward + [(20, "GNU General\nPublic License, and MIT License mit license"), (21, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"),
                      (22, "cc by cc by"), (23, "Released under the MIT-License\nAll rights reserved"), (24, "reserved all wrong rights")]
    found = {r.doc_id: r for r in licenses.scan(texts(rows)).collect()}
    assert (found[20].n_base, found[20].first_word, found[20].last_word, found[20].base_labels) == (3, 0, 7, "gpl,mit")
    assert (found[21].n_base, found[21].labels) == (0, "mit-text") and 0.9 <= found[21].score < 1
    assert (found[22].n_base, found[22].last_word, found[22].labels, found[22].score) == (2, 2, "cc-by", 1.0)
    assert found[23].labels == "all-rights-reserved,mit,mit-notice" and found[24].labels == "all-rights-reserved"
    assert all(found[i].n_words == n and found[i].labels == "" and found[i].score == 0 for i, n in ((1, 0), (2, 0), (3, 0), (4, 1), (7, 0), (8, 2)))


def test_license_join_equals_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(30)]
    templates = [(f"t{i}", " ".join(rng.sample(vocabulary, rng.randrange(1, 12)))) for i in range(8)]
    blocks = [(i, rng.choices(vocabulary + ["other", ""], k=rng.randrange(0, 25))) for i in range(300)]
    found = licenses.matches(spark.createDataFrame(blocks, "id long, words array<string>"), templates, "0.7", ["id"]).collect()
    expected = {(i, label): len(set(w) & set(t.split())) / len(set(t.split())) for i, w in blocks for label, t in templates if 10 * len(set(w) & set(t.split())) >= 7 * len(set(t.split()))}
    assert {(r.id, r.label): r.containment for r in found} == expected and len(found) == len(expected)


def test_fingerprints(spark, texts, awkward):
    rng = random.Random(2)
    rows = awkward + [(100 + i, " ".join(rng.choice("abcdefgh") + rng.choice("ijklmnop") + str(rng.randrange(4)) for _ in range(200))) for i in range(60)]
    rows += [(300, rows[-1][1]), (301, "word")]
    found = {r.doc_id: r for r in imatch.compare_edits(texts(rows), low=0.02, high=0.9).collect()}
    order = sorted({d for d, _ in rows if d is not None})
    text = {d: t or "" for d, t in rows}
    import hashlib
    for d, after in zip(order, order[1:] + order[:1]):
        t, n = text[d], len(text[d])
        edited = t[:n - n // 4] + text[after][:n // 4]
        assert (found[d].n_chars, found[d].edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= found[d].near_edited <= 1 and 0 <= found[d].near_next <= 1
    assert found[300].fingerprint == found[159].fingerprint and found[4].fingerprint == found[301].fingerprint
    assert sum(found[100 + i].near_edited >= found[100 + i].near_next for i in range(60)) > 50
    assert imatch.compare_edits(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_fingerprints_of_a_large_group_and_of_few_rows(texts):
    rng = random.Random(4)

    def sample():
        return [f"{rng.choice('abcdefgh')}{rng.randrange(150)}" for _ in range(120)]

    base = [f"base{i}" for i in range(120)]
    rows = [(i, " ".join(base[:k] + [f"new{i}"] + base[k + 1:])) for i in range(20) for k in [rng.randrange(120)]] + [(100 + i, " ".join(sample())) for i in range(40)]
    found = {r.doc_id: r for r in imatch.compare_edits(texts(rows)).collect()}
    nexts, edits = ([getattr(found[i], x) for i in range(19)] for x in ("near_next", "near_edited"))
    assert np.mean(nexts) > 0.5 and min(nexts) > 0 and np.mean(edits) > 0.2 and min(edits) > 0, (nexts, edits)
    few = {r.doc_id: r for r in imatch.compare_edits(texts([(i, " ".join(f"w{i}x{j}" for j in range(100))) for i in range(5)])).collect()}
    assert all(r.near_next < r.near_edited for r in few.values()), few


def test_copies_do_not_change_the_lexicon(texts):
    rows = [(i, " ".join(f"w{(i * j) % 53}" for j in range(1, 9))) for i in range(40)]
    one, more = (sorted(r.term for r in imatch.lexicon(texts(x), low=0.0, high=0.4).collect()) for x in (rows, rows + [(100 + i, rows[3][1]) for i in range(40)]))
    assert one == more and one


def brute_prints(texts, low, high, of=None):
    """Fingerprints by plain Python: terms sorted, joined and hashed per subset; the lexicon is that of ``texts``."""
    import hashlib

    def number(text, digits):
        return int(hashlib.md5(text.encode()).hexdigest()[:digits], 16)

    def said(text):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        return re.sub(imatch.NO_WORD, " ", lowered).strip(" ")

    distinct = {said(t) for t in texts}
    counts = Counter(w for t in distinct for w in set(t.split(" ")) - {""})
    band = {w for w, n in counts.items() if n > 1 and low * len(distinct) <= n <= high * len(distinct)}
    out = {}
    for text in texts if of is None else of:
        terms = sorted(set(said(text).split(" ")) - {""}, key=lambda w: w.encode())
        fold = lambda chosen: str(number(" ".join(chosen), 15)) if chosen else ""
        lexical = [fold([w for w in terms if w in band and number(f"{w}#{r}", 8) % d == 0]) for d in imatch.DENSITIES for r in range(imatch.REPEATS)]
        draw = {w: hashlib.md5(w.encode()).hexdigest() for w in terms}
        every = [fold([w for w in terms if int(draw[w][k:k + 2], 16) % d == 0]) for k, d in enumerate(d for d in imatch.DENSITIES for _ in range(imatch.REPEATS))]
        out[text] = (lexical, [] if any(lexical) else every, hashlib.md5(said(text).encode()).hexdigest())
    return out


def likeness(a, b):
    if any(a[0]) != any(b[0]):
        return float(a[2] == b[2])
    kind = 0 if any(a[0]) else 1
    either = [(x, y) for x, y in zip(a[kind], b[kind]) if x or y]
    return sum(x == y for x, y in either) / len(either) if either else float(a[2] == b[2])


def test_fingerprints_equal_brute_force(texts, awkward):
    rng = random.Random(11)
    rows = [r for r in awkward if r[0] is not None]
    rows += [(100 + i, " ".join(rng.choice(["Ab", "cd", "éf", "g-h"]) + str(min(rng.randrange(400), rng.randrange(400))) for _ in range(rng.choice([2, 30, 300])))) for i in range(80)]
    rows += [(300 + i, rows[-1][1]) for i in range(20)]  # copies
    low, high = 0.03, 0.3
    found = {r.doc_id: r for r in imatch.compare_edits(texts(rows), low=low, high=high).collect()}
    text = {d: t or "" for d, t in rows}
    order = sorted(text)
    follows = dict(zip(order, order[1:] + order[:1]))
    edited = {d: t[:len(t) - len(t) // 4] + text[follows[d]][:len(t) // 4] for d, t in text.items()}
    counted = [t or "" for _, t in rows]
    of_texts = brute_prints(counted, low, high)
    show = lambda p: ".".join(p[0]) + "|" + ".".join(p[1]) + "|" + p[2]
    for d in order:
        changed = brute_prints(counted, low, high, [edited[d]])[edited[d]]
        assert found[d].fingerprint == show(of_texts[text[d]]) and found[d].edited_fingerprint == show(changed)
        assert found[d].near_edited == pytest.approx(likeness(of_texts[text[d]], changed))
        assert found[d].near_next == pytest.approx(likeness(of_texts[text[d]], of_texts[text[follows[d]]]))


def test_no_query_of_fingerprints_differs_from_its_parts(spark, tmp_path):
    rows = [(i, " ".join(f"w{(i * j) % 37}" for j in range(1, 30)), "en", "s", 1) for i in range(30)] + [(40, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op9_imatch(spark, str(tmp_path)).collect()
    prints = brute_prints([r[1] or "" for r in rows], imatch.LOW, imatch.HIGH)
    assert {r.doc_id: r.fingerprint for r in found} == {r[0]: ".".join(p[0]) + "|" + ".".join(p[1]) + "|" + p[2] for r in rows for p in [prints[r[1] or ""]]}


def least_miss(tokens, p, goal):
    """Smallest distance from the targets that nonnegative rates reach: accelerated projected gradient, thousands of steps."""
    share = tokens / tokens.sum()
    top = np.linalg.eigvalsh((p * share[:, None]).T @ p)[-1]
    rate = ahead = np.ones(len(tokens))
    s = 1.0
    for _ in range(5000):
        new = np.maximum(0, ahead - p @ (p.T @ (share * ahead) - goal) / top)
        nxt = (1 + np.sqrt(1 + 4 * s * s)) / 2
        rate, ahead, s = new, new + (s - 1) / nxt * (new - rate), nxt
    return np.linalg.norm(p.T @ (share * rate) - goal)


def check_fit(docs, labels, targets):
    cells, domains, languages = mixing.fit(docs, labels, targets)
    found = cells.collect()
    counted = mixing.statistics(docs, "text", "lang", languages).groupBy(*mixing.FEATURES).sum("n_tokens").collect()
    counted = {tuple(r[f] for f in mixing.FEATURES): r["sum(n_tokens)"] for r in counted}
    tokens, p, rate = np.array([counted[tuple(r[f] for f in mixing.FEATURES)] for r in found], float), np.array([r.p for r in found]), np.array([r.rate for r in found])
    goal = np.array([targets[d] for d in domains])
    goal = goal / goal.sum()
    miss = p.T @ (tokens / tokens.sum() * rate) - goal
    assert rate.min() >= 0 and np.linalg.norm(miss) <= least_miss(tokens, p, goal) + 1e-3
    return rate, dict(zip(domains, miss)), languages


def test_mixing_meets_targets(spark):
    rng = random.Random(12)
    rows = [(i, ("WORD WORD " if i % 3 == 0 else "plain words, ") * rng.randrange(5, 60), "en" if i % 2 else "de") for i in range(600)]
    docs = spark.createDataFrame(rows + [(700, None, None), (701, "", "fr"), (None, "text", "en")], EMPTY).withColumn("rate", F.lit("old"))
    labels = [(i, ("en" if i % 2 else "de") + ("/shout" if i % 3 == 0 else "/plain")) for i in range(600) if i % 5]
    labels = spark.createDataFrame(labels + [(None, "x"), (5, None), (9999, "de/plain")], "doc_id long, domain string")
    targets = {"en/plain": 0.5, "de/plain": 0.3, "de/shout": 0.1, "en/shout": 0.1, "none": 0.5}
    mixed = mixing.mix(docs, labels, targets).collect()
    assert len(mixed) == 603 and all(r.rate >= 0 and r.copies >= 0 for r in mixed)
    total = sum(r.n_tokens for r in mixed)
    lang = {i: x for i, _, x in rows}
    assert sum(r.n_tokens * r.rate for r in mixed if lang.get(r.doc_id) == "de") / total == pytest.approx(0.4, abs=0.05)
    check_fit(docs, labels, targets)
    kept = mixing.mix(docs, labels, targets, keep_all=True, at_least=1)
    assert {r.doc_id for r in mixing.expand(kept, ["doc_id"]).collect()} == {d for d, *_ in docs.collect()}


def test_mixing_with_clipped_rates_and_many_languages(spark):
    rng = random.Random(31)
    rows = [(i, rng.choice(["LOUD WORDS ", "plain words, ", "{a} [b] ", "averylongword "]) * min(900, int(rng.paretovariate(0.8)) + 1), f"l{i % 25}") for i in range(1500)]
    docs = spark.createDataFrame(rows + [(5000, "of a language without label " * 9, "zz")], EMPTY)
    labels = spark.createDataFrame([(i, f"l{i % 25}") for i in range(0, 1500, 2)], "doc_id long, domain string")
    rate, miss, languages = check_fit(docs, labels, {f"l{i}": 0.5 if i == 0 else 0.5 / 24 for i in range(25)})
    assert len(languages) == 25 and max(map(abs, miss.values())) < 0.001  # none lumped together with others
    some = {"LOUD WORDS ": "a", "plain words, ": "b", "{a} [b] ": "c", "averylongword ": "d"}
    labels = spark.createDataFrame([(i, some[next(k for k in some if x.startswith(k))] if rng.random() < 0.9 else "b") for i, x, _ in rows], "doc_id long, domain string")
    rate, miss, _ = check_fit(docs, labels, {"a": 0.9, "b": 0.02, "c": 0.04, "d": 0.04})
    assert (rate == 0).any()


def test_mixing_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "en")], EMPTY)
    none = spark.createDataFrame([], "doc_id long, domain string")
    assert [(r.rate, r.copies) for r in mixing.mix(docs, none, {"en/1": 1.0}).collect()] == [(1.0, 1)]
    assert mixing.mix(docs.limit(0), none, {}).count() == 0


PAGE = """<html><head><title>t</title><script>var t="</p>";</script></head><body><header>Site</header><nav><ul><li><a href=x>Home</a><li>More</ul></nav>
<div class="ad">Buy &amp; save</div><{0}><h1>Head &lt;1&gt;</h1><p>One  <b>bold</b>
 text&nbsp;here.<p>Two<br>lines, of text.</p><div id="comments"><p>I disagree, as a reader.</p></div></{0}><aside>Side</aside><footer>&copy; x"""


def test_pages(spark):
    rows = [(i, "u", PAGE.format("article") if i % 2 else PAGE.format("main")) for i in range(40)]
    rows += [(50, None, None), (51, "u", ""), (52, "u", "<p>"), (53, "u", "<" * 50), (54, "u", "<div>" * 3000 + "deep"), (55, "u", PAGE.format("article").replace("Two", "Two " * 50_000)), (56, "u", "</p></b>&am")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("old"))
    model = htmltext.fit(pages)
    found = {r.page_id: r for r in htmltext.extract(pages, model).collect()}
    expected = "Head <1>\nOne bold text here.\nTwo lines, of text."
    assert {found[i].text for i in range(40)} == {expected}
    assert [found[i].text for i in (50, 51, 52)] == ["", "", ""] and found[0].n_chars == len(expected)
    assert found[55].n_chars == len(expected) - 4 + 4 * 50_000 and htmltext.extract(pages.limit(0), htmltext.fit(pages.limit(0))).count() == 0


def test_marginals_equal_enumeration():
    import itertools
    import math

    page = htmltext.Page("<div><p>a, b.</p><nav>c</nav><div class=ad>d<b>e</b></div></div>")
    model = htmltext.Model({"tag=p": 1.3, "bias": -0.4, "tag=div": 0.2, "links=0": 0.1}, (1.5, 0.4, 0.3, 2.0))
    unary, n = model.unary(page), len(page.tags)
    mass = np.zeros((n, 2))
    for states in itertools.product((0, 1), repeat=n):
        weight = math.exp(sum(u * s for u, s in zip(unary, states)))
        for at in range(1, n):
            weight *= model.pair[2 * states[page.parents[at]] + states[at]]
        for at, s in enumerate(states):
            mass[at, s] += weight
    assert model.marginals(page) == pytest.approx(np.log(mass[:, 1] / mass[:, 0]).tolist())
