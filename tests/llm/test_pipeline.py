"""Stages of the pipeline against one another."""

import random

import corpus_pipeline


def test_copies_of_documents_leave_no_scraps(spark):
    rng = random.Random(3)
    texts = ["\n".join(rng.choice(["", "---", " ".join(rng.choice("abcdefgh") + str(rng.randrange(90)) for _ in range(rng.randrange(1, 20)))])
                       for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    texts = [t for t in dict.fromkeys(texts) if any(c.isalnum() for c in t)]
    rows = [(i, t, len(t)) for i, t in enumerate(texts)] + [(1000 + i, t, len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    alone = corpus_pipeline.line_dedup(spark, docs, "").collect()
    assert {r.doc_id: r.text for r in alone if r.doc_id < 1000} == dict(enumerate(texts))
    assert all(r.text == texts[r.doc_id - 1000] and r.n_chars == len(r.text) for r in alone if r.doc_id >= 1000)
    kept = corpus_pipeline.ngram_jaccard(spark, spark.createDataFrame(alone), "").collect()
    assert {r.doc_id for r in kept} <= set(range(len(texts)))
