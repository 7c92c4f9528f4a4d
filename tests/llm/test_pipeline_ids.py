"""The pipeline's Jaccard stage where ids are repeated, null or negative."""

import corpus_pipeline


def test_jaccard_stage_with_repeated_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a, "en", "s", 1), (1, a, "de", "r", 1), (1, b, "en", "s", 1), (2, a + " z", "en", "s", 1), (3, b, "en", "s", 1), (-4, c, "en", "s", 1), (5, c, "en", "s", 1), (None, a, "en", "s", 1), (6, None, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.jaccard(spark, docs, "")
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text, r.lang) for r in got.collect()), key=str)
    assert kept == sorted([(1, a, "de"), (1, b, "en"), (-4, c, "en"), (None, a, "en"), (6, None, "en")], key=str)
