"""Columns that clash but for case, long texts in pieces, and the ordinal fit against a plain one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quiremill.llm import decontaminate, embedding_dedup, embedding_whitening, jaccard_join, language_id, line_dedup, ordinal_quality, sampled_pieces, source_divergence, substring_dedup, token_shards, url_filter, warc
from quiremill.llm.common import new_folder


def test_added_columns_replace_those_of_any_case(spark):
    docs = spark.createDataFrame([(1, "one two three", "en", "x")], "doc_id long, text string, lang string, K string")
    clash = lambda *names: docs.select("*", *[F.lit("old").alias(n) for n in names])
    made = {
        "op1": line_dedup.line_dedup(clash("N_lines", "T")),
        "op2": language_id.identify(clash("Score", "LANG_PRED"), per_lang=10),
        "op7": decontaminate.decontaminate(clash("Items"), spark.createDataFrame([(1, "a b")], "item_id long, text string")),
        "op9": ordinal_quality.score(clash("Tail_Prob"), None),
        "op10": sampled_pieces.encode_samples(clash("SAMPLES", "k_own", "t")),
        "op5": url_filter.url_verdicts(clash("Verdict").select("*", F.lit("http://a.org/").alias("url"), F.lit(None).cast("string").alias("html")), url_filter.RULES),
    }
    for name, df in made.items():
        assert len({c.lower() for c in df.columns}) == len(df.columns), name
        (row,) = df.collect()
        assert row["K"] == "x" and "old" not in [v for c, v in row.asDict().items() if c not in ("T", "t", "k_own")], name


@pytest.mark.parametrize("name", ["x.y", "Odd` one", "row.text"])
def test_odd_names_of_further_columns_are_kept(spark, name):
    docs = spark.createDataFrame([(1, "one two three", "en")], "doc_id long, text string, lang string").withColumn(name, F.lit("old"))
    made = {
        "op1": line_dedup.line_dedup(docs),
        "op2": language_id.identify(docs, per_lang=10),
        "op7": decontaminate.decontaminate(docs, spark.createDataFrame([(1, "a b")], "item_id long, text string")),
        "op9": ordinal_quality.score(docs, (np.zeros(1 << 10), np.zeros(2))),
        "op9 without a model": ordinal_quality.score(docs, None),
        "op10": sampled_pieces.encode_samples(docs),
        "op5": url_filter.url_verdicts(docs.select("*", F.lit("http://a.org/").alias("url"), F.lit(None).cast("string").alias("html")), url_filter.RULES),
    }
    for op, df in made.items():
        assert name in df.columns, op
        (row,) = df.collect()
        assert row[name] == "old", op


def test_odd_names_are_not_read_by_those_that_return_their_own(spark):
    name = "x.y"
    docs = spark.createDataFrame([(1, "one two three", "en")], "doc_id long, text string, lang string").withColumn(name, F.lit("old"))
    assert substring_dedup.substring_dedup(docs).count() == token_shards_rows(spark, docs) == 1
    assert source_divergence.source_divergence(docs.withColumn("source", F.lit("s"))).count() == 0
    assert jaccard_join.jaccard_components(docs, 5, 80).count() == 1
    vectors = spark.createDataFrame([(1, [1.0, 2.0], 1)], "vec_id long, embedding array<double>, label int").withColumn(name, F.lit("old"))
    assert embedding_dedup.embedding_links(vectors, 2).count() == embedding_whitening.whiten(vectors).count() == 1
    pages = spark.createDataFrame([(1, "http://a.org/", "x")], "page_id long, url string, html string").withColumn(name, F.lit("old"))
    assert warc.write_warc(pages, new_folder(spark, "warc")).count() >= 1


def token_shards_rows(spark, docs):
    return token_shards.write_shards(docs, new_folder(spark, "shards"), key=1, seq_len=16).count()


@pytest.mark.parametrize("languages", [1, 3])
def test_sums_in_pieces(monkeypatch, languages):
    monkeypatch.setattr(language_id, "PIECE", 1024 * languages)
    rng = np.random.default_rng(2)
    m = rng.standard_normal((64, languages)).astype(np.float32)
    size = np.array([0, 5, 3000, 0, 256, 257, 255, 1, 0, 700, 0])
    off = np.concatenate(([0], np.cumsum(size)))
    grams = rng.integers(0, 64, off[-1])
    want = np.array([m[grams[a:b]].astype(np.float64).sum(0) for a, b in zip(off[:-1], off[1:], strict=True)])
    got = language_id._sums(m, grams, off)
    assert np.allclose(got, want)
    alone = np.concatenate([language_id._sums(m, grams[a:b], np.array([0, b - a])) for a, b in zip(off[:-1], off[1:], strict=True)])
    assert (got == alone).all()


def likelihood(x, off, grade, w, th):
    """Mean negative log-likelihood, one row after another."""
    total = 0.0
    for i, g in enumerate(grade):
        above = [1.0, *(1 / (1 + np.exp(th - w[x[off[i] : off[i + 1]]].sum()))), 0.0]
        total -= np.log(above[g] - above[g + 1])
    return total / len(grade)


def test_ordinal_fit_against_plain_descent():
    """The likelihood reached is that of plain gradient descent with numeric slopes, and so are the thresholds."""
    rng = np.random.default_rng(4)
    true = np.array([2.0, -1.5, 0.5, 0.0, 1.0, -0.5])
    rows = [np.flatnonzero(rng.random(6) < 0.5) for _ in range(400)]
    eta = np.array([true[r].sum() for r in rows]) + rng.logistic(size=400)
    grade = (eta > -0.5).astype(int) + (eta > 1.0)
    x, off = np.concatenate(rows), np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    w, th = ordinal_quality.fit_ordinal(x, off, grade, 3, 3, epochs=600, batch=100, l1=0.0, rate=0.3)
    assert th[0] < th[1]

    p = np.zeros(8)
    p[6:] = [-0.1, 0.1]
    for _ in range(250):
        slope = np.zeros(8)
        for j in range(8):
            step = np.zeros(8)
            step[j] = 1e-5
            at = lambda q: likelihood_fast(rows, grade, q)
            slope[j] = (at(p + step) - at(p - step)) / 2e-5
        p -= 2.0 * slope
    best = likelihood(x, off, grade, p[:6], p[6:])
    assert likelihood(x, off, grade, w[:6], th) < best + 0.002
    assert np.abs(w[:6] - p[:6]).max() < 0.1 and np.abs(th - p[6:]).max() < 0.1


def likelihood_fast(rows, grade, p):
    eta = np.array([p[r].sum() for r in rows])
    above = np.stack([np.ones(len(rows)), 1 / (1 + np.exp(p[6] - eta)), 1 / (1 + np.exp(p[7] - eta)), np.zeros(len(rows))], 1)
    return -np.log(np.maximum(above[np.arange(len(rows)), grade] - above[np.arange(len(rows)), grade + 1], 1e-12)).mean()
