"""The ordinal fit against a plain cumulative-link likelihood, and its recall on texts without copies."""

import numpy as np
from pyspark.sql import functions as F

from quiremill.llm import ordinal_quality


def _likelihood(rows, grade, w, th):
    """Mean negative log-likelihood, written out grade by grade."""
    total = 0.0
    for feature, g in zip(rows, grade, strict=True):
        eta = sum(w[f] for f in feature)
        above = [1.0] + [1 / (1 + np.exp(t - eta)) for t in th] + [0.0]
        total -= np.log(max(above[g] - above[g + 1], 1e-12))
    return total / len(rows)


def _sample(n, features, seed):
    rng = np.random.default_rng(seed)
    truth, cuts = rng.normal(0, 1.5, features), np.array([-1.5, 1.0])
    rows = [np.flatnonzero(rng.random(features) < 0.4) for _ in range(n)]
    eta = np.array([truth[r].sum() for r in rows])
    return rows, (eta[:, None] + rng.logistic(size=n)[:, None] > cuts).sum(1)


def _descent(rows, grade, features, steps=3000, rate=0.5):
    """Plain gradient descent on the same likelihood with gradients by differences of the link, whole sample a step."""
    x = np.zeros((len(rows), features))
    for i, r in enumerate(rows):
        x[i, r] = 1
    w, th = np.zeros(features), np.array([-1.0, 1.0])
    for _ in range(steps):
        s = 1 / (1 + np.exp(-((x @ w)[:, None] - th)))
        cum = np.concatenate((np.ones((len(x), 1)), s, np.zeros((len(x), 1))), 1)
        at = np.arange(len(x))
        p = cum[at, grade] - cum[at, grade + 1]
        slope = cum * (1 - cum)
        w -= rate * x.T @ (-(slope[at, grade] - slope[at, grade + 1]) / p) / len(x)
        up, down = (grade[:, None] == np.arange(3)) * (slope[:, :-1] / p[:, None]), (grade[:, None] == np.arange(3)) * (slope[:, 1:] / p[:, None])
        th = th - rate * (up[:, 1:] - down[:, :-1]).mean(0)
    return w, th


def test_fit_reaches_the_plain_likelihood():
    rows, grade = _sample(2000, 12, 3)
    off = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    w, th = ordinal_quality.fit_ordinal(np.concatenate(rows), off, grade, 3, 4, l1=0.0)
    best = _descent(rows, grade, 12)
    fitted, plain = _likelihood(rows, grade, w, th), _likelihood(rows, grade, *best)
    assert fitted < plain + 0.02 and (np.diff(th) > 0).all()
    assert np.corrcoef(w[:12], best[0])[0, 1] > 0.99 and np.abs(th - best[1]).max() < 0.4


def test_a_step_follows_the_gradient():
    rows, grade = _sample(1, 6, 5)
    off = np.array([0, len(rows[0])])
    w, th = ordinal_quality.fit_ordinal(rows[0], off, grade, 3, 3, epochs=1, l1=0.0, rate=1e-4)
    start = ordinal_quality.fit_ordinal(rows[0], off, grade, 3, 3, epochs=0)
    for f in rows[0]:
        nudged = [start[0].copy(), start[0].copy()]
        nudged[0][f] += 1e-5
        nudged[1][f] -= 1e-5
        slope = (_likelihood(rows, grade, nudged[0], start[1]) - _likelihood(rows, grade, nudged[1], start[1])) / 2e-5
        assert np.sign(w[f]) == -np.sign(slope)


def test_scores_are_the_link(spark):
    docs = spark.createDataFrame([(1, "plain words here"), (2, "OTHER words 12"), (3, ""), (4, None)], "doc_id long, text string")
    rng = np.random.default_rng(1)
    w, th = rng.normal(0, 1, 1 << 10), np.array([-0.5, 0.75])
    got = {r.doc_id: r for r in ordinal_quality.score(docs, (w, th), tail=1).collect()}
    col = docs.orderBy("doc_id").select("text").toArrow().column(0).combine_chunks()
    f, off = ordinal_quality.features(col, 10)
    for i, (lo, hi) in enumerate(zip(off, off[1:], strict=False)):
        above = [1 / (1 + np.exp(t - w.astype(np.float32)[f[lo:hi]].astype(float).sum())) for t in th]
        assert abs(got[i + 1].expected_grade - sum(above)) < 1e-9 and abs(got[i + 1].tail_prob - above[0]) < 1e-9


def test_recall_on_texts_without_copies(spark, sf):
    """Held-out rows whose text, bar case and digits, isn't among the rows of the fit."""
    sf = sf.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    grades = ordinal_quality.grades_of(spark.read.parquet(f"{sf}/labels.parquet"))
    key = F.xxhash64(F.lower(F.regexp_replace("text", r"[\d\W]+", "")))
    ids = docs.select("doc_id", (F.pmod(key, F.lit(4)) == 0).alias("held"))
    model = ordinal_quality.fit(docs, grades.join(ids.where("not held"), "doc_id"), "grade")
    r = ordinal_quality.score(docs, model).join(grades.join(ids.where("held"), "doc_id").drop("held"), "doc_id").toPandas()
    keep = r.tail_prob >= 0.5
    toxic, good = 1 - keep[r.grade == 0].mean(), keep[r.grade == 2].mean()
    print(f"without copies: toxic found {toxic:.3f} of {(r.grade == 0).sum()}, good kept {good:.3f} of {(r.grade == 2).sum()}")
    assert good > 0.95 and toxic > 0.7
