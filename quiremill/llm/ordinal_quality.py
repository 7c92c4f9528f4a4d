"""Quality classifier: ordinal cumulative-link (proportional-odds) regression on graded ratings.

One weight per hashed feature is shared by all grades, ordered thresholds part them:
``P(grade > k) = sigmoid(w.x - threshold_k)``.  Features are the distinct words of the whole text, their
beginnings of two to five bytes (words of one kind begin alike, so that a word counts that wasn't in the sample),
and a few shape features (share of capitals, repeats, symbols and digits, in steps), hashed.
The fit is proximal AdaGrad with an L1 penalty on a bounded sample of labelled documents;
scoring is one pass over all whole texts with the weights broadcast (4 MB).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.llm.common import ddl, numbered, others, split_hint, table
from quiremill.llm.texthash import U, column_bytes, mix, prefixes, slices, words

#: Steps of the shape features.
_STEPS = np.array([0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9])
#: Bytes of a word's beginning.
BEGINNINGS = (2, 3, 4, 5)


def features(col: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each text, one text after another, and offsets."""
    data, off = column_bytes(col)
    n = len(col)
    h, row = words(data, off)
    # punctuation at a word's ends keeps words apart; letters alone bring them together again
    plain = data.copy()
    plain[(data < 48) | ((data > 57) & (data < 65)) | ((data > 90) & (data < 97)) | ((data > 122) & (data < 128))] = 32
    h2, row2 = words(plain, off)
    count = np.bincount(row, minlength=n)
    length = np.maximum(np.diff(off), 1)
    run = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[off])
    order = np.lexsort((h, row))
    same = np.concatenate(([False], (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1]))) if len(h) else np.empty(0, bool)
    repeats = np.bincount(row[order][same], minlength=n) / np.maximum(count, 1)
    shapes = [run((data > 64) & (data < 91)) / length, run((data > 47) & (data < 58)) / length, run((data > 32) & (data < 48)) / length, repeats, np.minimum(count / 200, 1)]
    h3, row3 = prefixes(plain, off, BEGINNINGS)
    keys = [h2, h3] + [mix(np.searchsorted(_STEPS, x, "right").astype(U) + U(1000 * (i + 1))) for i, x in enumerate(shapes)]
    rows = np.concatenate([row2, row3] + [np.arange(n)] * len(shapes))
    k = (np.concatenate(keys) >> U(64 - bits)).astype(np.int64)
    pairs = np.unique(rows.astype(np.int64) << bits | k)
    return pairs & ((1 << bits) - 1), np.concatenate(([0], np.cumsum(np.bincount(pairs >> bits, minlength=n))))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(x: np.ndarray, off: np.ndarray, grade: np.ndarray, grades: int, bits: int, epochs: int = 24, batch: int = 32, l1: float = 2e-3, rate: float = 0.5, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(weights, ordered thresholds) by proximal AdaGrad on the negative log-likelihood.

    Thresholds are a first value and positive gaps, so their order holds throughout.  The result is the mean over the
    ends of the later half of the epochs, as single ones differ by the order of the rows.
    """
    w, g2 = np.zeros(1 << bits), np.full(1 << bits, 1e-8)
    # each threshold starts where the share of higher grades alone would put it
    above = np.array([np.clip((grade > k).mean(), 1e-3, 1 - 1e-3) for k in range(grades - 1)])
    th = np.maximum.accumulate(-np.log(above / (1 - above)) + 1e-3 * np.arange(grades - 1))
    t2 = np.full(grades - 1, 1e-8)
    rng = np.random.default_rng(seed)
    n = len(grade)
    mean_w, mean_th, taken = np.zeros_like(w), np.zeros_like(th), 0
    for epoch in range(epochs):
        order = rng.permutation(n)
        for lo in range(0, n, batch):
            rows = order[lo : lo + batch]
            size = off[rows + 1] - off[rows]
            at = np.repeat(off[rows] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            f, own = x[at], np.repeat(np.arange(len(rows)), size)
            eta = np.bincount(own, w[f], minlength=len(rows))
            y = grade[rows]
            cum = np.concatenate((np.ones((len(rows), 1)), _sigmoid(eta[:, None] - th), np.zeros((len(rows), 1))), 1)
            p = np.maximum(cum[np.arange(len(rows)), y] - cum[np.arange(len(rows)), y + 1], 1e-9)
            slope = cum * (1 - cum)
            d = -(slope[np.arange(len(rows)), y] - slope[np.arange(len(rows)), y + 1]) / p
            dth = np.zeros((len(rows), grades + 1))
            dth[np.arange(len(rows)), y] += slope[np.arange(len(rows)), y] / p
            dth[np.arange(len(rows)), y + 1] -= slope[np.arange(len(rows)), y + 1] / p
            g = np.bincount(f, d[own], minlength=1 << bits) / len(rows)
            hit = np.flatnonzero(g)
            g2[hit] += g[hit] ** 2
            step = rate / np.sqrt(g2[hit])
            v = w[hit] - step * g[hit]
            w[hit] = np.sign(v) * np.maximum(np.abs(v) - step * l1, 0)
            gt = dth[:, 1:-1].mean(0)
            t2 += gt**2
            th = np.maximum.accumulate(th - rate / np.sqrt(t2) * gt + 1e-6 * np.arange(grades - 1))
        if epoch >= epochs // 2:
            taken += 1
            mean_w += (w - mean_w) / taken
            mean_th += (th - mean_th) / taken
    return (mean_w, mean_th) if taken else (w, th)


def fit(docs: DataFrame, ratings: DataFrame, grade_col: str, id_col: str = "doc_id", text_col: str = "text", grades: int = 3, bits: int = 20, max_rows: int = 12_000, max_bytes: int = 128 << 20, rare: int = 600) -> tuple[np.ndarray, np.ndarray] | None:
    """Fit on about ``max_rows`` rated documents with about ``max_bytes`` of text at most, chosen by a hash of the id; None without any.

    ``rare``: features of less than one in so many of these documents are left out.
    ``ratings`` has one integer grade from 0 to ``grades - 1`` per id; rows with a null are skipped.
    """
    r = ratings.where(F.col(grade_col).between(0, grades - 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(grade_col).cast("int").alias("g"))
    draw = F.pmod(F.xxhash64("i", F.lit("rating sample")), F.lit(1 << 30)) / float(1 << 30)
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where(F.col("t").isNotNull())
    size = texts.select("i", F.octet_length("t").alias("size")).join(r, "i").agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    share = min(max_rows / max(1, r.count()), max_bytes / max(1, size))
    rows = texts.where(draw < share).join(r.where(draw < share), "i")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                f, off = features(part.column(0), bits)
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(f.astype(np.int32)))], ["i", "g", "f"])

    got = split_hint(rows.select("t", "i", "g")).mapInArrow(run, f"i {r.schema['i'].dataType.simpleString()}, g int, f array<int>").orderBy("i").toArrow().combine_chunks()
    if not got.num_rows:
        return None
    col = got.column("f").combine_chunks()
    col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
    off = col.offsets.to_numpy().astype(np.int64)
    # a feature of a few documents says which document it is, not of what grade: it is left out
    x, rows = col.values.to_numpy(), np.repeat(np.arange(got.num_rows), np.diff(off))
    often = np.bincount(x, minlength=1 << bits) >= max(1, got.num_rows // rare)
    off = np.concatenate(([0], np.cumsum(np.bincount(rows[often[x]], minlength=got.num_rows))))
    return fit_ordinal(x[often[x]], off, got.column("g").to_numpy(), grades, bits)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray] | None, text_col: str = "text", tail: int = 1) -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_prob``, the probability of a grade of ``tail`` or more.

    Columns of these names are replaced.  Null and empty texts are scored by their shape features;
    without a model both columns are null.
    """
    keep = others(docs, "expected_grade", "tail_prob")
    src, names = numbered(docs, keep)
    back = [F.col(n).alias(c) for c, n in names.items()]
    if model is None:
        return src.select(*back, F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("tail_prob"))
    w, th = model
    bits = int(np.log2(len(w)))
    shared = docs.sparkSession.sparkContext.broadcast(w.astype(np.float32))
    t, e, p = next(n for c, n in names.items() if c.lower() == text_col.lower()), "expected", "tail"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, t):
                f, off = features(part.column(part.schema.get_field_index(t)), bits)
                eta = np.add.reduceat(shared.value[f].astype(np.float64), off[:-1])
                above = _sigmoid(eta[:, None] - th)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(above.sum(1)), pa.array(above[:, tail - 1])], [*part.schema.names, e, p])

    out = split_hint(src).mapInArrow(run, f"{ddl(src)}, `{e}` double, `{p}` double")
    return out.select(*back, F.col(e).alias("expected_grade"), F.col(p).alias("tail_prob"))


def grades_of(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 toxic, 1 poor, 2 good; several rows of an id count by their lowest grade."""
    g = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.groupBy("doc_id").agg(F.min(g).alias("grade"))


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the expected grade, the probability that it isn't toxic, and whether it is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, grades_of(table(spark, sf_dir, "labels")), "grade")
    return score(docs, model).select("doc_id", "expected_grade", "tail_prob", F.coalesce(F.col("tail_prob") >= 0.5, F.lit(True)).alias("keep"))
