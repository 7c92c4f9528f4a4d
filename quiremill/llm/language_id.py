"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of one to three characters in a bounded sample of labelled rows: up to
``per_lang`` expected rows of each language, chosen by a hash of the id.  The counts are summed by
(language, bucket), a table of at most ``2**bits`` rows a language whatever the corpus, and give a
matrix of log-probabilities that is broadcast to all tasks (1 MB for four languages).  Scoring
takes whole texts: each text is a sparse row of bucket counts, kept as a list of buckets, and the
product with the matrix is a gather and a segmented sum over a batch, in pieces of 8 MB at most
however long a text is and however many languages there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.llm.common import ddl, numbered, others, split_hint, table
from quiremill.llm.texthash import release, slices

UNKNOWN = "und"
#: Bytes of the matrix that are gathered at a time.
PIECE = 8 << 20
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Whether each code point is a letter; made once per worker."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _grams(texts: list[str | None], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the offset of each text's first, and how many letters each has.

    Texts are lower-cased; what isn't a letter counts as a blank, a run of them as one.
    """
    parts = [(x or "").lower() for x in texts]
    flat = np.frombuffer(" ".join(["", *parts, "  "]).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(x) + 1 for x in parts])
    begin = np.concatenate(([0], np.cumsum(size)))  # each text with the blank before it
    letter = _is_letter()[flat]
    c = np.where(letter, flat, 32).astype(np.uint32)
    n = begin[-1]
    use = letter[:n] | letter[1 : n + 1]
    at = np.flatnonzero(use)
    a, b, d = c[at], c[at + 1], c[at + 2]
    # After a blank that ends a word the next character belongs to another word, or another text.
    shift = np.uint32(32 - bits)
    one = a * np.uint32(0x9E3779B1) >> shift
    two = (a * np.uint32(0x85EBCA6B) + b * np.uint32(0xC2B2AE35) + np.uint32(1)) * np.uint32(0x27D4EB2F) >> shift
    d = np.where(b == 32, np.uint32(32), d)
    three = (a * np.uint32(0x165667B1) + b * np.uint32(0x85EBCA77) + d * np.uint32(0x9E3779B1) + np.uint32(2)) * np.uint32(0xC2B2AE3D) >> shift
    grams = np.stack((one, two, three), 1).reshape(-1)
    cut = np.searchsorted(at, begin)
    count = np.concatenate(([0], np.cumsum(letter[1 : n + 1])))
    return grams, 3 * cut, count[begin[1:] - 0] - count[begin[:-1]]


def _counter(bits: int, text: str, lang: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, text):
                grams, off, _ = _grams(part.column(part.schema.get_field_index(text)).to_pylist(), bits)
                for i, name in enumerate(part.column(part.schema.get_field_index(lang)).to_pylist()):
                    mine = np.bincount(grams[off[i] : off[i + 1]], minlength=1 << bits)
                    total[name] = total[name] + mine if name in total else mine
        for name, x in total.items():
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(x[at].astype(np.int64))], ["lang", "bucket", "n"])

    return run


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text leaves remainder 1 by 3; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bits: int = 16, per_lang: int = 4000) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities [bucket, language]) from rows where ``train`` holds and ``lang_col`` isn't null.

    ``per_lang``: expected rows of each language in the sample, the bound on what is fitted on.
    """
    rows = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    sizes = rows.groupBy("l").count().collect()
    if not sizes:
        return [], np.zeros((1 << bits, 0), np.float32)
    share = F.element_at(F.create_map(*[F.lit(x) for r in sizes for x in (r["l"], float(per_lang / r["count"]))]), F.col("l"))
    draw = F.pmod(F.xxhash64("i", F.lit("language sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = split_hint(rows.where(F.coalesce(draw < share, F.lit(False))).select("t", "l"))
    counts = sample.mapInArrow(_counter(bits, "t", "l"), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counts.toPandas()
    names = sorted(r["l"] for r in sizes)
    x = np.zeros((1 << bits, len(names)))
    x[got["bucket"].to_numpy(), got["lang"].map({n: i for i, n in enumerate(names)}).to_numpy(int)] = got["n"].to_numpy()
    x += 0.1
    return names, np.log(x / x.sum(0)).astype(np.float32)


def _sums(m: np.ndarray, grams: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``m`` over each text's n-grams, [text, language]; pieces begin at a text's start or at fixed steps from it."""
    step = max(256, PIECE // (4 * max(1, m.shape[1])))
    pieces = -(-np.diff(off) // step)
    own = np.repeat(np.arange(len(pieces)), pieces)
    start = off[own] + step * (np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    out = np.zeros((len(pieces), m.shape[1]))
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(start, start[lo] + step, "left")))
        stop = min(start[hi] if hi < len(start) else off[-1], off[own[hi - 1] + 1])
        np.add.at(out, own[lo:hi], np.add.reduceat(np.take(m, grams[start[lo] : stop], axis=0), start[lo:hi] - start[lo], axis=0, dtype=np.float64))
        lo = hi
    return out


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the language of each whole text and its posterior probability.

    Columns of these two names are replaced.  A text that is null or has no letter gives ``und``
    with score 0, as does every text if no language was learned.  All languages count as equally
    likely beforehand; a tie goes to the name that sorts first.
    """
    names, logs = model
    bits = int(np.log2(len(logs)))
    keep = others(docs, pred_col, score_col)
    src, names_ = numbered(docs, keep)
    t, p, s = next(n for c, n in names_.items() if c.lower() == text_col.lower()), "pred", "score"
    shared = docs.sparkSession.sparkContext.broadcast(logs)
    mat = pa.array([*names, UNKNOWN], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, t):
                grams, off, letters = _grams(part.column(part.schema.get_field_index(t)).to_pylist(), bits)
                best, score = np.full(part.num_rows, len(names)), np.zeros(part.num_rows)
                some = np.flatnonzero((letters > 0) & (len(names) > 0))
                if len(some):
                    sums = _sums(m, grams, off)[some]
                    best[some] = sums.argmax(1)
                    sums -= sums.max(1, keepdims=True)
                    score[some] = 1 / np.exp(sums).sum(1)
                yield pa.RecordBatch.from_arrays([*part.columns, mat.take(pa.array(best)), pa.array(score)], [*part.schema.names, p, s])
        release()

    out = split_hint(src).mapInArrow(run, f"{ddl(src)}, `{p}` string, `{s}` double")
    return out.select(*[F.col(n).alias(c) for c, n in names_.items()], F.col(p).alias(pred_col), F.col(s).alias(score_col))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **how) -> DataFrame:
    """Learn from the rows of ``docs`` that aren't held out, and predict all."""
    return predict(docs, fit(docs, ~held_out(F.col(id_col)), id_col, text_col, lang_col, **how), text_col)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, ~held_out(F.col("doc_id")))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
