"""A training-data pipeline of five stages over ``documents``.

Each stage takes what its predecessor kept, as Parquet, and all but the last return the columns of
documents.  Texts are shuffled by line dedup only; the other stages find ids to drop, which are
few against the texts, and drop them by an anti-join that broadcasts them when counted few enough.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.llm.common import staged, table
from quiremill.llm.decontaminate import contaminated_alignments
from quiremill.llm.jaccard_join import _few, jaccard_components
from quiremill.llm.language_id import UNKNOWN, identify
from quiremill.llm.line_dedup import line_dedup
from quiremill.llm.sampled_pieces import encode_samples

LEAST_SCORE = 0.5
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
SAMPLES = 2


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` whose ``doc_id`` isn't among ``ids``; a null id is never dropped."""
    return docs.join(_few(staged(ids.distinct(), "dropped")), "doc_id", "left_anti").select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is recognised; ``lang`` stays as it was."""
    seen = identify(docs)
    return seen.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated lines from the texts; a document that loses all its lines goes."""
    out = line_dedup(docs)
    out = out.where((F.col("n_removed") == 0) | (F.trim("text", F.lit(" \t\r\n")) != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``row`` number, rows equal in id and text being one; numbers follow id and text."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = docs.groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("_"), *rest)).alias("rest"))
    one = one.sort("doc_id", F.xxhash64("text"), "text").select("doc_id", "text", *[F.col("rest").getField(c).alias(c) for c in rest])
    return staged(one.select(F.monotonically_increasing_id().alias("row"), *docs.columns), "rows")


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document of smallest id stays.

    Where an id occurs more than once, each of its texts is a document: of rows equal in id and text
    one stays, and of near copies under one id the first by a hash of the text.  Rows with a null id
    link with nothing and stay.
    """
    named = docs.where("doc_id is not null")
    if named.groupBy("doc_id").count().where("count > 1").isEmpty():
        found = staged(jaccard_components(docs.select("doc_id", "text"), SHINGLE_WORDS, SIMILAR_PERCENT), "components")
        return _without(docs, found.where("component_id < doc_id").select("doc_id"))
    rows = _apart(named)
    found = staged(jaccard_components(rows, SHINGLE_WORDS, SIMILAR_PERCENT, id_col="row"), "components")
    stay = rows.join(found.where("component_id < row").select("row"), "row", "left_anti").select(*docs.columns)
    return stay.union(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    found = contaminated_alignments(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return _without(docs, found.select(F.col("doc").alias("doc_id")))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of the texts, as ids, with their scores."""
    return encode_samples(docs, SAMPLES).drop("text")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("jaccard_join", jaccard),
    ("decontaminate", decontaminate),
    ("sampled_pieces", pieces),
]

#: SQL can't express the first and the last stage; tests/llm holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
