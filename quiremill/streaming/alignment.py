"""Canonical alignment as a stream: a cursor per job that outlives the batches.

The canonical texts of a job and the keys of its references are the initial state of the job; each batch of entries is
matched from where the last one left the cursor.  State lives in RocksDB and is part of the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quiremill.functions import text as X
from quiremill.functions.similarity import ratio
from quiremill.operators.alignment import reference_key

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession):
    """While a query is started: state in RocksDB, which state of several kinds needs."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(key, before)


class _Cursor(StatefulProcessor):
    def __init__(self, threshold: float):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cursor = handle.getValueState("cursor", "at long")
        self.texts = handle.getMapState("texts", "ord long", "ref string, text string")
        self.keys = handle.getMapState("keys", "key string", "ord long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for r in initialState.itertuples():
            if r.key is not None:
                self.keys.updateValue((r.key,), (int(r.ord),))
            else:
                self.texts.updateValue((int(r.ord),), (r.ref, r.text or ""))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        cursor = int(self.cursor.get()[0]) if self.cursor.exists() else 0
        out = []
        for r in pd.concat(list(rows)).sort_values(["page", "idx"]).itertuples():
            at, ref = None, None
            if isinstance(r.key, str) and self.keys.containsKey((r.key,)):
                at, ref = int(self.keys.getValue((r.key,))[0]), r.key
            elif self.texts.containsKey((cursor,)):
                own, text = self.texts.getValue((cursor,))
                if text and ratio(r.heading, text) >= self.threshold:
                    at, ref = cursor, own
            if at is not None:
                cursor = at + 1
                out.append((*key, r.page, r.entry, ref, at, r.heading, r.body))
        self.cursor.update((cursor,))
        yield pd.DataFrame(out, columns=["job", "page", "entry", "ref", "ord", "heading", "body"])

    def close(self) -> None:
        pass


def canonical_stream(entries: DataFrame, canonical: DataFrame, keys: DataFrame, threshold: float = 0.5) -> DataFrame:
    """What ``alignment.align_canonical`` gives, for a stream of entries (job, page, entry, idx, heading, body).

    The entries of a job come in their order, batch by batch; within a batch they are sorted.  ``canonical`` (job, ord, ref, text) and
    ``keys`` (job, key, ord) are tables, read once when the query starts first.  To be started within ``rocksdb(spark)``.
    """
    kind = canonical.schema["job"].dataType.simpleString()
    e = entries.withColumn("key", reference_key(F.col("heading"), F.col("body"))).withColumns({"heading": X.clean_lines(F.col("heading")), "body": X.clean_lines(F.col("body"))})
    e = e.select("job", F.col("page").cast("long").alias("page"), F.col("idx").cast("long").alias("idx"), F.col("entry").cast("long").alias("entry"), "key", "heading", "body")
    none = F.lit(None).cast("string")
    first = canonical.select("job", none.alias("key"), F.col("ord").cast("long").alias("ord"), "ref", "text").union(keys.select("job", "key", F.col("ord").cast("long"), none, none))
    out = f"job {kind}, page long, entry long, ref string, ord long, heading string, body string"
    return e.groupBy("job").transformWithStateInPandas(_Cursor(threshold), outputStructType=out, outputMode="Append", timeMode="None", initialState=first.groupBy("job"))
