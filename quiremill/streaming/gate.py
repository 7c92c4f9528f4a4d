"""The quality gate and progress as streams: the batch operators over a file source, with state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quiremill.operators.quality import decision


def checkpoint_folder(spark: SparkSession) -> str:
    """A new folder for a stream's checkpoint, below ``spark.checkpoint.dir``; a temporary one only where that is unset."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="quiremill-")
    return f"{root.rstrip('/')}/stream-{uuid.uuid4().hex[:12]}"


def read_words(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of new Parquet files; the checkpoint remembers what was read."""
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else r).parquet(path)


def running_gate(words: DataFrame, threshold: float, page: str = "page", conf: str = "conf") -> DataFrame:
    """Count, mean and decision per page so far; for update or complete mode."""
    a = words.groupBy(page).agg(F.count(conf).alias("word_count"), F.round(F.avg(conf), 3).alias("mean_confidence"))
    passed = F.col("mean_confidence") >= threshold
    return a.withColumns({"passed": passed, "decision": decision(passed)})


def windowed_gate(words: DataFrame, threshold: float, time: str, late: str = "10 minutes", width: str = "1 hour", page: str = "page", conf: str = "conf") -> DataFrame:
    """The gate per page and time window; with a watermark, so state is dropped and append mode works."""
    a = words.withWatermark(time, late).groupBy(F.window(time, width), page).agg(F.count(conf).alias("word_count"), F.round(F.avg(conf), 3).alias("mean_confidence"))
    passed = F.col("mean_confidence") >= threshold
    return a.withColumns({"passed": passed, "decision": decision(passed)})


def once_per_page(decisions: DataFrame, time: str, late: str = "2 hours") -> DataFrame:
    """The first decision of each page within the watermark: a restarted job appends none twice."""
    return decisions.withWatermark(time, late).dropDuplicatesWithinWatermark(["job", "page"])


def to_table(stream: DataFrame, name: str, mode: str, checkpoint: str) -> StreamingQuery:
    """All that is available, into a table in memory."""
    return stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def to_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append-only JSON lines, each row once."""
    return stream.writeStream.format("json").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(path)
