"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where that is unset and the master is local is a temporary folder used.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="quiremill-")
        spark.sparkContext.setCheckpointDir(root)
    return root if "://" in root or root.startswith("file:") else "file://" + root


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark).rstrip('/')}/quiremill/{label}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs the reading of a file, never a recomputation
    of what stands before.  The path is kept in ``staged_path`` for ``forget``.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def forget(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for df in frames:
        if path := getattr(df, "staged_path", None):
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def named_vertices(sets: DataFrame, keys: list[str]) -> tuple[DataFrame, bool]:
    """``sets`` (d, *keys, ...), a row per distinct ``keys``, with a name ``u`` of its own for each row; and whether any isn't ``d``.

    A row is named by its id ``d``.  Where several rows have one id, the first by ``keys`` has that name
    and the others one by hash, tried until no two are equal.  No column of ``keys`` may be null.
    """
    key = F.struct(*keys)
    shared = sets.groupBy("d").agg(F.min(key).alias("first_"), F.count("*").alias("many_")).where("many_ > 1").drop("many_")
    shared = staged(shared, "shared")
    if shared.isEmpty():
        return sets.withColumn("u", F.col("d")), False
    marked = sets.join(shared, "d", "left")
    salt = 0
    while True:
        own = F.when(F.coalesce(key != F.col("first_"), F.lit(False)), F.xxhash64(F.lit(salt), "d", *keys)).otherwise(F.col("d"))
        named = staged(marked.select(*sets.columns, own.alias("u")), "named")
        if named.count() == named.select("u").distinct().count():
            return named, True
        forget(sets.sparkSession, named)
        salt += 1


def least_names(comp: DataFrame, named: DataFrame) -> DataFrame:
    """``comp`` (node, component), components renamed by the smallest ``d`` of their vertices in ``named`` (u, d)."""
    least = comp.join(named.select(F.col("u").alias("node"), "d"), "node").groupBy("component").agg(F.min("d").alias("least"))
    return comp.join(least, "component").select("node", F.col("least").alias("component"))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def hash128(*cols: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes with different seeds, as one 128-bit key."""
    return F.xxhash64(*cols), F.xxhash64(F.lit("second"), *cols)


def free_name(df: DataFrame, base: str) -> str:
    """A column name like ``base`` that ``df`` doesn't have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def quoted(name: str) -> str:
    """A column's name so that dots, blanks and backquotes in it are part of it."""
    return "`" + name.replace("`", "``") + "`"


def ddl(df: DataFrame) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)


def others(df: DataFrame, *names: str) -> list[str]:
    """The columns of ``df`` but those of these names, compared without case as Spark resolves them."""
    gone = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in gone]


def numbered(df: DataFrame, keep: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the columns ``keep`` under names of their own, and those names: functions over batches need names without dots."""
    names = {c: f"c{i}" for i, c in enumerate(keep)}
    return df.select(*[F.col(quoted(c)).alias(n) for c, n in names.items()]), names


def split_hint(df: DataFrame, target_bytes: int = 1 << 20) -> DataFrame:
    """``df``; Arrow batches of its session are bounded by size as well as by rows from here on.

    The bound is a setting of the session, as no plan has one of its own; a lower one stays.
    """
    spark = df.sparkSession
    conf = spark.conf
    now = conf.get("spark.sql.execution.arrow.maxBytesPerBatch", "268435456")
    if not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) <= 8 * target_bytes:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 * target_bytes))
    return df
