"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A seed is a fixed mask over consecutive words: it looks at some places and ignores the others, so
a match survives substitutions at ignored places.  With the two default masks every stretch of 15
words with at most three substitutions holds a full match of one of them (all 455 patterns were
tried).  An item shorter than the window is cut into one run of words more than it may have
substitutions, so that one run is left whole in every match; these runs are its seeds.  Seeds of the benchmark are joined with seeds of all documents at every position, all masks in one pass; each hit
fixes an item and an alignment, along which words are compared: a document is contaminated if some
stretch of ``window`` item words (the whole item, if shorter) agrees with it in at least
``similarity`` of its places.

The benchmark's seeds and the words of its items are broadcast if, counted first, they are at most
``max_broadcast_seeds`` and ``max_broadcast_bytes``, and are joined by shuffle if not; the result is the same.  The scan, the masks, the
probe of the broadcast seeds and the comparison are one stage without a shuffle; what is
shuffled is one small row per contaminated alignment, then joined with the ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.llm.common import others, quoted, table

MASKS = ((0, 1, 3, 4, 5), (0, 2, 3, 6, 8))


def word_hashes(text: Column) -> Column:
    """Hashes of the words (runs of letters and digits, lower-cased) of a text; null gives none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(h: str, i: Column, masks, first: int = 0) -> Column:
    """Per mask (numbered from ``first``) the hash of the words it looks at from place ``i`` on, null past the end."""
    def one(m: int, mask) -> Column:
        at = [F.get(h, i + o) for o in mask]
        return F.when(F.size(h) > i + mask[-1], F.xxhash64(F.lit(m), *at))

    return F.array(*[one(first + m, mask) for m, mask in enumerate(masks)])


def _positions(df: DataFrame, keep: list[str], masks) -> DataFrame:
    """A row per place and mask: ``keep``, ``h``, ``i``, ``k``."""
    least = min(m[-1] for m in masks)
    # null, not a filter, for short texts: a filter would be pushed below and hash all words twice
    places = F.when(F.size("h") > least, F.sequence(F.lit(0), F.size("h") - least - 1))
    long = df.select(*keep, "h", F.explode(places).alias("i"))
    return long.select(*keep, "h", "i", F.explode(_seeds("h", F.col("i"), masks)).alias("k")).where("k is not null")


def _run_seeds(items: DataFrame, need: Column, first: int) -> tuple[DataFrame, list[tuple[int, ...]]]:
    """Seeds (n, b, bk) of items that need ``need`` equal words: runs of which a match leaves one whole; and their masks, numbered from ``first``."""
    n, parts = F.size("h"), F.size("h") - need + 1
    at = lambda j: F.floor(j * n / parts).cast("int")
    runs = F.transform(F.sequence(F.lit(0), parts - 1), lambda j: F.struct(at(j).alias("b"), (at(j + 1) - at(j)).alias("size")))
    runs = items.select("n", "h", F.explode(runs).alias("r")).select("n", "h", "r.b", "r.size")
    # runs are shorter than the window, so there are few sizes
    masks = [tuple(range(r["size"])) for r in runs.select("size").distinct().orderBy("size").collect()]
    keys = [F.when(F.col("size") == len(m), _seeds("h", F.col("b"), [m], first + j)[0]) for j, m in enumerate(masks)]
    return runs.select("n", "b", (F.coalesce(*keys) if keys else F.lit(None).cast("long")).alias("bk")), masks


def contaminated_alignments(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", masks=MASKS, window: int = 15, similarity: float = 0.8, max_broadcast_seeds: int = 500_000, max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(doc, item, matched): ids and the most agreeing words on an alignment, once per pair.

    Items without an id are items like others, reported with a null id.  The bounds decide how seeds meet the documents, not what is found.
    """
    items = benchmark.select(F.col(item_col).alias("item"), word_hashes(F.col(item_text)).alias("h")).where(F.size("h") > 0).distinct()
    # an item's name within the job: ids may be null, or shared by several texts
    items = items.select(F.struct(F.xxhash64("item", "h").alias("x"), F.xxhash64(F.lit("second"), "item", "h").alias("y")).alias("n"), "item", "h")
    long = _positions(items.where(F.size("h") >= window), ["n"], masks).select("n", F.col("i").alias("b"), F.col("k").alias("bk"))
    need_all = F.greatest(F.ceil(F.lit(similarity) * F.size("h")), F.lit(1)).cast("int")
    short, runs = _run_seeds(items.where(F.size("h") < window), need_all, len(masks))
    seeds, whole = long.unionByName(short), [*masks, *runs]
    d = docs.select(F.col(id_col).alias("doc"), word_hashes(F.col(text_col)).alias("h"))
    texts = items.select(F.col("n").alias("tn"), "item", F.col("h").alias("bh"))
    many = seeds.count()
    size = many * 64 + texts.agg(F.coalesce(F.sum(8 * F.size("bh") + 64), F.lit(0))).first()[0]
    if many <= max_broadcast_seeds and size <= max_broadcast_bytes:
        # one row per seed and item: equal seeds at several places of an item stay apart, they
        # are different alignments
        hits = _positions(d, ["doc"], whole).join(F.broadcast(seeds), F.col("k") == F.col("bk"))
        hits = hits.join(F.broadcast(texts), F.col("n") == F.col("tn")).select("doc", "h", "i", "item", "bh", "b")
    else:
        # without the document's words, which would travel with every place; they join the hits
        places = _positions(d, ["doc"], whole).select("doc", "i", "k")
        met = places.join(seeds, F.col("k") == F.col("bk")).select(F.col("doc").alias("hit_doc"), "n", (F.col("i") - F.col("b")).alias("i")).distinct()
        met = met.join(texts, F.col("n") == F.col("tn"))
        hits = met.join(d, F.col("hit_doc").eqNullSafe(F.col("doc"))).select("doc", "h", "i", "item", "bh", F.lit(0).alias("b"))
    # Along the alignment, place x of the item stands at place x + i - b of the document.  What is
    # needed of the document is cut out here, and through a generator, so that no lambda gets into
    # the join's condition: scan positions, masks and probe stay one compiled loop over ``h``.
    shift = F.col("i") - F.col("b")
    lead = F.greatest(-shift, F.lit(0))
    part = F.slice("h", F.greatest(shift, F.lit(0)) + 1, F.size("bh") - lead)
    hits = hits.select("doc", "item", F.explode(F.array(F.struct(F.col("bh"), lead.alias("lead"), part.alias("part")))).alias("hit"))
    here = F.concat(F.array_repeat(F.lit(None).cast("long"), F.col("hit.lead")), F.col("hit.part"))
    same = F.slice(F.zip_with("hit.bh", here, lambda x, y: F.coalesce((x == y).cast("int"), F.lit(0))), 1, F.size("hit.bh"))
    hits = hits.select("doc", "item", same.alias("same"))
    w = F.least(F.lit(window), F.size("same"))
    need = F.ceil(F.lit(similarity) * w)
    total = F.aggregate("same", F.lit(0), lambda a, x: a + x)
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.size("same") - w + 1), lambda s: F.aggregate(F.slice("same", s, w), F.lit(0), lambda a, x: a + x)))
    found = hits.withColumn("matched", total).where(F.col("matched") >= need).where(best >= need)
    return found.groupBy("doc", "item").agg(F.max("matched").alias("matched"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """``docs`` with ``contaminated`` and ``items``, the sorted ids of the items found.

    Columns of these names are replaced, further ones kept.  Null and empty texts and
    items without words are never part of a match; an empty benchmark
    leaves all documents clean.  An item without an id stands as null, first in ``items``; equal ids of different texts are one.  Rows with equal ids share the verdict; a null id is matched too
    and rows with a null id share theirs.  Copies of a document are judged alike.
    """
    found = contaminated_alignments(docs, benchmark, id_col, **how)
    ids = F.transform(F.sort_array(F.collect_set(F.struct("item"))), lambda x: x["item"])  # in a struct, as null is left out of sets
    found = found.groupBy("doc").agg(ids.alias("items_"))
    names = others(docs, "contaminated", "items")
    joined = docs.select(F.struct(F.lit(1).alias("_"), *map(quoted, names)).alias("row")).join(found, F.col(f"row.{id_col}").eqNullSafe(F.col("doc")), "left")
    empty = F.array().cast(found.schema["items_"].dataType)
    return joined.select(*[F.col("row").getField(c).alias(c) for c in names], F.col("items_").isNotNull().alias("contaminated"), F.coalesce("items_", empty).alias("items"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = contaminated_alignments(docs, table(spark, sf_dir, "benchmark"))
    items = found.groupBy("doc").agg(F.count("*").alias("n_items"), F.min("item").alias("first_item"))
    out = docs.select("doc_id").join(items, F.col("doc_id").eqNullSafe(F.col("doc")), "left")
    return out.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "first_item")


# From the definition: every alignment on which a word of an item agrees, by its best stretch of 15 item words.
SQL = r"""
WITH b AS (
  SELECT row_number() OVER () AS n, item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
), d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
), bw AS (SELECT n, item_id, len(w) AS size, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM b),
dw AS (SELECT r, doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
same AS (
  SELECT r, doc_id, n, item_id, size, dw.i - bw.i AS shift, bw.i FROM dw JOIN bw USING (x)
), best AS (
  SELECT doc_id, item_id, size, count(*) OVER (PARTITION BY r, n, shift ORDER BY i RANGE BETWEEN 14 PRECEDING AND CURRENT ROW) AS equal FROM same
), found AS (
  SELECT DISTINCT doc_id, item_id FROM best WHERE equal >= ceil(0.8 * least(15, size))
), per AS (SELECT doc_id, count(*) AS n_items, min(item_id) AS first_item FROM found GROUP BY doc_id)
SELECT d.doc_id, per.n_items IS NOT NULL AS contaminated, coalesce(per.n_items, 0) AS n_items, per.first_item
FROM documents d LEFT JOIN per ON per.doc_id IS NOT DISTINCT FROM d.doc_id
"""
