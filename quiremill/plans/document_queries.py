"""Queries that build documents, align texts, treat images and run streams: tests hold most of them, not SQL."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from quiremill.functions import images as I
from quiremill.functions.similarity import similarity
from quiremill.operators import alignment as A
from quiremill.operators import editions as ED
from quiremill.operators import front_matter as FM
from quiremill.operators import jobs as J
from quiremill.operators import structure as S
from quiremill.operators import typeset as TS
from quiremill.plans.quality_queries import table
from quiremill.plans.registry import query
from quiremill.sources import documents as D
from quiremill.sources import exports as E
from quiremill.streaming import alignment as ST
from quiremill.streaming import gate as G


def _book(spark, d):
    c = table(spark, d, "conversations")
    kind = F.when(F.col("role") == "system", "h1").when(F.col("role") == "user", "h2").otherwise("p")
    blocks = c.select((F.col("conv_id") % 10).cast("string").alias("job"), F.col("conv_id").cast("int").alias("page"), F.col("turn").cast("int").alias("idx"), kind.alias("type"), "text")
    return blocks, blocks.select("job").distinct().select("job", F.concat(F.lit("Book "), "job").alias("title"))


@query(
    "book_pages",
    """SELECT conv_id % 10 AS job, count(DISTINCT conv_id) AS page_count, count(*) AS blocks FROM conversations GROUP BY 1""",
)
def book_pages(spark, d):
    blocks, meta = _book(spark, d)
    j = E.book_json(blocks, meta).select("job", F.from_json("content", "metadata struct<page_count: int>, pages array<struct<blocks: array<struct<type: string>>>>").alias("j"))
    n = F.aggregate(F.transform("j.pages", lambda p: F.size(p.blocks)), F.lit(0), lambda a, x: a + x)
    return j.select(F.col("job").cast("bigint").alias("job"), F.col("j.metadata.page_count").cast("bigint").alias("page_count"), n.cast("bigint").alias("blocks"))


@query(
    "book_markdown",
    """WITH b AS (SELECT conv_id % 10 AS job, conv_id, turn, CASE role WHEN 'system' THEN '# ' WHEN 'user' THEN '## ' ELSE '' END || text || chr(10) || chr(10) AS t FROM conversations),
p AS (SELECT job, conv_id, '<!-- page ' || conv_id || ' -->' || chr(10) || chr(10) || string_agg(t, '' ORDER BY turn) AS t FROM b GROUP BY job, conv_id)
SELECT job, md5('---' || chr(10) || 'job: "' || job || '"' || chr(10) || 'title: "Book ' || job || '"' || chr(10) || '---' || chr(10) || chr(10) || string_agg(t, '' ORDER BY conv_id)) AS h FROM p GROUP BY job""",
)
def book_markdown(spark, d):
    return E.book_markdown(*_book(spark, d)).select(F.col("job").cast("bigint").alias("job"), F.md5("content").alias("h"))


@query("tei_export")
def tei_export(spark, d):
    return E.tei_xml(*_book(spark, d)).select("job", F.length("content").alias("chars"))


@query("epub_export")
def epub_export(spark, d):
    return E.epub(*_book(spark, d)).select("job", F.octet_length("content").alias("bytes"))


def _typeset(spark, d):
    """Conversations as pages of ten books: their markup, and the contents made of their first-level headings."""
    blocks, meta = _book(spark, d)
    pages = blocks.select("job", "page").distinct().withColumns({"label": F.col("page").cast("string"), "book": F.lit("")})
    toc = S.toc_from_headings(blocks)
    return blocks, pages, toc, meta


@query("typst_pages")
def typst_pages(spark, d):
    blocks, pages, toc, _ = _typeset(spark, d)
    return TS.page_markup(blocks, pages, toc).select("job", "page", F.md5("markup").alias("h"))


@query("typst_export")
def typst_export(spark, d):
    blocks, pages, toc, meta = _typeset(spark, d)
    full = pages.join(TS.page_markup(blocks, pages, toc), ["job", "page"]).join(TS.chapters(blocks, toc).select("job", "page", "is_chapter"), ["job", "page"])
    meta = meta.select("job", "title", *[F.lit(None).cast("string").alias(c) for c in ("author", "date", "language")], F.lit(0).alias("front_pages"))
    return TS.document(full, meta).select("job", F.md5("content").alias("h"), F.length("content").alias("chars"))


@query(
    "correction_totals",
    r"""WITH c AS (SELECT lang AS job, doc_id AS page, coalesce(list_distinct(regexp_extract_all(text, '[A-Z][a-z]+')), []) AS w, n_chars % 7 AS hits FROM documents),
r AS (SELECT job, page, GROUPING(job, page)::INT AS level, count(*) AS pages, sum(len(w))::BIGINT AS tokens, sum(hits)::BIGINT AS hits FROM c GROUP BY ROLLUP (job, page))
SELECT * FROM r""",
)
def correction_totals(spark, d):
    """A correction for each distinct capitalised word of a document: by document, language and in all."""
    words = F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0)))
    c = table(spark, d, "documents").select(F.col("lang").alias("job"), F.col("doc_id").alias("page"), F.map_from_arrays(words, F.transform(words, F.lower)).alias("mapping"), (F.col("n_chars") % 7).alias("hits"))
    return J.correction_statistics(c)


@query(
    "printed_labels",
    """WITH p AS (SELECT source AS job, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, doc_id AS page, CASE WHEN doc_id % 3 = 0 THEN n_chars % 4 END AS more FROM documents),
v AS (SELECT job, more + 10 AS off, count(*) AS v, min(i) AS fst FROM p WHERE more IS NOT NULL GROUP BY ALL),
b AS (SELECT job, arg_max(off, v * 1000000 - fst) AS base, max(v) AS votes FROM v GROUP BY job)
SELECT job, page, (CASE WHEN votes >= 2 THEN base ELSE 1 END + i)::VARCHAR AS label FROM p LEFT JOIN b USING (job)""",
)
def printed_labels(spark, d):
    """A source is a book, a document a page; each third has a printed number, which is right, or up to three too high."""
    w = Window.partitionBy("source").orderBy("doc_id")
    p = table(spark, d, "documents").select("source", "doc_id", "n_chars", (F.row_number().over(w) + 9).alias("n"))
    pages = p.select(F.col("source").alias("job"), F.col("doc_id").alias("page"), F.when(F.col("doc_id") % 3 == 0, (F.col("n") + F.col("n_chars") % 4).cast("string")).alias("printed"))
    blocks = pages.select("job", "page", F.lit(0).alias("idx"), F.lit(None).cast("string").alias("text"))
    toc = pages.limit(0).select("job", "page", F.lit(0).alias("ord"), F.lit(1).alias("level"), F.lit("").alias("title"))
    return FM.printed_labels(pages, blocks, toc).select("job", "page", "label")


@query("block_markup")
def block_markup(spark, d):
    """Every document as one block: its kind, and a digest of its markup."""
    b = TS.block_markup(table(spark, d, "documents").select("doc_id", "text"))
    return b.select("doc_id", "kind", F.md5("markup").alias("h"))


@query("edition_lines")
def edition_lines(spark, d):
    """Turns of a conversation as lines of three editions: all, those of the user, those of the assistant moved up by one."""
    t = table(spark, d, "conversations").select(F.col("conv_id").alias("job"), F.lit(1).alias("page"), F.col("turn").alias("idx"), "role", "text")
    other = t.where("role = 'assistant'").withColumn("idx", F.col("idx") - 1)
    lines = ED.aligned(t, t.where("role = 'user'").withColumn("text", F.upper("text")), other, ["job", "page", "idx"])
    p = ED.edition_pages(lines)
    return p.select("job", "edition", F.md5("markup").alias("h"))


@query("markdown_parse")
def markdown_parse(spark, d):
    p = table(spark, d, "conversations").select(F.lit("all").alias("job"), F.concat_ws("/", "conv_id", "turn").alias("page"), F.concat(F.lit("# "), "role", F.lit("\n\n"), "text").alias("text"))
    return D.markdown_blocks(p).groupBy("page", "type").agg(F.count("*").alias("n"))


@query("ocr_similarity")
def ocr_similarity(spark, d):
    b = table(spark, d, "benchmark").select("item_id", "text")
    other = b.select((F.col("item_id") + 1).alias("item_id"), F.col("text").alias("other"))
    return b.join(other, "item_id").select("item_id", F.round(similarity(F.col("text"), F.col("other")), 6).alias("ratio"))


@query("token_alignment")
def token_alignment(spark, d):
    b = table(spark, d, "benchmark").select("item_id", "text")
    noisy = F.transform(F.split("text", r"\s+"), lambda w, i: F.when(i % 5 == 0, F.concat(w, F.lit("x"))).otherwise(w))
    m = b.select("item_id", A.token_corrections(noisy, F.col("text")).alias("m"))
    return m.select("item_id", F.size("m").alias("corrections"))


def _canon(spark, d):
    """The names of parts are canonical texts, in order of their keys; a book is 200 parts, a page ten."""
    p = table(spark, d, "part").select(F.floor(F.col("p_partkey") / 200).alias("job"), F.col("p_partkey").alias("key"), "p_brand", F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("text"))
    return A.places(p, ["job"], "key", "ord").withColumns({"page": F.floor(F.col("ord") / 10), "ref": F.concat_ws(".", F.col("job") + 1, F.floor(F.col("ord") / 10) + 1, F.col("ord") + 1)})


@query("canonical_align")
def canonical_align(spark, d):
    """Headings are the texts, each fourth read backwards; each tenth names its reference."""
    c = _canon(spark, d)
    heading = F.when(F.col("ord") % 10 == 9, F.concat("ref", F.lit(" "), "text")).when(F.col("ord") % 4 == 3, F.reverse("text")).otherwise(F.col("text"))
    blocks = c.select("job", "page", F.col("ord").alias("idx"), F.lit("h2").alias("type"), heading.alias("text"))
    a = A.align_canonical(S.entries(blocks), c, c.select("job", F.col("ref").alias("key"), "ord"))
    return a.select("job", "page", "entry", "ref", "ord")


@query("stream_alignment")
def stream_alignment(spark, d):
    """``canonical_align`` as a stream over the file, run to its end."""
    c = _canon(spark, d)
    parts = spark.readStream.schema(table(spark, d, "part").schema).option("pathGlobFilter", "part.parquet").parquet(d)
    text, key = F.concat_ws(" ", "p_name", "p_type", "p_brand"), F.col("p_partkey")
    lines = parts.select(F.floor(key / 200).alias("job"), F.floor(key % 200 / 10).alias("page"), (key % 200).alias("idx"), (key % 200).alias("entry"), F.when(key % 4 == 3, F.reverse(text)).otherwise(text).alias("heading"), F.lit("").alias("body"))
    with ST.rocksdb(spark):
        q = G.to_table(ST.canonical_stream(lines, c, c.select("job", F.col("ref").alias("key"), "ord")), "stream_alignment_out", "append", G.checkpoint_folder(spark))
        q.awaitTermination()
    return spark.table("stream_alignment_out").select("job", "page", "entry", "ref", "ord")


@query("canonical_coverage")
def canonical_coverage(spark, d):
    """Without named references the cursor stays at the first text that no heading is like."""
    c = _canon(spark, d)
    blocks = c.select("job", "page", F.col("ord").alias("idx"), F.lit("h2").alias("type"), "text").where("ord % 50 <> 49")
    return A.coverage(A.align_canonical(S.entries(blocks), c, c.select("job", F.col("ref").alias("key"), "ord")), c)


@query("windowed_align")
def windowed_align(spark, d):
    """Roots are the texts in two classes, their lines the texts with each third read backwards."""
    c = _canon(spark, d).withColumn("class", (F.col("ord") / 100).cast("int") + 1)
    roots = c.select("job", F.col("ord").cast("int").alias("ord"), "class", F.col("ord").alias("id"), F.lit("").alias("root"), F.lit("").alias("meaning"), F.split_part("text", F.lit(" "), F.lit(1)).alias("iast_root"), F.col("text").alias("iast_meaning"))
    lines = c.select("job", "page", F.col("ord").alias("idx"), "class", F.when(F.col("ord") % 3 == 0, F.reverse("text")).otherwise(F.col("text")).alias("text"))
    full = A.fill_unmatched(roots, A.align_windowed(lines, roots))
    return full.select("job", "id", "page", "interpolated", F.round("match_confidence", 3).alias("match_confidence"))


def _images(spark, d):
    e = table(spark, d, "embeddings").where("embedding is not null")
    grey = F.transform("embedding", lambda v: F.least(F.greatest(F.round(v * 127 + 128), F.lit(0)), F.lit(255)).cast("int"))
    return e.select("vec_id", F.unhex(F.array_join(F.transform(grey, lambda g: F.lpad(F.hex(g), 2, "0")), "")).alias("data"), F.lit(8).alias("h"), (F.size("embedding") / 8).cast("int").alias("w"), F.lit("L").alias("mode"))


@query("image_stats")
def image_stats(spark, d):
    i = _images(spark, d)
    return i.select("vec_id", I.page_stats("data", "h", "w", "mode").alias("s")).select("vec_id", "s.is_color", "s.rules", "s.margin_ink")


@query("image_restore")
def image_restore(spark, d):
    i = _images(spark, d)
    return i.select("vec_id", F.octet_length(I.restored("data", "h", "w", "vec_id")).alias("bytes"))


@query(
    "stream_gate",
    """SELECT user_id AS page, count(value) AS word_count, round(avg(value), 3) AS mean_confidence, round(avg(value), 3) >= 40 AS passed,
  CASE WHEN round(avg(value), 3) >= 40 THEN 'pass' ELSE 'fallback' END AS decision FROM events WHERE value >= 0 GROUP BY user_id""",
)
def stream_gate(spark, d):
    """The gate as a stream over the file, run to its end; its last state is the batch result."""
    e = table(spark, d, "events")
    s = spark.readStream.schema(e.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    w = s.where(F.col("value") >= 0).select(F.col("user_id").alias("page"), F.col("value").alias("conf"))
    q = G.to_table(G.running_gate(w, 40.0), "stream_gate_out", "complete", G.checkpoint_folder(spark))
    q.awaitTermination()
    return spark.table("stream_gate_out")
