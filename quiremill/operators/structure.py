"""Structure of a book from its blocks: contents, sections, labels, entries, notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiremill.functions import text as X


def toc_from_headings(blocks: DataFrame, job: str = "job", longest: int = 80) -> DataFrame:
    """(job, ord, level, title, page): h1 and h2 of at most ``longest`` characters, no title twice in a row."""
    h = blocks.where(F.col("type").isin("h1", "h2")).select(job, "page", "idx", F.when(F.col("type") == "h1", 1).otherwise(2).alias("level"), X.collapse(F.col("text")).alias("title"))
    h = h.where((F.col("title") != "") & (F.length("title") <= longest))
    w = Window.partitionBy(job).orderBy("page", "idx")
    h = h.withColumn("_prev", F.lag(F.lower("title")).over(w)).where(~F.lower("title").eqNullSafe(F.col("_prev")))
    return h.select(job, F.row_number().over(w).alias("ord"), "level", "title", "page")


def normalize_levels(toc: DataFrame, job: str = "job") -> DataFrame:
    """Levels from 1, each at most one deeper than the one before.

    Closed form of the fold: ``i + min(raw - i)`` over the entries so far, the first counting as 1.
    """
    w = Window.partitionBy(job).orderBy("ord")
    i = F.row_number().over(w) - 1
    t = toc.withColumn("_i", i).withColumn("_raw", F.when(F.col("_i") == 0, 1).otherwise(F.greatest("level", F.lit(1))))
    level = F.col("_i") + F.min(F.col("_raw") - F.col("_i")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return t.withColumn("level", level.cast("int")).drop("_i", "_raw")


def toc_text(toc: DataFrame, job: str = "job") -> DataFrame:
    """(job, text): one line an entry, two blanks a level, `` | `` and the page."""
    line = F.concat(F.expr("repeat('  ', level - 1)"), F.col("title"), F.lit(" | "), F.col("page").cast("string"))
    return toc.select(job, "ord", line.alias("line")).groupBy(job).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "line"))), lambda x: x.line), "\n").alias("text"))


def valid_toc(toc: DataFrame, total_pages: Column) -> DataFrame:
    return toc.where(F.col("page").between(F.lit(1), total_pages))


def sections(rows: DataFrame, opens: Column, by: list[str], order: list[str], name: str = "section") -> DataFrame:
    """Adds the number of section openers so far; 0 before the first."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.coalesce(F.sum(opens.cast("int")).over(w), F.lit(0)))


def entries(blocks: DataFrame, delimiter: str = r"॥\s*[०-९\d]+\s*॥|\|\|\s*\d+\s*\|\|") -> DataFrame:
    """Headings (or blocks with a delimiter) with the text that follows on their page.

    (job, page, entry, idx, heading, body); text before a page's first heading is entry 0 without
    heading.
    """
    b = blocks.where(F.trim("text") != "")
    opens = F.col("type").startswith("h") | F.col("text").rlike(delimiter)
    s = sections(b.withColumn("_opens", opens), F.col("_opens"), ["job", "page"], ["idx"], "entry")
    body = F.transform(F.sort_array(F.collect_list(F.when(~F.col("_opens"), F.struct("idx", "text")))), lambda x: x.text)
    return s.groupBy("job", "page", "entry").agg(F.min("idx").alias("idx"), F.coalesce(F.max(F.when(F.col("_opens"), F.col("text"))), F.lit("")).alias("heading"), F.array_join(body, "\n").alias("body"))


def carry_forward(rows: DataFrame, value: str, by: list[str], order: list[str], name: str, default=None) -> DataFrame:
    """The last known value at or before each row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = F.last(value, ignorenulls=True).over(w)
    return rows.withColumn(name, out if default is None else F.coalesce(out, F.lit(default)))


def gap_merge(rows: DataFrame, start: str, end: str, by: list[str], most: float) -> DataFrame:
    """Adds ``island``: rows whose start is within ``most`` of the end of the row before belong together."""
    w = Window.partitionBy(*by).orderBy(start, end)
    new = F.coalesce(F.col(start) - F.lag(end).over(w) > most, F.lit(True))
    return rows.withColumn("_new", new.cast("int")).withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def merge_sideheads(fragments: DataFrame, gap: float = 16.0) -> DataFrame:
    """Side-heads of a page whose fragments stand within ``gap``: box and text joined by line."""
    g = gap_merge(fragments, "y0", "y1", ["job", "page"], gap)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("y0", "text"))), lambda x: x.text), "\n")
    return g.groupBy("job", "page", "island").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), text.alias("text"))


def offset_mode(rows: DataFrame, offset: str, by: list[str], order: str, least_votes: int = 2) -> DataFrame:
    """The most frequent positive offset with enough votes; of equal ones the first seen."""
    counts = rows.where(F.col(offset).isNotNull()).groupBy(*by, offset).agg(F.count("*").alias("votes"), F.min(order).alias("_first"))
    best = counts.groupBy(*by).agg(F.max_by(F.struct(offset, "votes"), F.struct("votes", (-F.col("_first")).alias("f"))).alias("b"))
    return best.select(*by, F.col("b")[offset].alias(offset), F.col("b.votes").alias("votes")).where((F.col("votes") >= least_votes) & (F.col(offset) > 0))


def page_labels(pages: DataFrame) -> DataFrame:
    """(job, idx, label) of pages (job, idx, printed_page, roman, body_start).

    Printed numbers that agree give all labels, in Devanagari if any number is; else body pages
    count from ``body_start`` and front matter takes Roman numerals, filled in from the nearest
    known one behind and then before.  The first three front pages stay without.
    """
    num = X.multiscript_number(F.col("printed_page"))
    p = pages.withColumns({"_num": num, "_deva": F.col("printed_page").rlike(f"[{X.DEVANAGARI_DIGITS}]")})
    base = offset_mode(p.withColumn("_off", F.when(F.col("_num") > 0, F.col("_num") - F.col("idx"))), "_off", ["job"], "idx")
    deva = p.groupBy("job").agg(F.coalesce(F.bool_or("_deva"), F.lit(False)).alias("_is_deva"))
    p = p.join(base, "job", "left").join(deva, "job")
    front = F.col("idx") < F.col("body_start") - 1
    w = Window.partitionBy("job", front).orderBy("idx")
    value = F.when(front & (F.col("roman") != ""), X.from_roman(F.col("roman")))
    behind = w.rowsBetween(0, Window.unboundedFollowing)
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    known = F.when(value.isNotNull(), F.struct("idx", value.alias("v")))
    p = p.withColumns({"_next": F.first(known, ignorenulls=True).over(behind), "_prev": F.last(known, ignorenulls=True).over(before)})
    back = F.col("_next.v") - (F.col("_next.idx") - F.col("idx"))
    ahead = F.col("_prev.v") + (F.col("idx") - F.col("_prev.idx"))
    roman = F.when(F.col("roman") != "", F.lower("roman")).when(back > 0, X.to_roman(back)).when(ahead > 0, X.to_roman(ahead)).otherwise("")
    printed = (F.col("_off") + F.col("idx")).cast("string")
    label = (
        F.when(F.col("_off").isNotNull(), F.when(F.col("_is_deva"), X.to_devanagari_digits(printed)).otherwise(printed))
        .when(~front, (F.col("idx") - F.col("body_start") + 2).cast("string"))
        .when(F.col("idx") < 3, "")
        .otherwise(roman)
    )
    return p.select("job", "idx", label.alias("label"))


def labels_from_ranges(pages: DataFrame, ranges: DataFrame) -> DataFrame:
    """(job, page, label) from ranges (job, startpage, prefix, style, firstpagenum), style r, D or none.

    As-of join without a range join: ranges and pages are one ordered sequence, and the last range
    start is carried forward.
    """
    r = ranges.select("job", F.col("startpage").alias("page"), F.struct("startpage", F.coalesce("prefix", F.lit("")).alias("prefix"), "style", F.coalesce("firstpagenum", F.lit(1)).alias("n")).alias("r"), F.lit(0).alias("kind"))
    p = pages.select("job", "page", F.lit(None).cast(r.schema["r"].dataType).alias("r"), F.lit(1).alias("kind"))
    w = Window.partitionBy("job").orderBy("page", "kind").rowsBetween(Window.unboundedPreceding, 0)
    x = r.unionByName(p).withColumn("r", F.last("r", ignorenulls=True).over(w)).where("kind = 1")
    n = F.col("r.n") + F.col("page") - F.col("r.startpage")
    number = F.when(F.col("r.style") == "r", X.to_roman(n)).when(F.col("r.style") == "D", n.cast("string")).otherwise("")
    return x.select("job", "page", F.coalesce(F.concat("r.prefix", number), F.col("page").cast("string")).alias("label"))


def running_class(lines: DataFrame, patterns: list[tuple[int, str]]) -> DataFrame:
    """Adds ``class``: the largest class whose colophon stands on this or an earlier page; 1 at first."""
    found = F.greatest(*[F.when(F.col("text").rlike(p), n).otherwise(1) for n, p in patterns], F.lit(1))
    pages = lines.groupBy("job", "page").agg(F.max(found).alias("_c"))
    w = Window.partitionBy("job").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    return lines.join(pages.withColumn("class", F.max("_c").over(w)).drop("_c"), ["job", "page"])


def first_match_in_range(pages: DataFrame, ranges: DataFrame, default: int | None = None, width: int = 64) -> DataFrame:
    """(job, name, page): first page from ``s`` to ``e`` whose text fits ``pattern``, else ``fallback``, else the default.

    ``ranges``: (job, name, s, e, pattern, fallback).  Pages and ranges meet in bins of ``width`` pages, a range in each bin that
    it touches, so a job's pages are dealt over its bins and a page meets the ranges near it only.
    """
    bins = F.sequence(F.floor(F.col("s") / width), F.floor(F.col("e") / width))
    near = ranges.where("s <= e").select("*", F.explode(bins).alias("_bin"))
    hit = pages.withColumn("_bin", F.floor(F.col("page") / width)).join(near, ["job", "_bin"]).where(F.col("page").between(F.col("s"), F.col("e")))
    hit = hit.groupBy("job", "name").agg(F.min(F.when(F.expr("text rlike pattern"), F.col("page"))).alias("strict"), F.min(F.when(F.expr("text rlike fallback"), F.col("page"))).alias("loose"))
    out = ranges.select("job", "name").join(hit, ["job", "name"], "left")
    return out.select("job", "name", F.coalesce("strict", "loose", F.lit(default).cast("int")).alias("page"))


def glyph_pairs(blocks: DataFrame, least: int = 2) -> DataFrame:
    """Label and image blocks that alternate: (job, page, run, label, image_id), runs of ``least`` and more."""
    w = Window.partitionBy("job", "page").orderBy("idx")
    b = blocks.withColumns({"_next_type": F.lead("type").over(w), "image_id": F.lead("image_id").over(w)})
    b = b.where((F.col("type") != "image") & (F.col("_next_type") == "image") & (F.length("text") <= 12))
    b = gap_merge(b.withColumn("_e", F.col("idx")), "idx", "_e", ["job", "page"], 2).withColumnRenamed("island", "run")
    b = b.withColumn("_n", F.count("*").over(Window.partitionBy("job", "page", "run")))
    return b.where(F.col("_n") >= least).select("job", "page", "run", "idx", F.col("text").alias("label"), "image_id")


def accumulate(rows: DataFrame, opens: Column, by: list[str], order: str, text: str = "text", sep: str = " ") -> DataFrame:
    """Items with the lines that run on from them: (by, item, order, text); lines before the first are item 0.

    Lists, footnotes and syllabus groups are this with their own sign of a beginning.
    """
    s = sections(rows, opens, by, [order], "item")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))), lambda x: x.t), sep)
    return s.groupBy(*by, "item").agg(F.min(order).alias(order), joined.alias(text))


def merge_toc_lines(lines: DataFrame, by: list[str], order: str = "idx") -> DataFrame:
    """Lines of contents without a page number joined to the next one that has one."""
    ends = F.col("text").rlike(r"\d+\s*$")
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    n = F.coalesce(F.sum(ends.cast("int")).over(before), F.lit(0))
    g = lines.withColumn("_item", n)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.trim("text").alias("t")))), lambda x: x.t), " ")
    return g.groupBy(*by, "_item").agg(F.min(order).alias(order), text.alias("text")).drop("_item")


def text_boxes(words: DataFrame, images: DataFrame) -> DataFrame:
    """Images (job, page, ...) with the box of their page's words, null without words."""
    box = words.groupBy("job", "page").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    return images.join(box, ["job", "page"], "left")


def with_crops(blocks: DataFrame, crops: DataFrame) -> DataFrame:
    """Blocks with the extracted image (job, page, image_id, path) that they name."""
    return blocks.join(crops.select("job", "page", "image_id", F.col("path").alias("crop")).dropDuplicates(["job", "page", "image_id"]), ["job", "page", "image_id"], "left")


def distinct_tokens(words: DataFrame, by: list[str], most: int = 100) -> DataFrame:
    """The first ``most`` distinct tokens of each group in order: the template of a correction list."""
    return words.groupBy(*by).agg(F.slice(F.sort_array(F.collect_set("text")), 1, most).alias("tokens"))
