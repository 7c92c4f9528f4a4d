"""Page cleaning: blocks (job, page, idx, type, text) in, fewer blocks and printed page numbers out.

``idx`` and the number of blocks of a page are those before any filter.  All windows share the
partitioning by (job, page), so the chain costs one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiremill.functions import text as X

PAGE = ["job", "page"]
FOLIO = r"^[-–—\[(]?\s*\d{1,4}\s*[-–—\])]?$"
SECTION_NUMBER = r"(?iU)^[\[(]\s*([०-९\d]+|[ivxlcdm]+)\s*[\])]$"
#: Languages in which CJK characters are expected.
CJK_LANGUAGES = "chi|zho|zh|kor|jpn"
RUNNING_HEADER = r"(?i)^(?:LESSON\s+[A-Z0-9]+|CHAPTER\s+[A-Z0-9]+|INTRODUCTION|CONTENTS|INDEX(?:\s+OF\s+[A-Z\s]+)?|APPENDIX(?:\s+[A-Z0-9]+)?|GLOSSARY|ANSWERS\s+TO\s+EXERCISES|TABLES)$"
NOTE_MARKER = r"^\s*(?:[⁰¹²³⁴⁵⁶⁷⁸⁹]+|\^?\[?\d{1,2}\]?\)|\*{1,3}|†)\s*\S"


def repetition_filter(blocks: DataFrame, by: list[str], text: str = "text", order: str = "idx", keep: int = 3) -> DataFrame:
    """The first ``keep`` occurrences of a text in its group."""
    w = Window.partitionBy(*by, text).orderBy(order)
    n = "_occurrence"
    return blocks.withColumn(n, F.row_number().over(w)).where(F.col(n) <= keep).drop(n)


def clean_page_artifacts(blocks: DataFrame, language: str = "", strip_boilerplate: bool = False, strip_rogue: bool = False) -> DataFrame:
    """Without blank, hallucinated, boilerplate, off-script, looping and folio blocks.

    Adds ``printed_page``, the number of the page's first folio, to every block that stays; see
    ``printed_pages`` for pages that lose all blocks.
    """
    return _marked(blocks, language, strip_boilerplate, strip_rogue).where(~F.col("is_folio")).drop("is_folio", "n_blocks")


def printed_pages(blocks: DataFrame, **how) -> DataFrame:
    """(job, page, printed_page) of all pages with a folio."""
    marked = _marked(blocks, **how).where("is_folio")
    return marked.select(*PAGE, "printed_page").distinct()


def _marked(blocks: DataFrame, language: str = "", strip_boilerplate: bool = False, strip_rogue: bool = False) -> DataFrame:
    page = Window.partitionBy(*PAGE)
    b = blocks.withColumns({"n_blocks": F.count("*").over(page), "_prev": F.lag("type").over(page.orderBy("idx")), "text": X.strip(F.col("text"))})
    keep = (F.col("text") != "") & ~X.is_hallucination(F.col("text"))
    if strip_boilerplate:
        keep = keep & ~X.is_boilerplate(F.col("text"))
    b = b.where(keep)
    if strip_rogue:
        b = b.withColumn("text", X.strip_rogue_scripts(F.col("text"))).where("text <> ''")
    if not any(x in language.lower() for x in CJK_LANGUAGES.split("|")):
        b = b.where(X.cjk_ratio(F.col("text")) <= 0.15)
    b = repetition_filter(b, PAGE)
    header_number = F.coalesce(F.col("_prev").isin("h1", "h2"), F.lit(False)) & F.col("text").rlike(SECTION_NUMBER)
    at_edge = (F.col("idx") <= 1) | (F.col("idx") >= F.greatest(F.lit(0), F.col("n_blocks") - 2))
    folio = F.col("text").rlike(FOLIO) & ~header_number & at_edge
    number = F.when(folio, F.regexp_extract("text", r"\d{1,4}", 0))
    first = F.min_by(number, F.when(folio, F.col("idx"))).over(page)
    return b.withColumns({"is_folio": folio, "printed_page": first}).drop("_prev")


def strip_running_headers(blocks: DataFrame, chapter_pages: DataFrame | None = None) -> DataFrame:
    """Without the leading header of each page: a label and a header, or a header alone.

    On pages in ``chapter_pages`` up to two leading header blocks are left out.
    """
    w = Window.partitionBy(*PAGE).orderBy("idx")
    b = blocks.withColumns({"_rank": F.row_number().over(w), "_header": F.col("text").rlike(RUNNING_HEADER), "_label": F.col("text").rlike(r"^(?:\d{1,4}|(?i:[ivxlcdm]{1,7}))$")})
    second = F.max(F.when(F.col("_rank") == 2, F.col("_header"))).over(Window.partitionBy(*PAGE))
    first_label = F.max(F.when(F.col("_rank") == 1, F.col("_label"))).over(Window.partitionBy(*PAGE))
    pair = F.coalesce(first_label & second, F.lit(False))
    drop = ((F.col("_rank") <= 2) & pair) | ((F.col("_rank") == 1) & F.col("_header"))
    if chapter_pages is not None:
        b = b.join(F.broadcast(chapter_pages.select(*PAGE, F.lit(True).alias("_chapter")).distinct()) if chapter_pages.count() < 100_000 else chapter_pages.select(*PAGE, F.lit(True).alias("_chapter")).distinct(), PAGE, "left")
        drop = drop | (F.coalesce("_chapter", F.lit(False)) & (F.col("_rank") <= 2) & F.col("_header"))
    return b.withColumn("_drop", drop).where(~F.col("_drop")).select(*blocks.columns)


def split_footnotes(blocks: DataFrame) -> DataFrame:
    """Adds ``is_footnote``: from the first note marker within the last four blocks on."""
    w = Window.partitionBy(*PAGE)
    n = F.count("*").over(w)
    marker = F.col("text").rlike(NOTE_MARKER) & (F.col("idx") >= n - 4) & (F.col("idx") >= 1)
    first = F.min(F.when(F.col("_marker"), F.col("idx"))).over(w)
    return blocks.withColumn("_marker", marker).withColumn("is_footnote", F.coalesce(F.col("idx") >= first, F.lit(False))).drop("_marker")


def is_noise_token(w: Column) -> Column:
    """Tokens that are OCR noise: empty, runs of a character, dots, symbols, short mixtures with digits."""
    return (
        (w == "")
        | w.rlike(r"(\S)\1{2,}")
        | w.contains("..")
        | w.rlike(r"(?U)^[\W\d_]+$")
        | ((F.length(w) <= 4) & w.rlike(r"[ऀ-ॿ]") & w.rlike(r"[0-9]"))
    )


def content_blocks(blocks: DataFrame, header: float = 0.04, footer: float = 0.96, least_width: float = 2.0) -> DataFrame:
    """Text blocks of two characters and more between the header and footer bands of their page."""
    ok = (F.col("block_type") == 0) & (F.length(X.strip(F.col("text"))) >= 2)
    inside = (F.col("y1") >= F.col("page_h") * header) & (F.col("y0") <= F.col("page_h") * footer)
    return blocks.where(ok & inside & (F.col("x1") - F.col("x0") >= least_width))


def edge_words(words: DataFrame, side: float = 0.03, end: float = 0.02) -> DataFrame:
    """Words that don't touch the page's outer bands."""
    return words.where((F.col("x0") >= F.col("page_w") * side) & (F.col("x1") <= F.col("page_w") * (1 - side)) & (F.col("y0") >= F.col("page_h") * end) & (F.col("y1") <= F.col("page_h") * (1 - end)))


def crop_bands(blocks: DataFrame, top: float = 36, bottom: float = 538) -> DataFrame:
    """Without running headers and footers by position."""
    return blocks.where((F.col("y1") >= top) & (F.col("y0") <= bottom))


def route_columns(blocks: DataFrame, gap: float = 0.1) -> DataFrame:
    """Adds ``column``: 0 spanning, 1 left, 2 right; by the block's middle and width."""
    mid, width = (F.col("x0") + F.col("x1")) / 2, F.col("x1") - F.col("x0")
    spans = (width > F.col("page_w") * 0.6) | (F.abs(mid - F.col("page_w") / 2) < F.col("page_w") * gap / 2)
    return blocks.withColumn("column", F.when(spans, 0).when(mid < F.col("page_w") / 2, 1).otherwise(2))


def security_scan(files: DataFrame, rules: DataFrame, allow: str | None = None) -> DataFrame:
    """(file, line, rule, severity, matched): first match of each rule per line.

    ``files``: (file, text); ``rules``: (rule, pattern, severity), a small table that is checked to
    be so.  Lines that match ``allow`` are skipped.
    """
    if rules.count() > 1000:
        raise ValueError("more than 1000 rules")
    lines = files.select("file", F.posexplode(X.split_lines(F.col("text"))).alias("i", "content"))
    if allow:
        lines = lines.where(~F.col("content").rlike(allow))
    found = lines.join(F.broadcast(rules), F.expr("content rlike pattern"))
    return found.select("file", (F.col("i") + 1).alias("line"), "rule", "severity", F.expr("regexp_substr(content, pattern)").alias("matched"))


def forbidden_files(files: DataFrame, patterns: list[str]) -> DataFrame:
    name = F.element_at(F.split("file", "/"), -1)
    return files.where(name.rlike("|".join(f"(?:{p})" for p in patterns)))
