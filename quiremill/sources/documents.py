"""Readers of OCR output: hOCR, TSV, vision JSON, Markdown, plain text; and which of them a page uses."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiremill.functions import text as X

VISION_SCHEMA = (
    "source string, model string, markdown string, pages array<struct<index: int, markdown: string, "
    "dimensions: struct<dpi: int, width: double, height: double>, "
    "blocks: array<struct<type: string, content: string, top_left_x: double, top_left_y: double, bottom_right_x: double, bottom_right_y: double, image_id: string>>, "
    "images: array<struct<id: string, top_left_x: double, top_left_y: double, bottom_right_x: double, bottom_right_y: double>>>>"
)
WORDS_SCHEMA = "job string, page string, idx int, id string, text string, conf double, x0 int, y0 int, x1 int, y1 int"
BLOCKS_SCHEMA = "job string, page string, idx int, type string, text string, bbox array<int>, image_id string"
#: Suffixes of a page's files, best source first.
SOURCES = [(".json", 1), (".md", 2), (".corrected.hocr", 3), (".hocr", 4), (".txt", 5)]


def discover(spark: SparkSession, path: str) -> DataFrame:
    """(job, stem, path, kind, prio, length, rank): files under ``path/<job>/``; the rank counts a job's stems by name.

    Only metadata is read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    job = F.element_at(F.split("path", "/"), -2)
    kind = F.lit(None).cast("string")
    prio = F.lit(None).cast("int")
    for suffix, p in reversed(SOURCES):
        kind, prio = F.when(name.endswith(suffix), suffix).otherwise(kind), F.when(name.endswith(suffix), p).otherwise(prio)
    # the longest suffix wins whatever its place
    f = files.select(job.alias("job"), "path", "length", F.when(name.endswith(".corrected.hocr"), ".corrected.hocr").otherwise(kind).alias("kind"), F.when(name.endswith(".corrected.hocr"), 3).otherwise(prio).alias("prio"), name.alias("name"))
    f = f.where("kind is not null").withColumn("stem", F.expr("left(name, length(name) - length(kind))")).drop("name")
    return f.withColumn("rank", F.dense_rank().over(Window.partitionBy("job").orderBy("stem")))


def content_kind(name: Column, text: Column) -> Column:
    """hocr, tsv or either (to be tried as TSV, then as hOCR) for a file of word confidences: by suffix, else by what its text shows."""
    lower = F.lower(name)
    sniffed = text.contains("ocrx_word") | text.contains("x_wconf") | F.lower(text).contains("<html")
    table = text.contains("\t") & F.lower(F.regexp_extract(text, r"^([^\r\n]*)", 1)).contains("conf")
    return F.when(lower.endswith(".tsv"), "tsv").when(lower.rlike(r"\.(hocr|html|xml)$"), "hocr").when(sniffed, "hocr").when(table, "tsv").otherwise("either")


def best_source(candidates: DataFrame, by: list[str], prio: str = "prio", inherit: str | None = None) -> DataFrame:
    """The candidate of least ``prio`` per group; ``inherit`` is taken from the next that has it."""
    w = Window.partitionBy(*by).orderBy(prio)
    c = candidates
    if inherit:
        c = c.withColumn(inherit, F.first(inherit, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    return c.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def read_tsv_words(lines: DataFrame) -> DataFrame:
    """Words of TSV lines (job, page, n, line): 12 cells and more, confidence of 0 and more, text not blank.

    Boxes come as left, top, width, height.
    """
    cell = F.split("line", "\t")
    x = lines.select("job", "page", "n", cell.alias("c")).where((F.size("c") >= 12) & (F.get("c", F.lit(0)) != "level"))
    at = lambda i: F.get("c", F.lit(i))
    num = lambda i: at(i).try_cast("int")
    text = F.array_join(F.slice("c", 12, 1 << 20), "\t")
    w = x.select("job", "page", "n", at(10).try_cast("double").alias("conf"), text.alias("text"), num(6).alias("x0"), num(7).alias("y0"), (num(6) + num(8)).alias("x1"), (num(7) + num(9)).alias("y1"))
    w = w.where((F.col("conf") >= 0) & (X.strip(F.col("text")) != ""))
    idx = F.row_number().over(Window.partitionBy("job", "page").orderBy("n")) - 1
    return w.select("job", "page", idx.cast("int").alias("idx"), F.concat(F.lit("tsv_"), idx.cast("string")).alias("id"), "text", "conf", "x0", "y0", "x1", "y1")


def tsv_confidences(lines: DataFrame) -> DataFrame:
    """(job, page, conf): the cell at 10, or the last but one where a row has more than 12 cells."""
    c = F.split("line", "\t")
    conf = F.when(F.size(c) > 12, F.get(c, F.size(c) - 2)).otherwise(F.get(c, F.lit(10))).try_cast("double")
    return lines.where((F.size(c) >= 12) & ~F.col("line").startswith("level")).select("job", "page", conf.alias("conf")).where("conf >= 0")


def hocr_confidences(pages: DataFrame) -> DataFrame:
    """(job, page, conf) from all ``x_wconf`` of an hOCR text, well formed or not."""
    return pages.select("job", "page", F.explode(F.regexp_extract_all("text", F.lit(r"x_wconf\s+(\d+(?:\.\d+)?)"), F.lit(1))).alias("c")).select("job", "page", F.col("c").cast("double").alias("conf"))


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _title(title: str) -> tuple[list[int] | None, float | None]:
    bbox = re.search(r"bbox\s+(-?\d+)\s+(-?\d+)\s+(-?\d+)\s+(-?\d+)", title)
    conf = re.search(r"x_wconf\s+(\d+(?:\.\d+)?)", title)
    return [int(x) for x in bbox.groups()] if bbox else None, float(conf[1]) if conf else None


def hocr_words(pages: DataFrame) -> DataFrame:
    """Words of hOCR texts (job, page, text): elements of class ocrx_word or ocr_word, or spans with a confidence."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for job, page, text in frame.itertuples(index=False):
                try:
                    root = ET.fromstring(text)
                except (ET.ParseError, TypeError):
                    continue
                n = 0
                for e in root.iter():
                    kind, title = e.get("class") or "", e.get("title") or ""
                    if kind in ("ocrx_word", "ocr_word") or _local(e.tag) == "span" and "x_wconf" in title:
                        box, conf = _title(title)
                        rows.append((job, page, n, e.get("id") or f"word_{n}", "".join(e.itertext()).strip(), conf, *(box or [None] * 4)))
                        n += 1
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in WORDS_SCHEMA.split(", ")])

    return pages.select("job", "page", "text").mapInPandas(run, WORDS_SCHEMA)


def hocr_blocks(pages: DataFrame) -> DataFrame:
    """Paragraphs of hOCR texts as blocks; a page without any gives its whole text as one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for job, page, text in frame.itertuples(index=False):
                try:
                    root = ET.fromstring(text)
                except (ET.ParseError, TypeError):
                    continue
                found = [(" ".join("".join(e.itertext()).split()), _title(e.get("title") or "")[0]) for e in root.iter() if e.get("class") == "ocr_par"]
                found = [x for x in found if x[0]] or [(" ".join("".join(root.itertext()).split()), None)]
                rows += [(job, page, i, "p", t, box or [0, 0, 0, 0], None) for i, (t, box) in enumerate(found) if t]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in BLOCKS_SCHEMA.split(", ")])

    return pages.select("job", "page", "text").mapInPandas(run, BLOCKS_SCHEMA)


def vision_blocks(pages: DataFrame, sideheads: DataFrame | None = None) -> DataFrame:
    """Blocks of vision-OCR responses (job, page, json): typed, table rows apart, boxes in whole points.

    Missing fields are null.  ``sideheads`` (job, page, key, text): a block whose letters and digits
    equal a side-head's is of that type.
    """
    j = pages.select("job", "page", F.from_json("json", VISION_SCHEMA).alias("j")).select("job", "page", F.get("j.pages", F.lit(0)).alias("p"))
    b = j.select("job", "page", F.posexplode("p.blocks").alias("src", "b"))
    content = X.dehyphenate(X.strip(F.coalesce("b.content", F.lit(""))))
    box = F.array(*[F.rint(F.coalesce(F.col(f"b.{c}"), F.lit(0.0))).cast("int") for c in ("top_left_x", "top_left_y", "bottom_right_x", "bottom_right_y")])
    b = b.select("job", "page", "src", content.alias("content"), F.lower(F.coalesce("b.type", F.lit("text"))).alias("kind"), box.alias("bbox"), "b.image_id").where("content <> ''")
    if sideheads is not None:
        s = sideheads.select("job", "page", "key", F.col("text").alias("sidehead")).dropDuplicates(["job", "page", "key"])
        b = b.withColumn("key", X.token_key(F.col("content"))).join(s, ["job", "page", "key"], "left")
    else:
        b = b.withColumn("sidehead", F.lit(None).cast("string"))
    lines = F.filter(F.transform(X.split_lines(F.col("content")), X.strip), lambda x: x != "")
    heading = F.col("content").startswith("#") | F.col("kind").isin("title", "header")
    piped = (X.is_table_row(F.col("content")) | F.col("content").contains("\n|")) & F.forall(lines, lambda x: x.startswith("|"))
    as_rows = F.col("sidehead").isNull() & ~heading & ((F.col("kind") == "table") | piped)
    kind = F.when(F.col("sidehead").isNotNull(), "sidehead").when(as_rows, "").otherwise(X.block_type(F.col("content"), F.col("kind")))
    parts = F.when(as_rows, lines).when(F.col("sidehead").isNotNull(), F.array("sidehead")).when(heading, F.array(X.heading_text(F.col("content")))).otherwise(F.array("content"))
    x = b.select("job", "page", "src", "bbox", "image_id", kind.alias("type"), F.posexplode(parts).alias("line", "text"))
    x = x.withColumn("type", F.when(F.col("type") == "", F.when(X.is_table_row(F.col("text")), "table_row").otherwise("p")).otherwise(F.col("type")))
    idx = F.row_number().over(Window.partitionBy("job", "page").orderBy("src", "line")) - 1
    return x.select("job", "page", idx.cast("int").alias("idx"), "type", "text", "bbox", F.when(F.col("type") == "image", F.col("image_id")).alias("image_id"))


_ITEM = re.compile(X.LIST_ITEM)


_HEADING = re.compile(r"(#+)\s+(.+)")


def _line_kind(line: str) -> str:
    if line.startswith("#"):
        return "heading"
    if line.startswith("|") and line.endswith("|"):
        return "row"
    return "item" if _ITEM.match(line) else "text" if line else ""


def _glued(a: str, b: str) -> str:
    """Two lines of a paragraph as one; a hyphen between letters goes."""
    return a[:-1] + b if a[-1:] == "-" and a[-2:-1].isalpha() and b[0].isalpha() else f"{a} {b}"


def _block(kind: str, lines: list[str]) -> tuple[str, str]:
    if kind == "heading":
        m = _HEADING.fullmatch(lines[0])
        return (f"h{len(m[1])}", m[2].strip()) if m else ("h1", lines[0].lstrip("#").strip())
    return ("table_row" if kind == "row" else "p"), reduce(_glued, lines)


def parse_markdown(text: str, sideheads: dict[str, str] | None = None) -> list[tuple[str, str]]:
    """(type, text) of the blocks of a Markdown page.

    Lines are classified one by one and blocks are islands of them: each run of text lines is a
    paragraph, any other line a block.  One to four lines whose letters and digits equal a
    side-head's key are that side-head, the fewest that do; one of four lines doesn't end a paragraph.
    """
    lines = [x.strip() for x in text.splitlines()]
    letters = [re.sub("[^a-zA-Z0-9]", "", x).lower() for x in lines]
    spans: dict[int, int] = {}  # first line of a possible side-head: its number of lines
    if sideheads:
        for size in (4, 3, 2, 1):
            spans |= {i: size for i in range(len(lines) - size + 1) if lines[i] and "".join(letters[i : i + size]) in sideheads}
    kinds = [_line_kind(x) for x in lines]
    island: list[int] = []  # of each line the first line of its block
    for i, kind in enumerate(kinds):
        last = island[-1] if i else 0
        if i and kinds[last] == "head":
            if i < last + spans[last]:
                island.append(last)
                continue
        runs_on = i > 0 and kind == "text" == kinds[i - 1] and kinds[last] == "text"
        if i in spans and not (runs_on and spans[i] == 4):
            kinds[i], runs_on = "head", False
        island.append(last if runs_on else i)
    out = []
    for first, group in groupby(range(len(lines)), island.__getitem__):
        rows = list(group)
        if kinds[first] == "head":
            out.append(("sidehead", sideheads["".join(letters[i] for i in rows)]))
        elif kinds[first]:
            out.append(_block(kinds[first], [lines[i] for i in rows]))
    return out


def markdown_blocks(pages: DataFrame, sideheads: DataFrame | None = None) -> DataFrame:
    """Blocks of Markdown pages (job, page, text)."""
    src = pages.select("job", "page", "text")
    if sideheads is not None:
        s = sideheads.groupBy("job", "page").agg(F.collect_list(F.struct("key", F.col("text").alias("value"))).alias("heads"))
        src = src.join(s, ["job", "page"], "left")
    else:
        src = src.withColumn("heads", F.lit(None).cast("array<struct<key: string, value: string>>"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for job, page, text, heads in frame.itertuples(index=False):
                known = {h["key"]: h["value"] for h in heads} if heads is not None else None
                rows += [(job, page, i, t, x, [0, 0, 0, 0], None) for i, (t, x) in enumerate(parse_markdown(text or "", known))]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in BLOCKS_SCHEMA.split(", ")])

    return src.mapInPandas(run, BLOCKS_SCHEMA)


def plain_blocks(pages: DataFrame) -> DataFrame:
    """A plain text as one paragraph."""
    t = X.strip(F.col("text"))
    return pages.where(t != "").select("job", "page", F.lit(0).alias("idx"), F.lit("p").alias("type"), t.alias("text"), F.array(*[F.lit(0)] * 4).alias("bbox"), F.lit(None).cast("string").alias("image_id"))


def html_blocks(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Headings, paragraphs and list items of HTML: (id, idx, type, text), by one regular expression."""
    tags = F.regexp_extract_all(html_col, F.lit(r"(?is)<(h[1-6]|p|li)(?:\s[^>]*)?>"), F.lit(1))
    bodies = F.regexp_extract_all(html_col, F.lit(r"(?is)<(?:h[1-6]|p|li)(?:\s[^>]*)?>(.*?)(?=</?(?:h[1-6]|p|li)\b|\z)"), F.lit(1))
    both = pages.select(id_col, F.posexplode(F.arrays_zip(F.transform(tags, F.lower).alias("type"), bodies.alias("text"))).alias("idx", "b"))
    text = X.collapse(F.regexp_replace(F.col("b.text"), r"(?s)<[^>]*>", " "))
    return both.select(id_col, "idx", F.col("b.type").alias("type"), text.alias("text")).where("text <> ''")


def pdf_stream_tokens(streams: DataFrame) -> DataFrame:
    """(job, page, idx, token): hex strings in UTF-16BE of PDF content streams."""
    hexes = F.regexp_extract_all("data", F.lit(r"<([0-9A-Fa-f\s]+)>\s*Tj"), F.lit(1))
    x = streams.select("job", "page", F.posexplode(hexes).alias("idx", "h"))
    return x.select("job", "page", "idx", X.decode_utf16_hex(F.regexp_replace("h", r"\s", "")).alias("token"))
