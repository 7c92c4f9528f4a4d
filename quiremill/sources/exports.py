"""Sinks: books as JSON, Markdown, TEI, EPUB and Typst source; reports; corrected hOCR and PDF streams.

A serialised document is one row (job, content): built from ordered aggregates, or by one task per
job where the format needs a whole document, as XML and ZIP do.
"""

from __future__ import annotations

import html
import io
import re
import uuid
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiremill.functions import text as X
from quiremill.functions.similarity import replace_tokens
from quiremill.operators.jobs import flagged_rows

TEI = "http://www.tei-c.org/ns/1.0"
#: PDF content streams longer than this stay as they are.
LONGEST_STREAM = 2_000_000


def _ordered(order: list[str], value):
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, value.alias("_v")))), lambda x: x["_v"])


def book_json(blocks: DataFrame, metadata: DataFrame) -> DataFrame:
    """(job, content): {metadata, pages: [{page_num, blocks: [...]}]}; metadata: (job, columns...)."""
    block = F.struct(*[F.col(c) for c in ("type", "text", "bbox", "image_id") if c in blocks.columns])
    pages = blocks.groupBy("job", "page").agg(_ordered(["idx"], block).alias("blocks"))
    page = F.struct(F.col("page").alias("page_num"), "blocks")
    books = pages.groupBy("job").agg(_ordered(["page"], page).alias("pages"))
    meta = F.struct(*metadata.columns, F.size("pages").alias("page_count"))
    return books.join(metadata, "job").select("job", F.to_json(F.struct(meta.alias("metadata"), "pages")).alias("content"))


def block_markdown(kind, text):
    """One block: headings with their marks, all else as it is."""
    level = F.regexp_extract(kind, r"^h(\d)$", 1).try_cast("int")
    return F.when(level.isNotNull(), F.concat(F.repeat(F.lit("#"), level), F.lit(" "), text)).when(kind == "sidehead", F.concat(F.lit("**"), text, F.lit("**"))).otherwise(text)


def book_markdown(blocks: DataFrame, metadata: DataFrame) -> DataFrame:
    """(job, content): front matter, a comment per page, blocks apart by a blank line, table rows by none."""
    w = Window.partitionBy("job", "page").orderBy("idx")
    follows = (F.col("type") == "table_row") & (F.lead("type").over(w) == "table_row")
    b = blocks.select("job", "page", "idx", F.concat(block_markdown(F.col("type"), F.col("text")), F.when(follows, "\n").otherwise("\n\n")).alias("t"))
    pages = b.groupBy("job", "page").agg(F.array_join(_ordered(["idx"], F.col("t")), "").alias("t"))
    pages = pages.select("job", "page", F.concat(F.lit("<!-- page "), F.col("page").cast("string"), F.lit(" -->\n\n"), "t").alias("t"))
    books = pages.groupBy("job").agg(F.array_join(_ordered(["page"], F.col("t")), "").alias("body"))
    head = F.concat(F.lit("---\n"), *[x for c in metadata.columns for x in (F.lit(f'{c}: "'), F.coalesce(F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('\\"')), F.lit("")), F.lit('"\n'))], F.lit("---\n\n"))
    return books.join(metadata.select("*", head.alias("_head")), "job").select("job", F.concat("_head", "body").alias("content"))


def plain_text(words: DataFrame) -> DataFrame:
    """(job, page, content): words that aren't empty, in order, by blanks."""
    return words.where(X.strip(F.col("text")) != "").groupBy("job", "page").agg(F.array_join(_ordered(["idx"], F.col("text")), " ").alias("content"))


def _per_job(blocks: DataFrame, metadata: DataFrame, make, kind: str) -> DataFrame:
    rows = blocks.select("job", "page", "idx", "type", "text").join(metadata.select("job", F.struct(*[c for c in metadata.columns]).alias("_m")), "job")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["page", "idx"])
        meta = {k: v for k, v in dict(frame["_m"].iloc[0]).items() if v is not None}
        return pd.DataFrame([(frame["job"].iloc[0], make(meta, frame))], columns=["job", "content"])

    return rows.groupBy("job").applyInPandas(run, f"job string, content {kind}")


def _tei(meta: dict, rows: pd.DataFrame) -> str:
    q = lambda tag: f"{{{TEI}}}{tag}"
    ET.register_namespace("", TEI)
    root = ET.Element(q("TEI"))
    file = ET.SubElement(ET.SubElement(root, q("teiHeader")), q("fileDesc"))
    title = ET.SubElement(file, q("titleStmt"))
    for tag in ("title", "author", "editor"):
        if tag == "title" or meta.get(tag):
            ET.SubElement(title, q(tag)).text = str(meta.get(tag) or meta.get("job"))
    ET.SubElement(ET.SubElement(file, q("publicationStmt")), q("p")).text = str(meta.get("publisher") or "unpublished")
    ET.SubElement(ET.SubElement(file, q("sourceDesc")), q("p")).text = "digitised pages"
    body = ET.SubElement(ET.SubElement(root, q("text")), q("body"))
    div, page = ET.SubElement(body, q("div")), None
    for r in rows.itertuples():
        if r.page != page:
            page = r.page
            ET.SubElement(div, q("pb"), n=str(page))
        if r.type == "h1" and len(div) > 1:
            div = ET.SubElement(body, q("div"))
        heading = re.fullmatch(r"h\d", r.type)
        e = ET.SubElement(div, q("head" if heading else "p"))
        if r.type in ("table_row", "sidehead"):
            e.set("rend" if r.type == "sidehead" else "type", "sidehead" if r.type == "sidehead" else "row")
        e.text = re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", r.text)
    ET.indent(root)
    return ET.tostring(root, encoding="unicode", xml_declaration=True)


def tei_xml(blocks: DataFrame, metadata: DataFrame) -> DataFrame:
    """(job, content): TEI P5; a div per h1 once the current one has more than one child."""
    return _per_job(blocks, metadata, _tei, "string")


def _epub(meta: dict, rows: pd.DataFrame) -> bytes:
    parts: list[tuple[str, list[str]]] = []
    page = None
    for r in rows.itertuples():
        if r.type == "h1" or not parts:
            parts.append((r.text if r.type == "h1" else str(meta.get("title") or meta["job"]), []))
        out = parts[-1][1]
        if r.page != page:
            page = r.page
            out.append(f'<span epub:type="pagebreak" id="p{page}" title="{page}"/>')
        tag = r.type if re.fullmatch(r"h[1-6]", r.type) else "p"
        out.append(f"<{tag}>{html.escape(r.text, quote=False)}</{tag}>")
    title, lang = html.escape(str(meta.get("title") or meta["job"])), str(meta.get("language") or "en")
    book = f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, str(meta['job']))}"
    head = '<?xml version="1.0" encoding="utf-8"?>\n'
    xhtml = lambda t, b: f'{head}<html xmlns="http://www.w3.org/1999/xhtml" xmlns:epub="http://www.idpf.org/2007/ops" lang="{lang}"><head><title>{html.escape(t)}</title></head><body>{b}</body></html>'
    names = [f"section_{i:03d}.xhtml" for i in range(1, len(parts) + 1)]
    links = "".join(f'<li><a href="{n}">{html.escape(t)}</a></li>' for n, (t, _) in zip(names, parts, strict=True))
    items = "".join(f'<item id="s{i}" href="{n}" media-type="application/xhtml+xml"/>' for i, n in enumerate(names))
    spine = "".join(f'<itemref idref="s{i}"/>' for i in range(len(names)))
    points = "".join(f'<navPoint id="n{i}" playOrder="{i + 1}"><navLabel><text>{html.escape(t)}</text></navLabel><content src="{n}"/></navPoint>' for i, (n, (t, _)) in enumerate(zip(names, parts, strict=True)))
    files = {
        "META-INF/container.xml": f'{head}<container version="1.0" xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OEBPS/content.opf" media-type="application/oebps-package+xml"/></rootfiles></container>',
        "OEBPS/content.opf": f'{head}<package xmlns="http://www.idpf.org/2007/opf" version="3.0" unique-identifier="id"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:identifier id="id">{book}</dc:identifier><dc:title>{title}</dc:title><dc:language>{lang}</dc:language></metadata><manifest><item id="nav" href="nav.xhtml" media-type="application/xhtml+xml" properties="nav"/><item id="ncx" href="toc.ncx" media-type="application/x-dtbncx+xml"/>{items}</manifest><spine toc="ncx">{spine}</spine></package>',
        "OEBPS/nav.xhtml": xhtml(str(meta.get("title") or meta["job"]), f'<nav epub:type="toc"><ol>{links}</ol></nav>'),
        "OEBPS/toc.ncx": f'{head}<ncx xmlns="http://www.daisy.org/z3986/2005/ncx/" version="2005-1"><head><meta name="dtb:uid" content="{book}"/></head><docTitle><text>{title}</text></docTitle><navMap>{points}</navMap></ncx>',
        **{f"OEBPS/{n}": xhtml(t, "".join(b)) for n, (t, b) in zip(names, parts, strict=True)},
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(zipfile.ZipInfo("mimetype"), "application/epub+zip", zipfile.ZIP_STORED)
        for name, content in files.items():
            z.writestr(zipfile.ZipInfo(name), content, zipfile.ZIP_DEFLATED)
    return out.getvalue()


def epub(blocks: DataFrame, metadata: DataFrame) -> DataFrame:
    """(job, content): EPUB 3, a section per h1, ``mimetype`` first and stored."""
    return _per_job(blocks, metadata, _epub, "binary")


def _table(*heads: str) -> str:
    return f"| {' | '.join(heads)} |\n|{'---|' * len(heads)}\n"


def _row(*cells) -> Column:
    return F.concat(F.lit("| "), *[x for c in cells for x in (F.coalesce(c.cast("string"), F.lit("-")), F.lit(" | "))][:-1], F.lit(" |"))


def audit_markdown(pages: DataFrame) -> DataFrame:
    """(job, content): summary and flagged rows of page verdicts (job, page, status, overlap, warnings and, if there, original_fill, digital_fill, original_centre, digital_centre, sideheads_agree).

    Pages that don't pass are listed, at most 35, with how many more there are; if all pass, the first 15.  What is unknown is a dash.
    """
    has = set(pages.columns)
    share = lambda c, f: F.when(F.col(c).isNull(), "-").otherwise(F.format_string(f, F.col(c) * (100 if "%%" in f else 1)))
    pair = lambda a, b, f: F.concat(share(a, f), F.lit(" / "), share(b, f)) if {a, b} <= has else F.lit("-")
    warnings = F.coalesce(F.nullif(F.array_join("warnings", "; "), F.lit("")), F.lit("-")) if "warnings" in has else F.lit("-")
    agree = F.when(F.col("sideheads_agree"), "yes").when(~F.col("sideheads_agree"), "no") if "sideheads_agree" in has else F.lit(None).cast("string")
    line = _row(F.col("page"), F.col("status"), share("overlap", "%.1f%%"), pair("original_fill", "digital_fill", "%.0f%%"), pair("original_centre", "digital_centre", "%.2f"), agree, warnings)
    shown = flagged_rows(pages).groupBy("job").agg(F.array_join(_ordered(["page"], line), "\n").alias("_rows"))
    n = lambda s: F.count_if(F.col("status") == s)
    sums = pages.groupBy("job").agg(F.count("*").alias("_n"), n("PASS").alias("_p"), n("WARN").alias("_w"), n("FAIL").alias("_f"), F.avg("overlap").alias("_o"))
    more = F.col("_w") + F.col("_f") - 35
    x = sums.join(shown, "job")
    return x.select("job", F.concat(
        F.lit("# Layout audit\n\n"), F.format_string("%d pages: %d pass, %d warn, %d fail; mean token overlap %s\n\n", "_n", "_p", "_w", "_f", share("_o", "%.1f%%")),
        F.lit(_table("Page", "Status", "Overlap", "Fill", "Centre", "Sideheads", "Warnings")), F.col("_rows"), F.lit("\n"),
        F.when(more > 0, F.format_string("| ... | ... | ... | ... | ... | ... | %d more flagged pages |\n", more)).otherwise(""),
    ).alias("content"))


#: Pipeline steps of the report, and the suffix of the file that shows that one is done.
STEPS = [("Intake", None), ("Preprocessing", None), ("Recognition and gate", None), ("Fallback", None), ("Facsimile with text layer", ".sandwich.pdf"), ("TEI edition", ".tei.xml"), ("Typeset edition", ".digital.pdf"), ("Aligned text layer", ".aligned.pdf"), ("Restored facsimile", ".perfect_sandwich.pdf"), ("E-book", ".epub")]


def report_markdown(report: DataFrame, decisions: DataFrame, inventory: DataFrame, metadata: DataFrame | None = None, threshold: float = 85.0) -> DataFrame:
    """(job, content): a job's closing report as Markdown in five sections.

    Summary (counts, range of confidences, tier), master data from ``metadata`` (job, columns...),
    the steps with what they left behind, a table of pages with those under the threshold, and the
    files with size and purpose.  Missing values are a dash; jobs without pages or files have empty tables.
    """
    low = F.coalesce(F.col("mean_confidence") < threshold, F.lit(False))
    fallback = F.col("decision") == "fallback"
    status = F.when(~low, "good").when(fallback, "corrected").otherwise("weak")
    page = _row(F.col("page"), F.round("mean_confidence", 1), F.col("decision"), F.when(fallback, "fallback text").otherwise("local text"), status)
    outlier = F.when(low, F.concat(F.lit("- page "), F.col("page").cast("string"), F.lit(": "), F.round("mean_confidence", 1).cast("string"), F.lit(" ("), F.when(fallback, "fallback text").otherwise("left as recognised"), F.lit(")")))
    pages = decisions.groupBy("job").agg(
        F.array_join(_ordered(["page"], page), "\n").alias("_pages"), F.array_join(_ordered(["page"], outlier), "\n").alias("_outliers"), F.count_if(low).alias("_low"), F.count_if(~fallback).alias("_passed"),
        F.count_if(fallback).alias("_fallback"), F.round(F.min("mean_confidence"), 2).alias("_min"), F.round(F.max("mean_confidence"), 2).alias("_max"),
    )
    suffix = F.regexp_extract("file", r"(\.[^.]*)$", 1)
    files = inventory.groupBy("job").agg(
        F.array_join(_ordered(["file"], _row(F.col("file"), suffix, X.format_size(F.col("size")), F.col("purpose"))), "\n").alias("_files"), F.count("*").alias("_n_files"),
        *[F.min(F.when(F.col("file").endswith(s), F.struct("file", "size"))).alias(f"_step{i}") for i, (_, s) in enumerate(STEPS) if s],
    )
    x = report.join(pages, "job", "left").join(files, "job", "left")
    master = F.lit("")
    if metadata is not None:
        about = [c for c in metadata.columns if c != "job"]
        x = x.join(metadata.select("job", F.concat_ws("\n", *[_row(F.lit(c), F.col(c)) for c in about]).alias("_about")), "job", "left")
        master = F.coalesce("_about", F.lit(""))
    zero = lambda c: F.coalesce(c, F.lit(0))
    n, passed, fell = F.col("pages"), zero("_passed"), zero("_fallback")
    percent = F.round(F.when(n == 0, 0.0).otherwise(100.0 * passed / n), 1)
    summary = [
        _row(F.lit("Pages"), n), _row(F.lit("Passed"), F.concat(passed.cast("string"), F.lit(" of "), n.cast("string"), F.lit(" ("), percent.cast("string"), F.lit(f" %), threshold {threshold:g}"))),
        _row(F.lit("Fallback pages"), fell), _row(F.lit("Mean confidence"), F.concat(F.col("mean_confidence").cast("string"), F.coalesce(F.concat(F.lit(", from "), F.col("_min").cast("string"), F.lit(" to "), F.col("_max").cast("string")), F.lit("")))),
        _row(F.lit("Cost"), F.concat(F.format_number("cost", 3), F.lit(" USD"))), _row(F.lit("Files"), zero("_n_files")), _row(F.lit("Tier"), F.col("tier")),
    ]
    counts = {0: F.concat(n.cast("string"), F.lit(" pages")), 1: F.lit("done"), 2: F.concat(passed.cast("string"), F.lit(" passed, "), fell.cast("string"), F.lit(" below")), 3: F.when(fell == 0, "not needed").otherwise(F.concat(fell.cast("string"), F.lit(" pages, "), F.format_number("cost", 3), F.lit(" USD")))}
    made = lambda i: F.coalesce(F.concat(F.col(f"_step{i}.file"), F.lit(", "), X.format_size(F.col(f"_step{i}.size"))), F.lit("not made"))
    steps = [F.concat(F.lit(f"{i + 1}. {name}: "), counts[i] if i in counts else made(i)) for i, (name, _) in enumerate(STEPS)]
    outliers = F.when(zero("_low") == 0, "None.").otherwise(F.concat(F.col("_low").cast("string"), F.lit(f" pages under {threshold:g}:\n\n"), F.col("_outliers")))
    parts = [
        F.concat(F.lit("# Report "), "job"), F.concat(F.lit("## 1. Summary\n\n" + _table("Measure", "Value")), F.concat_ws("\n", *summary)),
        F.concat(F.lit("## 2. Master data\n\n" + _table("Property", "Value")), master), F.concat(F.lit("## 3. Steps\n\n"), F.concat_ws("\n", *steps)),
        F.concat(F.lit("## 4. Pages\n\n" + _table("Page", "Confidence", "Decision", "Text", "Status")), F.coalesce("_pages", F.lit("")), F.lit("\n\n### Outliers\n\n"), outliers),
        F.concat(F.lit("## 5. Files\n\n" + _table("File", "Format", "Size", "Purpose")), F.coalesce("_files", F.lit(""))),
    ]
    return x.select("job", F.concat(F.concat_ws("\n\n", *parts), F.lit("\n")).alias("content"))


def append_decisions(decisions: DataFrame, path: str) -> None:
    """The page log: JSON lines, appended."""
    decisions.write.mode("append").json(path)


@F.pandas_udf(T.StringType())
def corrected_hocr(text: pd.Series, corrections: pd.Series) -> pd.Series:
    """hOCR with the words of a map from element id to text replaced; broken XML stays as it is."""

    def one(source: str, fixes: dict[str, str]) -> str:
        try:
            root = ET.fromstring(source)
        except (ET.ParseError, TypeError):
            return source
        for e in root.iter():
            if e.get("id") in fixes and (e.get("class") or "").startswith("ocr"):
                for child in list(e):
                    e.remove(child)
                e.text = fixes[e.get("id")]
                title = e.get("title") or ""
                e.set("title", re.sub(r"x_wconf\s+[\d.]+", "x_wconf 100", title) if "x_wconf" in title else f"{title}; x_wconf 100".lstrip("; "))
        return ET.tostring(root, encoding="unicode")

    return pd.Series([one(t, dict(c) if c is not None else {}) for t, c in zip(text, corrections, strict=True)])


# Strings of a content stream: a hexadecimal one, or the sign that opens a literal one.
_STRING = re.compile(rb"<([^>]*)>|\(")
_PARENS = re.compile(rb"\\.|[()]", re.S)
_ESCAPE = re.compile(rb"\\([0-7]{1,3}|.)", re.S)
# Escapes of PDF literals.
_UNESCAPED = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
_ESCAPED = str.maketrans({"(": "\\(", ")": "\\)", "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t"})


def _hex_text(body: bytes) -> str | None:
    """The text of a hexadecimal string in UTF-16BE, if it is one."""
    try:
        raw = bytes.fromhex(body.decode("ascii"))
        return raw.decode("utf-16-be") if len(raw) >= 2 else None
    except (ValueError, UnicodeDecodeError):
        return None


def literal_text(body: bytes) -> str:
    """The text of a PDF literal (without its parentheses) in Latin-1."""

    def one(m: re.Match) -> bytes:
        return bytes([int(m[1], 8) & 255]) if m[1][:1] in b"01234567" else _UNESCAPED.get(m[1], m[1])

    return _ESCAPE.sub(one, body).decode("latin-1")


def literal_bytes(text: str) -> bytes:
    """A text as the inside of a PDF literal; what Latin-1 lacks becomes a question mark."""
    return text.translate(_ESCAPED).encode("latin-1", "replace")


def _strings_of(data: bytes) -> Iterator[tuple[int, int, bytes, bool]]:
    """(start, end, body, literal) of the strings of a content stream; a literal that isn't closed ends with the data."""
    at = 0
    while m := _STRING.search(data, at):
        if m[1] is not None:
            at = m.end()
            yield m.start(), at, m[1], False
            continue
        depth, end, at = 1, len(data), len(data)
        for p in _PARENS.finditer(data, m.end()):
            depth += {b"(": 1, b")": -1}.get(p[0], 0)
            if not depth:
                end, at = p.start(), p.end()
                break
        yield m.start(), at, data[m.end() : end], True


def correct_stream(data: bytes, mapping: dict[str, str]) -> tuple[bytes, int]:
    """A PDF content stream with its strings' tokens replaced by a mapping, and the number of hits.

    Hexadecimal strings in UTF-16BE and literals in Latin-1, alone or in arrays; strings without a
    hit keep their bytes.  Streams over ``LONGEST_STREAM`` bytes stay as they are.
    """
    if len(data) > LONGEST_STREAM or not mapping:
        return data, 0
    out, at, hits = [], 0, 0
    for start, end, body, literal in _strings_of(data):
        text = literal_text(body) if literal else _hex_text(body)
        new, n = replace_tokens(text, mapping)
        if n:
            out += [data[at:start], b"(" + literal_bytes(new) + b")" if literal else b"<" + new.encode("utf-16-be").hex().upper().encode() + b">"]
            at, hits = end, hits + n
    return b"".join(out) + data[at:], hits


def correct_streams(streams: DataFrame, mappings: DataFrame) -> DataFrame:
    """PDF streams (job, page, label, data binary) with their page's mapping applied; adds ``hits`` and ``skipped``, whether the stream was too long.  Null data stay null."""
    src = streams.select("job", "page", "label", "data").join(mappings.select("job", "page", "mapping"), ["job", "page"], "left")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            done = [correct_stream(d, dict(m) if m is not None else {}) if d is not None else (None, 0) for d, m in zip(f["data"], f["mapping"], strict=True)]
            yield f[["job", "page", "label"]].assign(data=[d for d, _ in done], hits=[n for _, n in done], skipped=[d is not None and len(d) > LONGEST_STREAM for d, _ in done])

    return src.mapInPandas(run, "job string, page int, label string, data binary, hits int, skipped boolean")
