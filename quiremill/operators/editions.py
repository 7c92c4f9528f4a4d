"""Editions of one work that share its lines: original, interlinear, transliterated, bilingual.

The lines of the original, of a transliteration and of a translation are aligned by an outer join on
their place; a layout is a template over the aligned row.  All editions come from one pass: a row is
exploded into its editions, and pages are joined in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiremill.functions import text as X
from quiremill.functions.similarity import to_iast
from quiremill.operators.typeset import fill

EDITIONS = ("original", "interlinear", "transliteration", "bilingual")
# -- Fixed values -----------------------------------------------------------------------------
BADGES = {
    "original": "KRITISCHER NEUSATZ (DEVANĀGARĪ)",
    "interlinear": "DEVANĀGARĪ & IAST INTERLINEAR EDITION",
    "transliteration": "ROMAN TRANSLITERATION (IAST) EDITION",
    "bilingual": "IAST-NEUSATZ MIT ZEILENWEISER ÜBERSETZUNG",
}
SUFFIXES = {"original": "Neusatz Deva", "interlinear": "Neusatz interlinear IAST", "transliteration": "Neusatz rein IAST", "bilingual": "Neusatz IAST mit DE Übersetzung"}
ONE, PAIR = '#ml{note}("{a}", font: "{font}")', '#il{note}("{a}", "{b}", top_font: "{font}")'
VERSE_OPENS, VERSE_CLOSES, INDENT = "#v(2.5pt) #align(center)[ #block(width: 90%)[ #set align(left)", "] ]", " #pad(left: 1.8em)["
NOTES_OPEN = "#v(1fr, weak: true)\n#v(2pt)\n#line(length: 30%, stroke: 0.5pt + luma(100))\n#v(2.5pt)"
MACROS = """#let il(top, bottom, top_font: "{main}") = block(spacing: 7.2pt, breakable: false)[
  #stack(spacing: 2.6pt)[#text(font: top_font, size: 9.6pt, weight: "medium")[#top]][#text(font: "{main}", size: 8.0pt, style: "italic", fill: rgb("#374151"))[#bottom]]
]
#let ml(txt, font: "{main}") = block(spacing: 12.0pt, breakable: false)[#text(font: font, size: 11.2pt)[#txt]]
#let il_fn(top, bottom, top_font: "{main}") = block(spacing: 6.2pt, breakable: false)[
  #stack(spacing: 2.2pt)[#text(font: top_font, size: 7.5pt, weight: "medium")[#top]][#text(font: "{main}", size: 6.8pt, style: "italic", fill: rgb("#4b5563"))[#bottom]]
]
#let ml_fn(txt, font: "{main}") = block(spacing: 8.0pt, breakable: false)[#text(font: font, size: 8.0pt)[#txt]]
"""
# ---------------------------------------------------------------------------------------------


def align_lines(editions: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """(by, a column per edition): lines (by, text) of all editions side by side, null where an edition has none."""
    parts = [df.select(*by, F.col("text").alias(name)) for name, df in editions.items()]
    return reduce(lambda a, b: a.join(b, by, "full_outer"), parts)


def aligned(original: DataFrame, transliteration: DataFrame, translation: DataFrame, by: list[str], notes: bool = False) -> DataFrame:
    """(by, original, iast, translation) for lines of the original; a missing transliteration is made, a missing translation empty.

    Notes are transliterated as an apparatus.  Lines without an original are left out.
    """
    x = align_lines({"original": original, "iast": transliteration, "translation": translation}, by).where("original is not null")
    made = X.apparatus_iast(F.col("original")) if notes else to_iast(F.col("original"))
    return x.withColumns({"iast": F.coalesce("iast", made), "translation": F.coalesce("translation", F.lit(""))})


def _quoted(c: Column) -> Column:
    return F.regexp_replace(c, r'(["\\])', r"\\$1")


def line_markup(edition: Column, deva_font: Column, main_font: Column, note: str = "") -> Column:
    """A line of an edition from the columns ``original``, ``iast`` and ``translation``."""
    o, i, t = (_quoted(F.col(c)) for c in ("original", "iast", "translation"))
    note_ = F.lit(note)
    return (
        F.when(edition == "original", fill(ONE, note=note_, a=o, font=deva_font))
        .when(edition == "interlinear", fill(PAIR, note=note_, a=o, b=i, font=deva_font))
        .when(edition == "transliteration", fill(ONE, note=note_, a=i, font=main_font))
        .when(edition == "bilingual", fill(PAIR, note=note_, a=i, b=t, font=main_font))
    )


def edition_pages(lines: DataFrame, verses: DataFrame | None = None, notes: DataFrame | None = None, metadata: DataFrame | None = None, editions: tuple[str, ...] = EDITIONS) -> DataFrame:
    """(job, edition, page, markup) from aligned lines and notes (job, page, idx, original, iast, translation).

    ``verses``: (job, page, verse, idx, original, iast, translation), each second line of a verse indented.
    ``metadata``: (job, font_main, font_deva), else the usual fonts.  On a page lines come first, then verses,
    then notes below a rule.
    """
    job = lines.schema["job"].dataType
    spark = lines.sparkSession
    zero = F.lit(0).cast("long")
    parts = [lines.select("job", "page", F.lit(0).alias("part"), zero.alias("verse"), F.col("idx").cast("long").alias("idx"), "original", "iast", "translation")]
    if verses is not None:
        parts.append(verses.select("job", "page", F.lit(1).alias("part"), F.col("verse").cast("long").alias("verse"), F.col("idx").cast("long").alias("idx"), "original", "iast", "translation"))
    if notes is not None:
        parts.append(notes.select("job", "page", F.lit(2).alias("part"), zero.alias("verse"), F.col("idx").cast("long").alias("idx"), "original", "iast", "translation"))
    x = reduce(DataFrame.unionByName, parts)
    fonts = metadata.select("job", "font_main", "font_deva") if metadata is not None else spark.createDataFrame([], f"job {job.simpleString()}, font_main string, font_deva string")
    x = x.join(fonts, "job", "left").withColumns({"font_main": F.coalesce("font_main", F.lit("STIX Two Text")), "font_deva": F.coalesce("font_deva", F.lit("Devanagari MT"))})
    x = x.select("*", F.explode(F.array(*map(F.lit, editions))).alias("edition"))
    e, fonts_ = F.col("edition"), (F.col("font_deva"), F.col("font_main"))
    line = F.when(F.col("part") == 2, line_markup(e, *fonts_, note="_fn")).otherwise(line_markup(e, *fonts_))
    x = x.select("job", "edition", "page", "part", "verse", "idx", line.alias("l"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("idx", "l"))), lambda s: s["l"])
    parts = x.groupBy("job", "edition", "page", "part", "verse").agg(ordered.alias("ls"))
    indented = F.transform("ls", lambda s, i: F.when(i % 2 == 1, F.concat(F.lit(INDENT), s, F.lit("]"))).otherwise(s))
    text = F.when(F.col("part") == 1, F.concat(F.lit(VERSE_OPENS + "\n"), F.array_join(indented, "\n"), F.lit("\n" + VERSE_CLOSES))).when(F.col("part") == 2, F.concat(F.lit(NOTES_OPEN + "\n"), F.array_join("ls", "\n"))).otherwise(F.array_join("ls", "\n"))
    pages = parts.groupBy("job", "edition", "page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "verse", text.alias("t")))), lambda s: s["t"]), "\n").alias("_t"))
    return pages.select("job", "edition", "page", F.concat(F.lit("// ==================== PAGE "), F.col("page").cast("string"), F.lit(" ====================\n"), "_t").alias("markup"))


def edition_documents(pages: DataFrame, metadata: DataFrame) -> DataFrame:
    """(job, edition, name, content) of edition pages; ``metadata``: (job, title, author, chapter, base_name, paper, font_main, start_page, has_title_page).

    Printed numbers count from ``start_page`` on the first page of the body.
    """
    m = metadata.select(
        "job", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("author", F.lit("")).alias("author"), F.coalesce("chapter", F.lit("")).alias("chapter"), F.coalesce("base_name", F.lit("Edition")).alias("base_name"),
        F.coalesce("paper", F.lit("a5")).alias("paper"), F.coalesce("font_main", F.lit("STIX Two Text")).alias("main"), F.coalesce("start_page", F.lit(10)).alias("start_page"), F.coalesce("has_title_page", F.lit(True)).alias("titled"),
    )
    body = pages.groupBy("job", "edition").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", "markup"))), lambda s: s["markup"]), "\n#pagebreak()\n").alias("body"))
    x = body.join(m, "job")
    badge, suffix = F.lit("STUDIENAUSGABE"), F.col("edition")
    for name in EDITIONS:
        badge, suffix = F.when(F.col("edition") == name, BADGES[name]).otherwise(badge), F.when(F.col("edition") == name, SUFFIXES[name]).otherwise(suffix)
    safe = lambda c: X.escape_typst(F.col(c), "quoted")
    title = fill(
        '#set page(paper: "{paper}", margin: (inside: 1.8cm, outside: 1.8cm, top: 2.0cm, bottom: 1.6cm), header: none)\n#align(center)[\n  #text(font: "{main}", size: 27pt, weight: "bold")[{title}]\n  #v(0.5cm)\n  #text(font: "{main}", size: 10pt)[{author}]\n  #v(0.5cm)\n  #text(font: "{main}", size: 12pt, style: "italic")[{chapter}]\n  #v(0.8cm)\n  #text(font: "{main}", size: 8.8pt, weight: "bold")[{badge}]\n]\n#pagebreak()\n',
        paper=F.col("paper"), main=F.col("main"), title=safe("title"), author=safe("author"), chapter=safe("chapter"), badge=X.escape_typst(badge, "quoted"),
    )
    offset = F.col("start_page") - F.when(F.col("titled"), 2).otherwise(1)
    head = fill(
        '#set page(paper: "{paper}", margin: (inside: 1.2cm, outside: 1.2cm, top: 0.85cm, bottom: 0.85cm), header: context {{\n  let pno = here().page() + {offset}\n  if here().page() == 1 and {titled} {{ none }} else if calc.even(pno) {{\n    grid(columns: (1fr, 3fr), text(font: "{main}", size: 8.8pt)[#pno], align(right)[{title}])\n  }} else {{\n    grid(columns: (3fr, 1fr), [{chapter}], align(right)[#pno])\n  }}\n}})\n',
        paper=F.col("paper"), offset=offset.cast("string"), titled=F.col("titled").cast("string"), main=F.col("main"), title=safe("title"), chapter=safe("chapter"),
    )
    macros = F.replace(F.lit(MACROS), F.lit("{main}"), F.col("main"))
    content = F.concat(F.when(F.col("titled"), title).otherwise(""), head, macros, F.col("body"))
    return x.select("job", "edition", F.concat("base_name", F.lit(" ("), suffix, F.lit(")")).alias("name"), content.alias("content"))
