"""Blocks of a book as Typst markup: paragraphs, lists, indexes, verses, tables, notes, contents, glyphs, pages.

Rules look at a block's lines with column expressions and count what they see; the counts choose the kind of
the block, and each kind has a template.  What stands inside a line is formatted by one Arrow function
(``functions.markup``), once a block, its segments kept apart by separators.  Neighbours (table rows, notes,
running headers, chapters) are windows over a page.  No row leaves its page until pages are
joined to a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiremill.functions import text as X
from quiremill.functions.markup import ITEM, LABEL, PART, markup

# -- Fixed values -----------------------------------------------------------------------------
LINE_END = r"\R|[\x1c-\x1e]"
IMAGE = r"!\[.*?\]\(.*?\)"
SUTRA_HASH = r"(?U)^#\s*(\d+\.\d+)"
SUTRA_PREFIX = r"(?U)^#?\s*\d+\.\d+(?:\.\d+)?\b|^#?\s*\d+\.\s+\d+\.\d+\b"
LIST_ITEM = r"(?U)^(?:[-*+]\s+)?(\(\s*(?:[0-9]{1,3}|[a-zA-Z]|[ivxLCDM]{1,6}|[0-9l][a-z]|[a-z]-[a-z])\s*\)|\b[0-9]{1,3}\.(?!\d)|\b[a-zA-Z]\.(?!\w))\s+(.*)$"
GLOSS = r"^['‘’\"“]"
FORMULA = r"^(?:=|\+|→|\$\\rightarrow|\(?[0-9]+\.[0-9]+\.[0-9]+|b[0-9](?U:\s*)=)"
INDEX_END = r"(?U)\b\d+(?:[-–—]\d+)?(?:,\s*\d+)*$"
INDEX_TERM = r"(?U)^(\*?[a-zA-ZāīūṛṝḷṅñṭḍṇśṣṃḥĀĪŪṚṜḶṄÑṬḌṆŚṢṂḤ\s\-–—/]+\*?)\s+(.*)$"
SUTRA_ENTRY = r"(?U)^.+?\(\d+\.\d+\.\d+\)"
VERSE_END = r"[/|]$"
NUMBERED = r"(?U)^(\b\d{1,3}\.)\s+(.*)$"
SUB_ITEM = r"(?U)^([a-zA-Z]\.|\([a-zA-Z0-9]+\)|[ivxLCDM]+\.)\s+(.*)$"
INITIALS = r"(?U)^[A-Z]\.\s+[A-Z]\."
SECTION_MARK = r"(?iU)^[\[\(]\s*(\d+|[ivxlcdm]+)\s*[\]\)]$"
RUNNING_HEADER = r"(?iU)^(?:LESSON\s+[A-Z0-9]+|CHAPTER\s+[A-Z0-9]+|INTRODUCTION|CONTENTS|INDEX(?:\s+OF\s+[A-Z\s]+)?|APPENDIX(?:\s+[A-Z0-9]+)?|GLOSSARY|ANSWERS\s+TO\s+EXERCISES|TABLES)$"
PAGE_LABEL = r"(?i)^(?:[ivxlcdm]+|\p{Nd}+)$"
FIRST_NOTE = r"(?U)^(?:[1१][.)]|\([1१]\)|\*)\s+"
NOTE = r"(?sU)^([¹²³⁴⁵⁶⁷⁸⁹⁰]+|[१-९\d]{1,3}[.)]?|\([१-९\d]{1,3}\))\s*(.*)$"
PAGE_NUMBER = r"(\d+|[ivxlcdm]+)$"
MAJOR_ALONE = r"(?iU)^(LESSON\s+[A-Z\d\-]+|INTRODUCTION|PREFACE|FOREWORD|ANSWERS\s+TO\s+EXERCISES|TABLES|APPENDICES?)$"
MAJOR = r"(?iU)^(LESSON\s+[A-Z\d\-]+|INTRODUCTION|PREFACE|FOREWORD|ANSWERS\s+TO\s+EXERCISES|TABLES(?:\s+[A-Za-z\s]+)?|APPENDICES?|INDEX\s+OF\s+[A-Z\s]+|GENERAL\s+INDEX|READINGS?)(?:\s+PAGE)?(?:\s+(\d+|[ivxlcdm]+))?$"
CONTENTS_WORDS = ["CONTENTS", "TABLE OF CONTENTS", "INHALT"]
LANGUAGES = {"deu": "de", "ger": "de", "eng": "en", "fra": "fr", "fre": "fr", "ita": "it", "spa": "es", "lat": "la", "san": "sa", "hin": "hi"}
NUMBER_GRID = "#block(spacing: 0.85em)[\n  #set par(justify: true, leading: 0.52em, first-line-indent: 0pt)\n  #grid(\n    columns: (2.0em, 1fr),\n    [{label}],\n    [{body}]\n  )\n]"
SUB_BLOCK = "#block(inset: (left: 3.8em), spacing: 0.38em)[\n  #set par(hanging-indent: 1.5em)\n  {label} {body}\n]"
MARK_BLOCK = '#align(center)[#v(0.4em)#text(size: 11.5pt, weight: "bold")[{body}]#v(0.4em)]'
MAIN_LIST = "#block(spacing: 0.85em)[\n  #set par(leading: 0.52em, first-line-indent: 0pt)\n  #grid(\n    columns: (2.0em, 1fr),\n    row-gutter: 0.85em,\n{body}\n  )\n]"
SUB_LIST = "#block(inset: (left: 3.8em), spacing: 0.45em)[\n  #set par(leading: 0.42em, first-line-indent: 0pt)\n  #grid(\n    columns: (auto, 1fr),\n    column-gutter: 0.6em,\n    row-gutter: 0.55em,\n{body}\n  )\n]"
INDEX_BLOCK = "#block(spacing: 0.45em)[\n  #set text(size: 8.5pt)\n  #set par(leading: 0.38em, first-line-indent: 0pt, hanging-indent: 1.2em)\n  #grid(\n    columns: (1fr, 1fr),\n    column-gutter: 18pt,\n    [\n      {left}\n    ],\n    [\n      {right}\n    ]\n  )\n]"
SUTRA_BLOCK = "#block(spacing: 0.45em)[\n  #set par(first-line-indent: 0pt, hanging-indent: 1.5em, leading: 0.42em)\n  {body}\n]"
VERSE_BLOCK = "#block(inset: (left: 1.5em), spacing: 0.45em)[\n  #set par(first-line-indent: 0pt, leading: 0.45em)\n  {body}\n]"
PAIR_TABLE = "#align(center)[#block(width: auto)[\n#set text(size: 9.5pt)\n#grid(\n  columns: (auto, auto),\n  column-gutter: 24pt,\n  row-gutter: 0.65em,\n  align: left,\n  {body}\n)]]"
CONTENTS_TABLE = "#align(center)[#block(width: 82%)[\n#set text(size: 9.5pt)\n#grid(\n  columns: (1.8em, 1fr, auto),\n  column-gutter: 0.8em,\n  row-gutter: 0.48em,\n  align: (col, row) => if col == 0 {{ right }} else if col == 1 {{ left }} else {{ right }},\n  {body}\n)]]"
OPEN_TABLE = "#align(center)[#block(width: {width})[\n#set text(size: {size})\n#table(\n  columns: ({columns}),\n{gutter}  stroke: none,\n  inset: (x: {x}, y: {y}),\n  fill: none,\n  align: {align},\n  {body}\n)]]"
NOTES = "#v(14pt)\n#line(length: 25%, stroke: 0.4pt)\n#v(-7pt)\n#block[\n  #set text(size: 7.9pt)\n  #set par(justify: true, hanging-indent: 8.5pt, leading: 0.46em, spacing: 4.5pt)\n  {body}\n]"
NOTE_MARKED = "#par[#box(width: 8.5pt)[#text(size: 8.5pt)[#super[{label}]]]{body}]"
CONTENTS_PAGE = '#book-toc-page(\n  is_first: {first},\n  roman_label: "{roman}"\n)[\n#grid(\n  columns: (82pt, 1fr, 32pt),\n  column-gutter: 8pt,\n  row-gutter: 0.40em,\n  align: (left, left, right),\n{body}\n)\n]'
CONTENTS_HEAD = '  [], [], [#align(right)[#text(size: 8pt, weight: "bold", tracking: 0.08em)[PAGE]]],'
MAJOR_ROW = '  grid.cell(colspan: 2)[#v(0.32cm)#text(size: 9.5pt, weight: "bold")[{body}]],\n  {page},'
MAJOR_PAGE = '[#v(0.32cm)#align(right)[#text(size: 9.5pt, weight: "bold")[{page}]]]'
OTHER_ROW = '  grid.cell(colspan: 3)[#v(0.2cm)#text(size: 7.2pt, fill: luma(80), style: "italic")[{body}]],'
BESIDE_GRID = "#align(center)[\n  #grid(\n    columns: (24pt, 90pt, 36pt, 24pt, 90pt),\n    align: (horizon + right, horizon + center, horizon, horizon + right, horizon + center),\n    row-gutter: 12pt,\n{body}\n  )\n]"
BELOW_GRID = "#align(center)[\n  #grid(\n    columns: ({columns}),\n    align: ({aligns}),\n    row-gutter: 6pt,\n    column-gutter: 14pt,\n    {images},\n    {labels},\n  )\n]"
# ---------------------------------------------------------------------------------------------


def fill(template: str, **values: Column) -> Column:
    """A template with columns in the places of its ``{names}``; doubled braces are braces."""
    import string

    parts = []
    for text, name, _, _ in string.Formatter().parse(template):
        parts += ([F.lit(text)] if text else []) + ([values[name]] if name else [])
    return F.concat(*parts)


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once a row, not once for each use."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.translate(text, LABEL, " "), LINE_END), X.strip), lambda line: line != "")


def _seen(line: Column) -> Column:
    """What the rules need to know of a line."""
    clean = F.regexp_replace(line, SUTRA_HASH, "$1")
    label, rest = F.regexp_extract(clean, LIST_ITEM, 1), F.regexp_extract(clean, LIST_ITEM, 2)
    item = clean.rlike(LIST_ITEM) & ~clean.rlike(SUTRA_PREFIX) & ~(label.endswith(".") & rest.rlike(r"(?U)^\d+\."))
    return F.struct(
        line.alias("line"), clean.alias("clean"), item.alias("item"), X.strip(label).alias("label"), X.strip(rest).alias("rest"),
        (line.rlike(GLOSS) | line.rlike(FORMULA)).alias("explains"), line.rlike(FORMULA).alias("formula"), line.rlike(INDEX_END).alias("index"),
        line.rlike(SUTRA_ENTRY).alias("sutra"), line.rlike(VERSE_END).alias("verse"),
    )


def block_kind(x: str = "x") -> Column:
    """The kind of a block by what is seen in its lines (an array of ``_seen``)."""
    n = F.size(x)
    count = lambda f: F.size(F.filter(x, f))
    items = count(lambda s: s["item"])
    explained = F.exists(F.slice(x, 2, F.greatest(n - 1, F.lit(0))), lambda s: s["explains"])
    return (
        F.when(n == 0, "empty")
        .when(n == 1, "prose")
        .when((items >= 2) | ((items == 1) & F.get(x, F.lit(0))["item"] & explained), "list")
        .when((n >= 15) & (count(lambda s: s["index"]) / n >= 0.55), "index")
        .when(count(lambda s: s["sutra"]) >= 2, "sutras")
        .when(F.exists(x, lambda s: s["verse"]) | (count(lambda s: s["formula"]) >= 2), "verse")
        .otherwise("prose")
    )


def _segments() -> dict[str, Column]:
    """By kind the text whose segments are formatted: lines, or labels and the parts of items."""
    lines = F.transform("x", lambda s: s["line"])
    joined = F.array_join(lines, " ")
    label, body = (F.coalesce(F.nullif(F.regexp_extract(joined, NUMBERED, g), F.lit("")), F.regexp_extract(joined, SUB_ITEM, g)) for g in (1, 2))
    places = F.sequence(F.lit(0), F.size("x") - 1)
    opens = F.filter(places, lambda i: F.get("x", i)["item"])
    nexts = F.concat(F.slice(opens, 2, F.size(opens)), F.array(F.size("x")))
    lead = F.array_join(F.transform(F.slice("x", 1, F.get(opens, F.lit(0))), lambda s: s["clean"]), " ")

    def item(i: Column, to: Column) -> Column:
        own = F.get("x", i)
        after = F.transform(F.slice("x", i + 2, to - i - 1), lambda s: s["clean"])
        parts = F.split(F.array_join(F.concat(F.filter(F.array(own["rest"]), lambda r: r != ""), after), r" \ "), r" \\ ")
        return F.concat(own["label"], F.lit(LABEL), F.array_join(F.transform(parts, lambda p: F.regexp_replace(X.strip(p), SUTRA_HASH, "$1")), PART))

    term = lambda s: F.when(s["line"].rlike(INDEX_TERM), F.concat(X.strip(F.regexp_extract(s["line"], INDEX_TERM, 1)), F.lit(LABEL), X.strip(F.regexp_extract(s["line"], INDEX_TERM, 2)))).otherwise(s["line"])
    return {
        "prose": F.when(F.col("sub") != "", F.concat(label, F.lit(LABEL), body)).otherwise(joined),
        "list": F.concat(lead, F.lit(ITEM), F.array_join(F.zip_with(opens, nexts, item), ITEM)),
        "index": F.array_join(F.transform("x", term), PART),
        "sutras": F.array_join(lines, PART),
        "verse": F.array_join(lines, PART),
    }


def _sub_kind() -> Column:
    joined = F.array_join(F.transform("x", lambda s: s["line"]), " ")
    mark = (F.size("x") == 1) & joined.rlike(SECTION_MARK)
    return (
        F.when(joined.rlike(SUB_ITEM) & ~joined.rlike(INITIALS), "sub")
        .when(joined.rlike(NUMBERED) & ~joined.rlike(SUTRA_PREFIX), "number")
        .when(mark, "mark")
        .otherwise("")
    )


def _made() -> Column:
    """The markup of a block from its formatted segments ``m``."""
    part = lambda s, sep, i: F.coalesce(F.get(F.split(s, sep, -1), F.lit(i)), F.lit(""))
    lines = F.split("m", PART, -1)
    label, body = part(F.col("m"), LABEL, 0), part(F.col("m"), LABEL, 1)
    items = F.split("m", ITEM, -1)
    lead = F.get(items, F.lit(0))

    def cell(s: Column) -> Column:
        parts = F.transform(F.split(part(s, LABEL, 1), PART, -1), lambda p: F.when(p.startswith("\\="), F.concat(F.lit("#h(1.2em) "), p)).otherwise(p))
        return F.concat(F.lit("    ["), part(s, LABEL, 0), F.lit("], [\n      "), F.array_join(parts, " \\\n      "), F.lit("\n    ]"))

    cells = F.array_join(F.transform(F.slice(items, 2, F.size(items)), cell), ",\n")
    main = F.exists("x", lambda s: s["item"] & s["label"].rlike(r"(?U)^\d{1,3}\.$"))
    listed = F.concat(F.when(lead != "", F.concat(lead, F.lit("\n\n"))).otherwise(""), F.when(main, fill(MAIN_LIST, body=cells)).otherwise(fill(SUB_LIST, body=cells)))
    terms = F.transform(lines, lambda s: F.when(s.contains(LABEL), F.concat(F.lit("_"), part(s, LABEL, 0), F.lit("_ "), part(s, LABEL, 1))).otherwise(s))
    half = F.floor((F.size(lines) + 1) / 2).cast("int")
    index = fill(INDEX_BLOCK, left=F.array_join(F.slice(terms, 1, half), " \\\n      "), right=F.array_join(F.slice(terms, half + 1, F.size(lines)), " \\\n      "))
    under = F.array_join(lines, " \\\n  ")
    sub = F.col("sub")
    prose = F.when(sub == "number", fill(NUMBER_GRID, label=label, body=body)).when(sub == "sub", fill(SUB_BLOCK, label=label, body=body)).when(sub == "mark", fill(MARK_BLOCK, body=F.col("m"))).otherwise(F.col("m"))
    return F.when(F.col("kind") == "list", listed).when(F.col("kind") == "index", index).when(F.col("kind") == "sutras", fill(SUTRA_BLOCK, body=under)).when(F.col("kind") == "verse", fill(VERSE_BLOCK, body=under)).otherwise(prose)


def block_markup(blocks: DataFrame, text: str = "text") -> DataFrame:
    """``blocks`` with ``kind`` (prose, list, index, sutras, verse, empty) and ``markup`` of their text.

    A null or blank text is ``empty`` with empty markup.
    """
    x = _once(blocks, x=F.transform(_lines(F.coalesce(text, F.lit(""))), _seen))
    x = _once(x, kind=block_kind(), sub=_sub_kind())
    segments = _segments()
    raw = F.lit("")
    for kind, s in segments.items():
        s = F.when((F.col("kind") == "prose") & ~F.col("sub").isin("sub", "number"), F.array_join(F.transform("x", lambda s: s["line"]), " ")).otherwise(s) if kind == "prose" else s
        raw = F.when(F.col("kind") == kind, s).otherwise(raw)
    x = x.withColumn("m", markup(raw))
    return x.select(*blocks.columns, "kind", F.when(F.col("kind") == "empty", "").otherwise(_made()).alias("markup"))


# -- Tables -----------------------------------------------------------------------------------


def table_markup(rows: DataFrame, by: list[str], order: str = "idx", text: str = "text") -> DataFrame:
    """(by, markup): Markdown tables, a row per line in ``order``; rules between rows go, no rows give no table.

    Two columns with page numbers in the second (five rows and more) are contents, other two columns pairs, more
    columns an open table whose widths and alignment follow the cells below its head.
    """
    cells = F.transform(F.split(F.regexp_replace(X.strip(F.col(text)), r"^\|+|\|+$", ""), r"\|", -1), X.strip)
    x = rows.select(*by, order, cells.alias("c")).where(~F.forall("c", lambda c: c.rlike(r"^[-: ]*$")))
    seg = x.select(*by, order, F.size("c").alias("n"), "c", F.split(markup(F.array_join("c", PART)), PART, -1).alias("m"))
    w = Window.partitionBy(*by)
    t = seg.groupBy(*by).agg(F.max("n").alias("n"), F.count("*").alias("rows"), F.sort_array(F.collect_list(F.struct(order, "c", "m"))).alias("r"))
    pad = lambda a, n: F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(F.get(a, i), F.lit("")))
    t = _once(t, c=F.transform("r", lambda r: pad(r["c"], F.col("n"))), m=F.transform("r", lambda r: pad(r["m"], F.col("n"))))
    content = F.when(F.size("c") > 1, F.slice("c", 2, F.size("c"))).otherwise(F.col("c"))
    digits, small = r"^\d+$", r"(?i)^(i|ii|iii|iv|v|vi|vii|viii|ix|x|xi|xii|xiii|xiv|xv)$"
    second = lambda r: F.get(r, F.lit(1))
    numbers = F.forall("c", lambda r: (second(r) == "") | second(r).rlike(digits) | second(r).rlike(small))

    def listed(r: Column, f: Column) -> Column:
        title = F.get(r, F.lit(0))
        space = F.when(title.startswith("1. ") | F.lower(title).contains("bibliography"), F.lit("grid.cell(colspan: 3)[#v(0.8em)],\n  ")).otherwise("")
        number = F.regexp_extract(title, r"^(\d+\.)\s*(.*)$", 1)
        shown = F.when(number != "", F.regexp_replace(F.get(f, F.lit(0)), r"^\d+\\?\.\s*", "")).otherwise(F.get(f, F.lit(0)))
        return F.concat(space, F.when(number != "", F.concat(F.lit("["), number, F.lit("]"))).otherwise("[]"), F.lit(", ["), shown, F.lit("], ["), F.get(f, F.lit(1)), F.lit("]"))

    contents = fill(CONTENTS_TABLE, body=F.array_join(F.zip_with("c", "m", listed), ",\n  "))
    pairs = fill(PAIR_TABLE, body=F.array_join(F.transform("m", lambda f: F.concat(F.lit("["), F.get(f, F.lit(0)), F.lit("], ["), F.get(f, F.lit(1)), F.lit("]"))), ",\n  "))
    columns = F.sequence(F.lit(0), F.col("n") - 1)
    longest = lambda i: F.array_max(F.transform("content", lambda r: F.length(F.get(r, i))))
    t = _once(t, content=content)
    t = _once(t, most=F.transform(columns, longest))
    total = F.aggregate("most", F.lit(0), lambda a, v: a + v)
    wide = F.transform("most", lambda v: F.when((F.col("total") <= 55) | (v <= 8), "auto").when(v <= 16, "1.5fr").otherwise("3fr"))
    numeric = lambda i: F.forall("content", lambda r: (F.length(F.get(r, i)) <= 2) | F.get(r, i).rlike(digits))
    t = _once(_once(t, total=total), width=wide)
    compact = F.forall("width", lambda v: v == "auto")
    aligns = F.transform(columns, lambda i: F.concat(F.lit("if col == "), i.cast("string"), F.lit(" { "), F.when((i > 0) & (numeric(i) | (F.get("most", i) <= 12)), "center").otherwise("left"), F.lit(" }")))
    opened = fill(
        OPEN_TABLE, width=F.when(compact, "auto").otherwise("100%"),
        size=F.when(F.col("n") >= 10, "7.5pt").when(F.col("rows") > 28, "8.2pt").when(F.col("rows") > 14, "8.8pt").otherwise("9.2pt"),
        columns=F.array_join("width", ", "), gutter=F.when(compact, "  column-gutter: 24pt,\n  row-gutter: 0.35em,\n").otherwise("  row-gutter: 0.35em,\n"),
        x=F.when(compact | (F.col("n") >= 10), "2pt").otherwise("4pt"), y=F.when(F.col("rows") > 14, "1.5pt").otherwise("2.0pt"),
        align=F.when(F.col("n") > 1, F.concat(F.lit("(col, row) => "), F.array_join(aligns, " else "), F.lit(" else { left }"))).otherwise("left"),
        body=F.array_join(F.transform(F.flatten("m"), lambda c: F.concat(F.lit("["), c, F.lit("]"))), ", \n    "),
    )
    return t.select(*by, F.when((F.col("n") == 2) & numbers & (F.col("rows") >= 5), contents).when(F.col("n") == 2, pairs).otherwise(opened).alias("markup"))


# -- Notes and headers ------------------------------------------------------------------------


def with_notes(blocks: DataFrame) -> DataFrame:
    """Blocks (job, page, idx, text) with ``is_note``: the page's last blocks from the first note on, at most four."""
    w = Window.partitionBy("job", "page").orderBy("idx")
    x = blocks.withColumns({"_i": F.row_number().over(w) - 1, "_n": F.count("*").over(Window.partitionBy("job", "page"))})
    first = F.when((F.col("_i") >= F.greatest(F.col("_n") - 4, F.lit(1))) & X.strip(F.col("text")).rlike(FIRST_NOTE), F.col("_i"))
    x = x.withColumn("_first", F.max(first).over(Window.partitionBy("job", "page")))
    return x.withColumn("is_note", F.coalesce(F.col("_i") >= F.col("_first"), F.lit(False))).drop("_i", "_n", "_first")


def notes_markup(notes: DataFrame) -> DataFrame:
    """(job, page, markup) of note blocks; a block without a mark runs on from the one before, the first ones are a note without label."""
    text = X.strip(F.col("text"))
    w = Window.partitionBy("job", "page").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    x = notes.select("job", "page", "idx", text.alias("t")).withColumn("marked", F.col("t").rlike(NOTE))
    x = x.withColumn("entry", F.sum(F.col("marked").cast("int")).over(w))
    body = F.when(F.col("marked"), X.strip(F.regexp_extract("t", NOTE, 2))).otherwise(F.col("t"))
    mark = F.rtrim(F.translate(F.regexp_extract("t", NOTE, 1), "⁰¹²³⁴⁵⁶⁷⁸⁹", "0123456789"), F.lit(".)] "))
    x = x.select("job", "page", "idx", "entry", F.when(F.col("marked"), mark).alias("label"), body.alias("body"))
    one = x.groupBy("job", "page", "entry").agg(F.min("idx").alias("idx"), F.max("label").alias("label"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", "body"))), lambda s: s["body"]), " ").alias("body"))
    one = one.withColumn("m", markup(F.concat(F.coalesce("label", F.lit("")), F.lit(LABEL), F.col("body"))))
    label, rest = F.get(F.split("m", LABEL, -1), F.lit(0)), F.replace(F.get(F.split("m", LABEL, -1), F.lit(1)), F.lit("\n"), F.lit(" "))
    line = F.when(label != "", fill(NOTE_MARKED, label=label, body=rest)).otherwise(fill("#par[{body}]", body=rest))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", line.alias("l")))), lambda s: s["l"]), "\n\n  ")
    return one.groupBy("job", "page").agg(joined.alias("_b")).select("job", "page", fill(NOTES, body=F.col("_b")).alias("markup"))


def without_running_headers(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Blocks (job, page, idx, type, text) without page numbers and headers at the top.

    ``pages``: (job, page, label, chapter, is_chapter, book).  On a chapter's page up to two leading blocks
    go that are headings, name the chapter or the book, or are the page's label; elsewhere a label and a
    header go together, or one of them alone.
    """
    w = Window.partitionBy("job", "page").orderBy("idx")
    p = pages.select("job", "page", F.coalesce("label", F.lit("")).alias("_label"), F.upper(F.trim(F.coalesce("chapter", F.lit("")))).alias("_ch"), F.coalesce("is_chapter", F.lit(False)).alias("_is"), F.upper(F.trim(F.coalesce("book", F.lit("")))).alias("_book"))
    x = blocks.join(p, ["job", "page"], "left").withColumns({"_i": F.row_number().over(w) - 1, "_t": X.strip(F.coalesce("text", F.lit("")))})
    named = lambda c: (F.col(c) != "") & F.upper("_t").contains(F.col(c))
    is_own = (F.col("_label") != "") & (F.lower("_t") == F.lower("_label"))
    header = (F.col("_t") != "") & (F.col("_t").rlike(RUNNING_HEADER) | ((named("_ch") | named("_book")) & (F.length("_t") < 65)))
    label = (F.col("_t") != "") & (is_own | F.col("_t").rlike(PAGE_LABEL))
    skip = F.col("type").isin("h1", "h2") | named("_ch") | named("_book") | is_own
    alone = header | (label & (F.length("_t") <= 6)) | ((F.col("type") == "h2") & (named("_ch") | named("_book")))
    x = x.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in {"_h": header, "_l": label, "_s": skip, "_a": alone}.items()})
    both = Window.partitionBy("job", "page")
    at = lambda c, i: F.coalesce(F.bool_or(F.when(F.col("_i") == i, F.col(c))).over(both), F.lit(False))
    pair = (at("_l", 0) & at("_h", 1)) | (at("_h", 0) & at("_l", 1))
    chapter = F.when(at("_s", 0), F.when(at("_s", 1), 2).otherwise(1)).otherwise(0)
    gone = F.when(F.coalesce("_is", F.lit(False)), chapter).when(pair, 2).when(at("_a", 0), 1).otherwise(0)
    return x.withColumn("_gone", gone).where(F.col("_i") >= F.col("_gone")).select(*blocks.columns)


# -- Contents ---------------------------------------------------------------------------------


def contents_markup(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """(job, page, markup) of contents pages; ``pages``: (job, page, is_first, label).

    A line without a page number joins the next one that has one; entries in capitals are major ones.  The page's
    roman number is its label, else the first line that is nothing but one.
    """
    plain = lambda c: X.strip(F.regexp_replace(c, "[*_`]", ""))
    text = X.strip(F.regexp_replace(F.coalesce("text", F.lit("")), IMAGE, ""))
    x = blocks.select("job", "page", "idx", F.posexplode(_lines(text)).alias("k", "line"))
    x = x.withColumn("p", plain(F.col("line"))).where(~F.upper("p").isin(CONTENTS_WORDS))
    roman = F.col("p").rlike("(?i)^[ivxlcdm]+$")
    w = Window.partitionBy("job", "page").orderBy("idx", "k")
    own = x.where(roman).groupBy("job", "page").agg(F.min_by(F.lower("p"), F.struct("idx", "k")).alias("_roman"))
    x = x.where(~roman)
    paged = F.col("line").rlike(r"(?iU)\s+" + PAGE_NUMBER)
    waits = ~(paged | F.col("line").startswith("|")) & ~F.col("line").rlike(MAJOR_ALONE)
    takes = F.lead(paged & ~F.col("line").startswith("|"), 1, False).over(w)
    x = x.withColumns({"joins": waits & takes, "_next": F.lead("line").over(w)}).withColumn("taken", F.coalesce(F.lag("joins").over(w), F.lit(False)))
    x = x.where(~F.col("taken")).withColumn("line", F.when(F.col("joins"), F.concat_ws(" ", "line", "_next")).otherwise(F.col("line")))
    p = plain(F.col("line"))
    cells = F.transform(F.split(F.regexp_replace("line", r"^\|+|\|+$", ""), r"\|", -1), X.strip)
    is_row = F.col("line").rlike(r"^\|.*\|")
    tables, sub = r"(?iU)^TABLES\s+(.*?)\s+" + PAGE_NUMBER, r"(?iU)^(.*?)\s+" + PAGE_NUMBER
    cat = r"(?U)^([A-Z][a-zA-Z\s]+[:;])\s*(.*)$"
    entry = lambda kind, c, t, n: F.struct(F.lit(kind).alias("kind"), c.alias("cat"), t.alias("topic"), n.alias("pno"))
    none = F.lit("")
    whole = X.strip(F.regexp_extract(p, sub, 1))
    parsed = (
        F.when(is_row & F.forall(cells, lambda c: c.rlike("^-*$")), F.array().cast("array<struct<kind:string,cat:string,topic:string,pno:string>>"))
        .when(is_row & (F.size(cells) >= 3), F.array(entry("sub", F.get(cells, F.lit(0)), F.get(cells, F.lit(1)), F.get(cells, F.lit(2)))))
        .when(is_row & (F.size(cells) == 2), F.array(entry("sub", none, F.get(cells, F.lit(0)), F.get(cells, F.lit(1)))))
        .when(p.rlike(tables), F.array(entry("major", none, F.lit("TABLES"), none), entry("sub", none, X.strip(F.regexp_extract(p, tables, 1)), F.regexp_extract(p, tables, 2))))
        .when(p.rlike(MAJOR), F.array(entry("major", none, X.strip(F.regexp_extract(p, MAJOR, 1)), F.coalesce(F.regexp_extract(p, MAJOR, 2), none))))
        .when(p.rlike(sub) & whole.rlike(cat), F.array(entry("sub", F.replace(F.regexp_extract(whole, cat, 1), F.lit(";"), F.lit(":")), X.strip(F.regexp_extract(whole, cat, 2)), F.regexp_extract(p, sub, 2))))
        .when(p.rlike(sub), F.array(entry("sub", none, whole, F.regexp_extract(p, sub, 2))))
        .otherwise(F.array(entry("other", none, p, none)))
    )
    e = x.select("job", "page", "idx", "k", F.posexplode(parsed).alias("j", "e")).select("job", "page", "idx", "k", "j", "e.*")
    e = e.withColumn("m", F.split(markup(F.concat_ws(LABEL, "cat", "topic")), LABEL, -1)).withColumns({"cat": F.get("m", F.lit(0)), "topic": F.get("m", F.lit(1)), "pno": X.escape_typst(F.col("pno"))})
    number = F.when(F.col("pno") != "", fill(MAJOR_PAGE, page=F.col("pno"))).otherwise("[]")
    category = F.when(F.col("cat") != "", fill('[#text(size: 8.5pt, weight: "medium")[{c}]]', c=F.col("cat"))).otherwise("[]")
    subrow = fill("  {c}, [#text(size: 8.5pt)[{t}]], [#align(right)[#text(size: 8.5pt)[{p}]]],", c=category, t=F.col("topic"), p=F.col("pno"))
    row = F.when(F.col("kind") == "major", fill(MAJOR_ROW, body=F.col("topic"), page=number)).when(F.col("kind") == "sub", subrow).otherwise(fill(OTHER_ROW, body=F.col("topic")))
    body = e.groupBy("job", "page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", "k", "j", row.alias("r")))), lambda s: s["r"]), "\n").alias("_b"))
    out = pages.join(body, ["job", "page"], "left").join(own, ["job", "page"], "left")
    label = F.when(F.col("label").rlike("(?i)^[ivxlcdm]+$"), F.col("label")).otherwise(F.coalesce("_roman", F.lit("")))
    rows = F.concat_ws("\n", F.when(F.col("is_first"), CONTENTS_HEAD), F.col("_b"))
    return out.select("job", "page", fill(CONTENTS_PAGE, first=F.col("is_first").cast("string"), roman=label, body=rows).alias("markup"))


# -- Images -----------------------------------------------------------------------------------


def image_markup(path: Column, width: Column, page_width: Column) -> Column:
    """A figure by the share of the page's width that it takes."""
    share = width / page_width
    size = F.when(share > 0.5, "width: 85%").when(share > 0.3, "width: 55%").otherwise("height: 50pt")
    return fill('#align(center)[#image("{path}", {size})]', path=path, size=size)


def glyphs_below(pairs: Column) -> Column:
    """A row of images with their labels below; ``pairs``: array of (label, path), labels as plain text."""
    n = F.size(pairs)
    image = F.transform(pairs, lambda p: F.when(p["path"].isNotNull(), F.concat(F.lit('image("'), p["path"], F.lit('", height: 42pt)'))).otherwise("[]"))
    label = F.transform(pairs, lambda p: F.concat(F.lit("[#strong["), p["label"], F.lit("]]")))
    return fill(BELOW_GRID, columns=F.array_join(F.array_repeat(F.lit("65pt"), n), ", "), aligns=F.array_join(F.array_repeat(F.lit("horizon + center"), n), ", "), images=F.array_join(image, ", "), labels=F.array_join(label, ", "))


def glyphs_beside(pairs: Column) -> Column:
    """Labels beside images, in two columns: a pair whose image stands right of the middle goes right of the one before it.

    ``pairs``: array of (label, path, x, page_w).
    """
    half = lambda p: F.concat(F.lit("[#strong["), p["label"], F.lit("]], "), F.when(p["path"].isNotNull(), F.concat(F.lit('image("'), p["path"], F.lit('", height: 44pt)'))).otherwise("[]"))
    right = lambda p: F.coalesce(p["x"] >= p["page_w"] * 0.52, F.lit(False))

    def step(acc: Column, p: Column) -> Column:
        """Rows so far, and whether the last one still has a place to its right."""
        joins = acc["open"] & right(p)
        last = F.element_at(acc["rows"], -1)
        rows = F.when(joins, F.concat(F.slice(acc["rows"], 1, F.size(acc["rows"]) - 1), F.array(F.concat(last, F.lit(", "), half(p), F.lit(",")))))
        closed = F.when(acc["open"], F.concat(F.slice(acc["rows"], 1, F.size(acc["rows"]) - 1), F.array(F.concat(last, F.lit(", [], [],"))))).otherwise(acc["rows"])
        return F.struct(F.coalesce(rows, F.concat(closed, F.array(F.concat(F.lit("  "), half(p), F.lit(", []"))))).alias("rows"), (~joins).alias("open"))

    zero = F.struct(F.array().cast("array<string>").alias("rows"), F.lit(False).alias("open"))
    done = lambda acc: F.when(acc["open"], F.concat(F.slice(acc["rows"], 1, F.size(acc["rows"]) - 1), F.array(F.concat(F.element_at(acc["rows"], -1), F.lit(", [], [],"))))).otherwise(acc["rows"])
    return fill(BESIDE_GRID, body=F.array_join(F.aggregate(pairs, zero, step, done), "\n"))


# -- Pages and documents ----------------------------------------------------------------------


def chapters(blocks: DataFrame, toc: DataFrame) -> DataFrame:
    """(job, page, is_chapter, chapter, heading): pages that open a chapter, and the chapter of each page.

    A page opens one if contents (job, ord, level, title, page) name it at their first level, the last entry counting, or its
    first block is an h1 or a heading like those of running headers.  ``heading`` is what is shown: such a
    heading in capitals, else the title up to a colon.
    """
    w = Window.partitionBy("job", "page").orderBy("idx")
    first = blocks.where(X.strip(F.coalesce("text", F.lit(""))) != "").withColumn("_i", F.row_number().over(w)).where("_i = 1").select("job", "page", "type", X.strip(F.col("text")).alias("t"))
    named = toc.where("level = 1").groupBy("job", "page").agg(F.max_by("title", "ord").alias("title"))
    p = blocks.select("job", "page").distinct().join(first, ["job", "page"], "left").join(named, ["job", "page"], "left")
    like = F.coalesce(F.col("t").rlike(RUNNING_HEADER), F.lit(False))
    opens = F.col("title").isNotNull() | F.coalesce(((F.col("type") == "h2") & like) | (F.col("type") == "h1"), F.lit(False))
    shown = F.when(like, F.upper("t")).otherwise(X.strip(F.regexp_replace(F.coalesce("title", "t"), r"(?s):.*$", "")))
    p = p.withColumns({"is_chapter": opens, "heading": F.when(opens, shown)})
    before = Window.partitionBy("job").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    return p.select("job", "page", "is_chapter", F.last("heading", ignorenulls=True).over(before).alias("chapter"), "heading")


def page_markup(blocks: DataFrame, pages: DataFrame, toc: DataFrame, two_columns: bool = False, sidehead_dx: float = -160.0, sidehead_width: float = 115.0) -> DataFrame:
    """(job, page, markup): every page of ``pages`` (job, page, label, book) with the blocks (job, page, idx, type, text) it holds.

    Headers at the top go, notes at the bottom get their own block, table rows that follow one another are a
    table; a block of Markdown table lines is one too.  A chapter's heading stands first.
    """
    ch = chapters(blocks, toc)
    info = pages.join(ch, ["job", "page"], "left")
    x = blocks.where(X.strip(F.coalesce("text", F.lit(""))) != "")
    x = with_notes(without_running_headers(x, info))
    x = x.withColumn("text", X.strip(F.regexp_replace("text", IMAGE, ""))).where("text <> ''")
    notes = notes_markup(x.where("is_note")).select("job", "page", F.lit(1 << 40).alias("idx"), "markup")
    x = x.where("not is_note").select("job", "page", F.col("idx").cast("long").alias("idx"), "type", "text")
    marked = F.filter(_lines(F.col("text")), lambda s: s.startswith("|"))
    inner = (F.size(marked) >= 2) & F.exists(marked, lambda s: s.contains("---"))
    x = x.withColumns({"is_table": (F.col("type") == "table_row") | inner})
    # neighbouring rows are one table, a block of table lines stands alone
    w = Window.partitionBy("job", "page").orderBy("idx")
    begins = F.col("is_table") & ~((F.col("type") == "table_row") & F.coalesce(F.lag("type").over(w) == "table_row", F.lit(False)))
    x = x.withColumn("table", F.sum(begins.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = x.where("is_table").select("job", "page", "table", F.col("idx").alias("at"), F.posexplode(F.when(F.col("type") == "table_row", F.array("text")).otherwise(marked)).alias("k", "text"))
    starts = rows.groupBy("job", "page", "table").agg(F.min("at").alias("idx"))
    tables = table_markup(rows.withColumn("o", F.struct("at", "k")), ["job", "page", "table"], "o").join(starts, ["job", "page", "table"]).select("job", "page", "idx", "markup")
    side = (F.col("type") == "sidehead") & ~F.col("is_table")
    level = F.regexp_extract("type", r"^h(\d)$", 1).try_cast("int")
    heads = x.where("not is_table").where(side | level.isNotNull())
    inline = F.replace(markup(F.col("text")), F.lit("\n"), F.when(F.col("type") == "sidehead", " \\ ").otherwise("\n"))
    depth = F.least(level + 1, F.lit(3)) if two_columns else F.greatest(level, F.lit(2))
    shown = F.when(F.col("type") == "sidehead", F.concat(F.lit(f"#sidehead(dx: {sidehead_dx}pt, width: {sidehead_width}pt)["), inline, F.lit("]"))).otherwise(F.concat(F.array_join(F.array_repeat(F.lit("="), depth), ""), F.lit(" "), inline))
    heads = heads.select("job", "page", "idx", shown.alias("markup"))
    body = block_markup(x.where("not is_table").where(~side & level.isNull())).select("job", "page", "idx", "markup")
    title = ch.where("is_chapter").select("job", "page", F.lit(-1).cast("long").alias("idx"), F.concat(F.lit("= "), markup(F.col("heading"))).alias("markup"))
    every = body.unionByName(heads).unionByName(tables).unionByName(notes).unionByName(title).where("markup <> ''")
    made = every.groupBy("job", "page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", "markup"))), lambda s: s["markup"]), "\n\n").alias("markup"))
    return pages.select("job", "page").join(made, ["job", "page"], "left").select("job", "page", F.coalesce("markup", F.lit("")).alias("markup"))


def document(pages: DataFrame, metadata: DataFrame, preserve_pages: bool = True, template: str = "/templates/book.typ") -> DataFrame:
    """(job, content): a Typst source from pages (job, page, label, markup, is_chapter) and metadata (job, title, author, date, language, front_pages)."""
    quote = lambda c, other: F.concat(F.lit('"'), X.escape_typst(F.coalesce(F.col(c), F.lit(other))), F.lit('"'))
    label = F.coalesce("label", F.lit(""))
    cite = F.when(label != "", label).otherwise(F.col("page").cast("string"))
    head = fill("// --- Original Page {n} (printed: {l}) ---\n", n=F.col("page").cast("string"), l=label)
    last = F.lead("page").over(Window.partitionBy("job").orderBy("page")).isNull()
    first = F.lag("page").over(Window.partitionBy("job").orderBy("page")).isNull()
    if preserve_pages:
        one = F.concat(head, F.lit("#fit-page[\n"), F.col("markup"), F.lit("\n]\n"), F.when(last, "").otherwise("#pagebreak()\n"))
    else:
        one = F.concat(head, F.when(F.coalesce("is_chapter", F.lit(False)) & ~first, "#pagebreak(weak: true)\n").otherwise(""), F.lit('#orig-page("'), cite, F.lit('")\n'), F.col("markup"), F.lit("\n"))
    p = pages.withColumns({"_one": one, "_l": F.concat(F.lit('"'), label, F.lit('"'))})
    ordered = lambda c, sep: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", c))), lambda s: s[c]), sep)
    books = p.groupBy("job").agg(ordered("_one", "\n").alias("_body"), ordered("_l", ", ").alias("_labels"))
    lang = F.element_at(F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv]), F.lower(F.trim(F.split_part(F.coalesce("language", F.lit("deu")), F.lit("+"), F.lit(1)))))
    top = F.concat(
        F.lit(f'#import "{template}": book, orig-page, fit-page, page-footnotes, sidehead, book-half-title, book-title-page, book-imprint-page, book-toc-page, book-lesson-page\n#show: book.with(\n  title: '),
        quote("title", "Untitled Book"), F.lit(",\n  author: "), quote("author", ""), F.lit(',\n  date: "'), F.coalesce(F.substring("date", 1, 10), F.lit("")),
        F.lit(f'",\n  paper: "iso-b5",\n  preserve_pages: {str(preserve_pages).lower()},\n  lang: "'), F.coalesce(lang, F.lit("de")),
        F.lit('",\n  page_labels: ('), F.col("_labels"), F.lit("),\n  front_matter_pages: "), F.coalesce("front_pages", F.lit(0)).cast("string"), F.lit("\n)\n\n#let page_content = fit-page\n\n"),
    )
    return books.join(metadata, "job").select("job", F.concat(top, F.col("_body")).alias("content"))
