"""Front matter: title, imprint, contents and lesson pages, and where a book's body begins.

Blocks (job, page, idx, text) in; pages count from 1.  A null text reads as empty.  What depends on
the blocks before it is a running maximum or count over the page's window, and what depends on the
page before it is the last decisive page of the job's window, so nothing walks a book page by page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiremill.functions import text as X
from quiremill.operators.structure import page_labels

PAGE = ["job", "page"]

# Words that mark the kinds of front matter, and the page ranges and lengths that go with them.
CONTENTS_HEADS = ("CONTENTS", "TABLE OF CONTENTS", "INHALT")
NOT_TITLE = ("contents", "table of contents", "isbn", "copyright", "all rights reserved", "also available at")
PUBLISHERS = ("publisher", "publishers", "press", "verlag", "edition", "published by", "limited", "ltd")
IMPRINT_HOUSES = ("publisher", "publishers", "press", "verlag")
BOUNDARY_IMPRINT = ("isbn", "all rights reserved", "first edition", "first published", "printed in")
CITY_CODES = ("delhi 110", "mumbai 400", "bangalore 560", "kolkata 700", "calcutta 700", "varanasi 221", "chennai 600", "pune 411", "patna 800")
EDITION_MARKS = ("edition:", "published:", "reprint:")
LESSON_GROUPS = ("Alphabet:", "Aphabet:", "Grammar:", "Vocabulary:", "Recitation:", "Readings:", "Exercises:", "Conversation:", "Pronunciation:", "Meter:", "Sandhi:")
UNITS = ("ONE", "TWO", "THREE", "FOUR", "FIVE", "SIX", "SEVEN", "EIGHT", "NINE", "TEN", "ELEVEN", "TWELVE", "THIRTEEN", "FOURTEEN", "FIFTEEN", "SIXTEEN", "SEVENTEEN", "EIGHTEEN", "NINETEEN")
TITLE_PAGES, IMPRINT_PAGES, CONTENTS_PAGES, BOUNDARY_PAGES = 4, 5, 25, 30
LONGEST_TITLE, LONGEST_IMPRINT = 400, 1600
MOST_LESSON_BLOCKS = 12
#: The last lesson number that is read as a word.
LAST_NUMBER_WORD = 32
# A line that ends in a page number from 1 to 399, and one that ends in any Arabic or Roman number.
ENDS_IN_PAGE = r"(?:[1-9]|[1-9]0|[1-3]00)$"
ENDS_IN_NUMBER = r"(?i)\b(?:\d+|[ivxlcdm]+)$"


def _any(c: Column, words: tuple[str, ...]) -> Column:
    """Whether the text holds one of the words."""
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def _number_words() -> dict[str, int]:
    words = {w: i + 1 for i, w in enumerate(UNITS)}
    tens = {"TWENTY": 20, "THIRTY": 30}
    words |= tens | {f"{t}-{u}": n + i + 1 for t, n in tens.items() for i, u in enumerate(UNITS[:9])}
    return {w: n for w, n in words.items() if n <= LAST_NUMBER_WORD}


def page_texts(blocks: DataFrame) -> DataFrame:
    """(job, page, texts, text, n_blocks): a page's block texts in order, and joined by blanks."""
    t = F.struct("idx", F.coalesce("text", F.lit("")).alias("t"))
    p = blocks.groupBy(*PAGE).agg(F.transform(F.array_sort(F.collect_list(t)), lambda x: x.t).alias("texts"))
    return p.select(*PAGE, "texts", F.array_join("texts", " ").alias("text"), F.size("texts").alias("n_blocks"))


def _lines(texts: Column) -> Column:
    """Stripped lines of all blocks."""
    return F.transform(F.flatten(F.transform(texts, X.split_lines)), X.strip)


def title_pages(pages: DataFrame, metadata: DataFrame) -> DataFrame:
    """Pages of ``page_texts`` that are title pages: (job, page, kind, title, subtitle, author, publisher).

    ``metadata``: (job, title, author).  A title page is among the first four, short, holds the
    title or a longer word of it, and none of the words of an imprint.  With the author or a
    publisher it is ``full_title``; else, of five blocks at most, ``half_title``.
    """
    m = metadata.select("job", F.coalesce("title", F.lit("")).alias("_t"), X.strip(F.coalesce("author", F.lit(""))).alias("_a"))
    p = pages.where((F.col("page") <= TITLE_PAGES) & (F.length("text") <= LONGEST_TITLE)).withColumn("_l", F.lower("text")).where(~_any(F.col("_l"), NOT_TITLE))
    plain = F.lower(X.strip(F.regexp_replace("_t", r"\(.*?\)", "")))
    p = p.join(m, "job").withColumn("_plain", plain)
    word = F.exists(F.filter(F.split("_plain", r"\s+"), lambda w: F.length(w) >= 4), lambda w: F.col("_l").contains(w))
    p = p.where(((F.length("_plain") >= 4) & F.col("_l").contains(F.col("_plain"))) | word)
    has_author = (F.length("_a") >= 3) & F.col("_l").contains(F.lower("_a"))
    full = has_author | _any(F.col("_l"), PUBLISHERS)
    part = F.when(F.col("_l").contains("part one"), "Part One").when(F.col("_l").contains("part two"), "Part Two")
    after = F.when(F.col("_t").contains(":"), X.strip(F.regexp_extract("_t", r"(?s):(.*)$", 1)))
    house = F.transform(F.filter("texts", lambda t: _any(F.lower(t), PUBLISHERS)), X.strip)
    return p.select(
        *PAGE,
        F.when(full, "full_title").when(F.col("n_blocks") <= 5, "half_title").alias("kind"),
        X.strip(F.regexp_extract("_t", r"^[^(]*", 0)).alias("title"),
        F.coalesce(part, after, F.lit("")).alias("subtitle"),
        F.when(full & (F.col("_a") != ""), F.col("_a")).alias("author"),
        F.when(full, F.array_join(house, "\n")).alias("publisher"),
    ).where("kind is not null")


def imprint_parts(blocks: DataFrame) -> DataFrame:
    """Blocks of imprint pages with their ``part``: (job, page, idx, part, text).

    An imprint is among the first five pages, of at most 1,600 characters, without contents, with
    ISBN, rights or edition marks.  Parts: sales, colophon (from the first block on printing),
    isbn, copyright, available, publisher, address, edition.  A house is the publisher only before
    the first address; blocks without a mark are editions until an ISBN or publisher was seen, then colophon.
    """
    b = blocks.where(F.col("page") <= IMPRINT_PAGES).select(*PAGE, "idx", F.coalesce("text", F.lit("")).alias("text"))
    p = page_texts(b).where(F.length("text") <= LONGEST_IMPRINT).withColumn("_l", F.lower("text"))
    marked = _any(F.col("_l"), ("isbn", "all rights reserved", "copyright", "©", "first edition", "first published")) | (F.col("_l").contains("printed in") & F.col("_l").contains("press"))
    p = p.where(marked & ~_any(F.col("_l"), ("contents", "inhalt"))).select(*PAGE)
    b = b.join(p, PAGE).withColumn("text", X.strip(F.col("text"))).where("text <> ''").withColumn("_l", F.lower("text"))
    l, w = F.col("_l"), Window.partitionBy(*PAGE).orderBy("idx")
    so_far, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    printing = _any(l, ("printed in", "printed by")) | (l.contains("press") & l.contains("printed"))
    # What a block would be by its own words; the running flags then settle it.
    b = b.withColumn("_own", F.when(_any(l, ("for sale in", "territory")), "sales").when(printing, "colophon"))
    b = b.withColumn("_closing", F.coalesce(F.max(F.col("_own") == "colophon").over(so_far), F.lit(False)))
    house = _any(l, IMPRINT_HOUSES) & (F.length("text") < 70)
    plain = (
        F.when(l.contains("isbn:"), "isbn")
        .when(_any(l, ("©", "all rights reserved")), "copyright")
        .when(_any(l, ("also available at", "available at:")), "available")
        .when(house, "house")
        .when(_any(l, CITY_CODES), "address")
        .when(_any(l, EDITION_MARKS), "edition")
    )
    b = b.withColumn("_own", F.when(F.col("_own") == "sales", "sales").when(F.col("_closing"), "colophon").otherwise(plain))
    addressed = F.coalesce(F.max(F.col("_own") == "address").over(before), F.lit(False))
    late_house = F.when(_any(l, CITY_CODES), "address").when(_any(l, EDITION_MARKS), "edition")
    b = b.withColumn("_own", F.when(F.col("_own") == "house", F.when(~addressed, "publisher").otherwise(late_house)).otherwise(F.col("_own")))
    known = F.coalesce(F.max(F.col("_own").isin("isbn", "publisher")).over(before), F.lit(False))
    return b.select(*PAGE, "idx", F.coalesce("_own", F.when(known, "colophon").otherwise("edition")).alias("part"), "text")


def imprints(blocks: DataFrame) -> DataFrame:
    """A row per imprint page: (job, page, editions, copyright, isbn, available_at, publisher, addresses, sales, colophon).

    Addresses part behind postal codes and editions behind years; of several ISBNs, publishers,
    sales or availability notes the last counts.
    """
    parts = imprint_parts(blocks)
    codes = F.split(F.regexp_replace("text", r"(\b\d{3}\s*\d{3}\b|\b\d{6}\b)\s+", "$1\n"), "\n")
    years = F.when(F.lower("text").rlike("edition:|published:|reprint:"), F.split("text", r"(?<=\d{4})\s+(?=[A-Z])")).otherwise(F.array("text"))
    pieces = F.when(F.col("part") == "address", codes).when(F.col("part") == "edition", years).otherwise(F.array("text"))
    parts = parts.withColumn("_p", F.filter(F.transform(pieces, X.strip), lambda x: x != ""))

    def kept(part: str) -> Column:
        rows = F.array_sort(F.collect_list(F.when(F.col("part") == part, F.struct("idx", "_p"))))
        return F.flatten(F.transform(rows, lambda x: x["_p"]))

    def last(part: str) -> Column:
        return F.coalesce(F.max_by(F.when(F.col("part") == part, F.col("text")), F.when(F.col("part") == part, F.col("idx"))), F.lit(""))

    return parts.groupBy(*PAGE).agg(
        kept("edition").alias("editions"), F.array_join(kept("copyright"), "\n").alias("copyright"), last("isbn").alias("isbn"), last("available").alias("available_at"),
        last("publisher").alias("publisher"), kept("address").alias("addresses"), last("sales").alias("sales"), kept("colophon").alias("colophon"),
    )


def contents_pages(pages: DataFrame, body: DataFrame | None = None) -> DataFrame:
    """Pages of ``page_texts`` with ``is_contents``.

    A line that says so opens the contents; they go on over pages with two or more lines that end in
    a number and a lesson, group, table or index among them.  No page behind the 25th, or from
    ``body`` (job, body_start) on, belongs to them.
    """
    p = pages
    if body is not None:
        p = p.join(body.select("job", "body_start"), "job", "left")
    ahead = F.col("page") <= CONTENTS_PAGES
    if body is not None:
        ahead = ahead & F.coalesce(F.col("page") < F.col("body_start"), F.lit(True))
    heads = F.transform(_lines(F.col("texts")), lambda x: F.upper(X.strip(F.regexp_replace(x, r"[*_`]", ""))))
    opens = F.arrays_overlap(heads, F.array(*map(F.lit, CONTENTS_HEADS)))
    whole = F.transform(X.split_lines(F.col("text")), X.strip)
    listed = F.size(F.filter(whole, lambda x: x.rlike(ENDS_IN_NUMBER))) >= 2
    kinds = F.col("text").rlike(r"(?i)LESSON\s+[A-Z\d\-]+") | F.col("text").rlike(r"(?:Alphabet|Grammar|Vocabulary|Recitation):") | _any(F.upper("text"), ("TABLES", "INDEX"))
    # The last page up to this one that opens the contents or can't belong to them decides.
    decisive = F.when(ahead & F.coalesce(opens, F.lit(False)), True).when(~(ahead & listed & kinds), False)
    w = Window.partitionBy("job").orderBy("page")
    return p.withColumn("is_contents", F.coalesce(F.last(decisive, ignorenulls=True).over(w), F.lit(False))).select(*pages.columns, "is_contents")


def lesson_pages(blocks: DataFrame) -> DataFrame:
    """Pages that open a lesson: (job, page, number, title, syllabus array<struct<name, items>>).

    Such a page has at most twelve blocks, names a lesson and two or more groups, and its lines
    divide into two groups or more.  ``number`` is null for words that aren't numbers.
    """
    p = page_texts(blocks).where(F.col("n_blocks") <= MOST_LESSON_BLOCKS)
    word = F.upper(F.regexp_extract("text", r"(?i)\bLESSON\s+([A-Z\-]+|\d+)\b", 1))
    named = sum((F.col("text").rlike(rf"(?i)\b{g}").cast("int") for g in LESSON_GROUPS[1:]), F.col("text").rlike(rf"(?i)\b{LESSON_GROUPS[0]}").cast("int"))
    p = p.withColumn("_word", word).where((F.col("_word") != "") & (named >= 2))
    numbers = F.create_map(*[F.lit(x) for pair in _number_words().items() for x in pair])
    number = F.coalesce(F.element_at(numbers, F.col("_word")), F.col("_word").try_cast("int"))
    lines = p.select(*PAGE, F.posexplode(_lines(F.col("texts"))).alias("_i", "_line"))
    lines = lines.where((F.col("_line") != "") & ~F.col("_line").startswith("#") & ~F.col("_line").rlike(r"(?i)^LESSON\s+[A-Z\-]+$"))
    head = F.regexp_extract("_line", r"^([A-Z][a-zA-Z\s]+:)", 1)
    known = "|".join(g.rstrip(":").lower() for g in LESSON_GROUPS)
    lines = lines.withColumn("_name", F.when(F.lower(head).rlike(f"^(?:{known})"), head))
    w = Window.partitionBy(*PAGE).orderBy("_i")
    lines = lines.withColumn("_group", F.count("_name").over(w)).where("_group > 0")
    item = F.when(F.col("_name").isNull(), F.col("_line")).otherwise(X.strip(F.expr("substring(_line, length(_name) + 1)")))
    rows = F.array_sort(F.collect_list(F.struct("_i", item.alias("t"))))
    groups = lines.groupBy(*PAGE, "_group").agg(F.min_by("_name", "_i").alias("name"), F.filter(F.transform(rows, lambda x: x.t), lambda t: t != "").alias("items"))
    name = F.when(F.lower("name") == "aphabet:", "Alphabet:").otherwise(F.col("name"))
    syllabus = F.transform(F.array_sort(F.collect_list(F.struct("_group", name.alias("name"), "items"))), lambda x: F.struct(x["name"].alias("name"), x["items"].alias("items")))
    pages = groups.groupBy(*PAGE).agg(syllabus.alias("syllabus")).where(F.size("syllabus") >= 2)
    return p.select(*PAGE, number.alias("number"), F.concat(F.lit("LESSON "), "_word").alias("title")).join(pages, PAGE)


# First lessons by contents (strict, then any) and by the top of a page.
FIRST_LESSON = r"(?iU)^\s*(?:Lesson|Chapter|Kapitel|Teil|Part)\s*(?:1|One|I|Erstes|19)\b"
ANY_LESSON = r"(?iU)^\s*(?:Lesson|Chapter|Kapitel)\s*\d+"
LESSON_PAGE = r"(?iU)^(?:LESSON\s+(?:ONE|1|NINETEEN|19)|CHAPTER\s+(?:ONE|1)|KAPITEL\s+1)\b"


def first_body_page(pages: DataFrame, blocks: DataFrame, toc: DataFrame) -> DataFrame:
    """(job, first): ordinal from 1 of the page on which the body begins, for each job of ``pages`` (job, page).

    The first entry of contents (job, ord, level, title, page) at the first level that names a first lesson, else any lesson; else
    the first of 35 pages whose first three blocks begin with a first lesson; else 1.
    """
    top = toc.where("level = 1")
    named = top.groupBy("job").agg(*[F.min_by("page", F.when(F.col("title").rlike(p), F.col("ord"))).alias(n) for n, p in (("a", FIRST_LESSON), ("b", ANY_LESSON))])
    w = Window.partitionBy("job").orderBy("page")
    n = pages.select("job", "page").distinct().withColumn("n", F.row_number().over(w))
    k = Window.partitionBy("job", "page").orderBy("idx")
    texts = blocks.withColumn("_k", F.row_number().over(k)).where("_k <= 3").groupBy("job", "page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_k", "text"))), lambda s: s["text"]), " ").alias("t"))
    seen = n.where("n <= 35").join(texts, ["job", "page"]).where(X.strip(F.col("t")).rlike(LESSON_PAGE)).groupBy("job").agg(F.min("n").alias("c"))
    out = pages.select("job").distinct().join(named, "job", "left").join(seen, "job", "left")
    return out.select("job", F.coalesce(F.nullif("a", F.lit(0)), F.nullif("b", F.lit(0)), "c", F.lit(1)).cast("int").alias("first"))


def printed_labels(pages: DataFrame, blocks: DataFrame, toc: DataFrame) -> DataFrame:
    """(job, page, label): the printed number of each page (job, page, printed), by ``structure.page_labels``.

    The body begins at ``first_body_page``; Roman numbers of front matter are those that stand alone in one of a page's first four blocks.
    """
    w = Window.partitionBy("job").orderBy("page")
    k = Window.partitionBy("job", "page").orderBy("idx")
    found = blocks.withColumn("_k", F.row_number().over(k)).where("_k <= 4").withColumn("r", F.lower(X.strip(F.coalesce("text", F.lit("")))))
    found = found.where(F.col("r").rlike("^[ivxlcdm]{1,6}$")).groupBy("job", "page").agg(F.min_by("r", "_k").alias("r"))
    x = pages.select("job", "page", F.coalesce(F.col("printed").cast("string"), F.lit("")).alias("printed_page"), (F.row_number().over(w) - 1).alias("idx"))
    x = x.join(found, ["job", "page"], "left").join(first_body_page(pages, blocks, toc), "job")
    labels = page_labels(x.select("job", "idx", "printed_page", F.coalesce("r", F.lit("")).alias("roman"), F.col("first").alias("body_start")))
    return x.select("job", "page", "idx").join(labels.select("job", "idx", "label"), ["job", "idx"]).select("job", "page", "label")


def body_start(blocks: DataFrame, metadata: DataFrame, sidehead_pages: DataFrame | None = None) -> DataFrame:
    """(job, body_start): the page behind the last of front matter within the first thirty, else 1.

    Front matter: pages with contents and those that run on from them (they mention contents or have
    three lines that end in a page number); elsewhere title pages, imprints, and short pages among
    the first three.  ``sidehead_pages`` (job, page): the body doesn't begin before the first of them
    from page 4 on.
    """
    p = page_texts(blocks).where(F.col("page") <= BOUNDARY_PAGES)
    titles = title_pages(p, metadata).select(*PAGE, F.lit(True).alias("_title")).distinct()
    lower = F.lower(X.strip(F.col("text")))
    heads = F.transform("texts", lambda t: F.upper(X.strip(t)))
    opens = F.arrays_overlap(heads, F.array(*map(F.lit, CONTENTS_HEADS))) | lower.contains("table of contents")
    whole = F.transform(X.split_lines(X.strip(F.col("text"))), X.strip)
    runs_on = lower.contains("contents") | (F.size(F.filter(whole, lambda x: x.rlike(ENDS_IN_PAGE))) >= 3)
    p = p.join(titles, PAGE, "left").select(
        *PAGE, opens.alias("_opens"), runs_on.alias("_on"),
        (F.coalesce("_title", F.lit(False)) | _any(lower, BOUNDARY_IMPRINT) | ((F.col("page") <= 3) & (F.length(lower) < 300))).alias("_other"),
    )
    before = Window.partitionBy("job").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.last(F.when(F.col("_opens"), True).when(~F.col("_on"), False), ignorenulls=True).over(before), F.lit(False))
    front = F.col("_opens") | F.when(within, F.col("_on")).otherwise(F.col("_other"))
    ends = p.withColumn("_front", front).groupBy("job").agg((F.coalesce(F.max(F.when(F.col("_front"), F.col("page"))), F.lit(0)) + 1).cast("int").alias("body_start"))
    out = blocks.select("job").distinct().join(ends, "job", "left").select("job", F.coalesce("body_start", F.lit(1)).alias("body_start"))
    if sidehead_pages is None:
        return out
    first = sidehead_pages.where("page >= 4").groupBy("job").agg(F.min("page").cast("int").alias("_first"))
    return out.join(first, "job", "left").select("job", F.greatest("body_start", F.coalesce("_first", F.lit(1))).alias("body_start"))
