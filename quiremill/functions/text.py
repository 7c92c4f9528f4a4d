"""Text functions on columns.  All are expressions that stay in the JVM.

``\\w``, ``\\d``, ``\\s`` are Unicode-aware where the pattern begins with ``(?U)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# -- Fixed values -----------------------------------------------------------------------------
LATIN = r"A-Za-z\u00C0-\u024F\u1E00-\u1EFF"
DEVANAGARI_DIGITS = "०१२३४५६७८९"
TELUGU_DIGITS = "౦౧౨౩౪౫౬౭౮౯"
GUJARATI_DIGITS = "૦૧૨૩૪૫૬૭૮૯"
ARABIC_DIGITS = "0123456789"
SUPERSCRIPT_DIGITS = "⁰¹²³⁴⁵⁶⁷⁸⁹"
ROGUE_SCRIPTS = r"[\u0590-\u05FF\u0C00-\u0C7F]+"
CJK = r"[\u4e00-\u9fff]"
LIST_ITEM = r"^(\d+[.)]|[a-zA-Z][.)]|[-*•])\s+"
HALLUCINATIONS = ["ground truth image displays", "underscore & line rules"]
BOILERPLATE = [
    r"universit[äa]ts[-\s]*bibliothek\s+heidelberg",
    r"badische\s+landesbibliothek",
    r"bayerische\s+staatsbibliothek",
    r"staatsbibliothek\s+zu\s+berlin",
    r"digi\.ub\.uni-heidelberg\.de",
    r"gef[öo]rdert\s+durch",
    r"baden-w[üu]rttemberg",
    r"^\[LOGO\]",
    r"©\s*universit[äa]tsbibliothek",
]
ROMAN = [(1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")]
# ---------------------------------------------------------------------------------------------


def strip(c: Column) -> Column:
    """Without white space of any script at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def split_lines(c: Column) -> Column:
    """Lines at every line boundary, without an empty one at the end."""
    lines = F.split(c, r"\R")
    return F.when(F.element_at(lines, -1) == "", F.slice(lines, F.lit(1), F.greatest(F.size(lines) - 1, F.lit(0)))).otherwise(lines)


def dehyphenate(c: Column) -> Column:
    """Joins a word that a hyphen and a line break part."""
    return F.regexp_replace(c, rf"([{LATIN}]+)-\n\s*([{LATIN}]+)", "$1$2")


def join_lines(lines: Column) -> Column:
    """Lines as one paragraph: a hyphen between letters goes with the break, else a blank stands there."""

    def add(text: Column, line: Column) -> Column:
        glue = text.rlike(r"(?U)\p{L}-$") & line.rlike(r"(?U)^\p{L}")
        return F.when(text == "", line).when(glue, F.concat(F.regexp_replace(text, "-$", ""), line)).otherwise(F.concat(text, F.lit(" "), line))

    return F.aggregate(F.transform(lines, strip), F.lit(""), add)


def token_key(c: Column) -> Column:
    """ASCII letters and digits only, lower-cased."""
    return F.lower(F.regexp_replace(c, "[^a-zA-Z0-9]", ""))


def heading_level(c: Column) -> Column:
    """Number of ``#`` of a heading with text, 1 for ``#`` without a blank, null for no heading."""
    level = F.length(F.regexp_extract(c, r"(?s)^(#+)\s+.+$", 1))
    return F.when(level > 0, level).when(c.startswith("#"), 1)


def heading_text(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"^#+\s*", ""))


def block_type(content: Column, source_type: Column) -> Column:
    """Type of a block from its text and the type that the OCR gave; table rows aside."""
    level = heading_level(content)
    return (
        F.when(level.isNotNull(), F.concat(F.lit("h"), level.cast("string")))
        .when(source_type == "title", "h1")
        .when(source_type == "header", "h2")
        .when(source_type == "image", "image")
        .otherwise("p")
    )


def is_table_row(c: Column) -> Column:
    return c.startswith("|") & c.endswith("|")


def is_list_item(c: Column) -> Column:
    return c.rlike(LIST_ITEM)


def concordance_tokens(c: Column) -> Column:
    """Words, lower-cased, without single characters but a, i and u."""
    words = F.regexp_extract_all(F.lower(c), F.lit(r"(?U)\b[\w\-]+\b"), F.lit(0))
    return F.filter(words, lambda w: (F.length(w) > 1) | w.isin("a", "i", "u"))


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two arrays as sets; two empty ones agree wholly."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


#: What goes from Markdown, in this order, and what stays of it.  Lines end at "\n" only.
MARKDOWN = (
    (r"(?s)\A---\n.*?\n---\n", ""),
    (r"(?s)```.*?```", " "),
    (r"`([^`]*)`", "$1"),
    (r"(?dm)^#+\s*", ""),
    (r"(?dm)^\|?[\s:|-]*-{3,}[\s:|-]*$", " "),
    (r"\|", " "),
    (r"!\[[^\]]*\]\([^)]*\)", " "),
    (r"\[([^\]]*)\]\([^)]*\)", "$1"),
    (r"\*+|__+", ""),
)


def clean_markdown(c: Column) -> Column:
    """Text of Markdown: no front matter, code, heading marks, pipes, emphasis or link targets."""
    for pattern, to in MARKDOWN:
        c = F.regexp_replace(c, pattern, to)
    return c


def cjk_ratio(c: Column) -> Column:
    n = F.length(c)
    return F.when(n > 0, F.length(F.regexp_replace(c, r"[^\u4e00-\u9fff]", "")) / n).otherwise(0.0)


def strip_rogue_scripts(c: Column) -> Column:
    return strip(F.regexp_replace(c, ROGUE_SCRIPTS, ""))


def is_boilerplate(c: Column, patterns: list[str] = BOILERPLATE) -> Column:
    """One alternation over all patterns, without regard to case."""
    return c.rlike("(?iu)" + "|".join(f"(?:{p})" for p in patterns))


def is_hallucination(c: Column) -> Column:
    out = F.lit(False)
    for phrase in HALLUCINATIONS:
        out = out | F.lower(c).contains(phrase)
    return out


def clean_lines(c: Column) -> Column:
    """Without boilerplate lines, rogue scripts and blank lines."""
    lines = F.filter(F.transform(split_lines(c), strip), lambda x: (x != "") & ~is_boilerplate(x))
    return F.array_join(F.filter(F.transform(lines, strip_rogue_scripts), lambda x: x != ""), "\n")


def keep_devanagari(c: Column) -> Column:
    """Devanagari letters and signs, without digits and dandas."""
    return F.regexp_replace(c, r"[^\u0900-\u0963\u0970-\u097F]", "")


def keep_latin(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z]", "")


def to_arabic_digits(c: Column) -> Column:
    return F.translate(c, DEVANAGARI_DIGITS, ARABIC_DIGITS)


def to_devanagari_digits(c: Column) -> Column:
    return F.translate(c, ARABIC_DIGITS, DEVANAGARI_DIGITS)


def multiscript_number(c: Column) -> Column:
    """The number that the digits of several scripts give; null without digits."""
    digits = F.translate(c, DEVANAGARI_DIGITS + TELUGU_DIGITS + GUJARATI_DIGITS, ARABIC_DIGITS * 3)
    return F.regexp_replace(digits, "[^0-9]", "").try_cast("bigint")


def marker_number(c: Column) -> Column:
    """The number of a footnote marker, superscript digits included."""
    return F.regexp_replace(F.translate(c, SUPERSCRIPT_DIGITS, ARABIC_DIGITS), r"[^0-9]", "").try_cast("int")


def to_roman(n: Column) -> Column:
    """Lower-case Roman numeral of a positive number; of others an empty string."""
    state = F.struct(F.greatest(n, F.lit(0)).cast("int").alias("n"), F.lit("").alias("s"))
    table = F.array(*[F.struct(F.lit(v).alias("v"), F.lit(s).alias("s")) for v, s in ROMAN])

    def step(acc: Column, row: Column) -> Column:
        times = F.floor(acc.n / row.v).cast("int")
        return F.struct((acc.n - times * row.v).cast("int").alias("n"), F.concat(acc.s, F.repeat(row.s, times)).alias("s"))

    return F.aggregate(table, state, step, lambda acc: acc.s)


def from_roman(c: Column) -> Column:
    """Value of a Roman numeral, 0 for other characters: a sign counts negative before a larger one."""
    digits = F.translate(F.lower(strip(c)), "ivxlcdm", "1234567")
    values = [1, 5, 10, 50, 100, 500, 1000]
    pick = F.array(*[F.lit(v) for v in values])
    each = F.transform(F.filter(F.split(digits, ""), lambda x: x != ""), lambda x: F.when(x.rlike("^[1-7]$"), F.element_at(pick, F.coalesce(x.try_cast("int"), F.lit(1)))).otherwise(0))
    zero = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("prev"))

    def step(acc: Column, v: Column) -> Column:
        less = v < acc.prev
        return F.struct(F.when(less, acc.sum - v).otherwise(acc.sum + v).cast("int").alias("sum"), F.when(less, acc.prev).otherwise(v).cast("int").alias("prev"))

    return F.aggregate(F.reverse(each), zero, step, lambda acc: acc.sum)


#: What each kind of text has a backslash before: everything, text of a markup block, text that also stands in quotes, plain text.
_TYPST = {"all": r"\\#$*_`<>@\[\]~", "block": r"\\#$*_`<>@\[\]=", "quoted": r"\\#$*_`<>@\[\]\"", "plain": r"\\#$*_`<>@\[\]"}


def escape_typst(c: Column, kind: str = "all") -> Column:
    """Backslashes before the characters that Typst gives a meaning; in a block also before a slash at a line's beginning."""
    escaped = F.regexp_replace(c, f"([{_TYPST[kind]}])", r"\\$1")
    return F.regexp_replace(escaped, r"(?m)^(\s*)/", r"$1\\/") if kind == "block" else escaped


def apply_rules(c: Column, rules: list[tuple[str, str]]) -> Column:
    """Regular-expression replacements in their order."""
    for pattern, to in rules:
        c = F.regexp_replace(c, pattern, to)
    return c


def expand_url(template: Column, page: Column) -> Column:
    """``{page}``, ``{p}`` and ``{p:0Nd}`` (zero-filled to N digits) replaced by the page number."""
    plain = F.replace(F.replace(template, F.lit("{page}"), page.cast("string")), F.lit("{p}"), page.cast("string"))
    width = F.regexp_extract(template, r"\{p:0(\d+)d\}", 1).try_cast("int")
    filled = F.lpad(page.cast("string"), F.greatest(F.coalesce(width, F.lit(0)), F.length(page.cast("string"))), F.lit("0"))
    return F.when(width.isNull(), plain).otherwise(F.regexp_replace(plain, r"\{p:0\d+d\}", filled))


def hocr_title_field(title: Column, field: str) -> Column:
    """A field of an hOCR title as text: what follows its name up to the next semicolon."""
    return F.regexp_extract(title, rf"(?:^|;)\s*{field}\s+([^;]+)", 1)


def set_word_confidence(title: Column, conf: Column) -> Column:
    """An hOCR title with ``x_wconf`` replaced, or added if absent."""
    value = F.concat(F.lit("x_wconf "), conf.cast("string"))
    return F.when(title.rlike(r"x_wconf\s+[\d.]+"), F.regexp_replace(title, r"x_wconf\s+[\d.]+", value)).otherwise(F.concat(title, F.lit("; "), value))


def format_size(n: Column) -> Column:
    """Bytes as B, KB with one place or MB with one or two; halves of the last place go to the even digit.  Null for null."""
    return (
        F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B")))
        .when(n < 1024 * 1024, F.format_string("%.1f KB", F.bround(n / 1024.0, 1)))
        .when(n.isNotNull(), F.concat(F.regexp_replace(F.format_string("%.2f", F.bround(n / (1024.0 * 1024.0), 2)), r"(\.\d)0$", "$1"), F.lit(" MB")))
    )


def decode_utf16_hex(c: Column) -> Column:
    """Text of a hex string in UTF-16BE."""
    return F.decode(F.unhex(c), "UTF-16BE")


#: Order matters: longer sigla first.
_SIGLA = [(r"पं[०.]", "पं."), (r"ख[०.]\s*पु[०.]", "ख. पु."), (r"क[०.]\s*पु[०.]", "क. पु."), (r"ग[०.]\s*पु[०.]", "ग. पु."), (r"पु[०.]", "पु.")]


def normalize_apparatus(c: Column) -> Column:
    """Sigla of a Devanagari apparatus with a full stop for the abbreviation sign."""
    return apply_rules(c, _SIGLA)


_SIGLA_IAST = [(r"पं\.", "paṃ. "), (r"ख\.\s*पु\.", "kha. pu. "), (r"क\.\s*पु\.", "ka. pu. "), (r"ग\.\s*पु\.", "ga. pu. "), (r"पु\.", "pu. ")]


def apparatus_iast(c: Column) -> Column:
    """An apparatus line in Latin script: sigla, text, Arabic digits, dandas as full stop and double slash, avagraha as apostrophe."""
    from quiremill.functions.similarity import to_iast

    t = to_arabic_digits(to_iast(apply_rules(normalize_apparatus(c), _SIGLA_IAST)))
    for old, new in (("||", "//"), ("|", "."), ("।", "."), ("॥", "//"), ("ऽ", "'")):
        t = F.replace(t, F.lit(old), F.lit(new))
    return strip(F.regexp_replace(t, " +", " "))
