"""Functions that the JVM has no expression for: Arrow batches in, Arrow batches out."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# -- Fixed values -----------------------------------------------------------------------------
VOWELS = {"अ": "a", "आ": "ā", "इ": "i", "ई": "ī", "उ": "u", "ऊ": "ū", "ऋ": "ṛ", "ॠ": "ṝ", "ऌ": "ḷ", "ॡ": "ḹ", "ए": "e", "ऐ": "ai", "ओ": "o", "औ": "au"}
VOWEL_SIGNS = {"ा": "ā", "ि": "i", "ी": "ī", "ु": "u", "ू": "ū", "ृ": "ṛ", "ॄ": "ṝ", "ॢ": "ḷ", "ॣ": "ḹ", "े": "e", "ै": "ai", "ो": "o", "ौ": "au"}
CONSONANTS = dict(zip("कखगघङचछजझञटठडढणतथदधनपफबभमयरलवशषसह", "k kh g gh ṅ c ch j jh ñ ṭ ṭh ḍ ḍh ṇ t th d dh n p ph b bh m y r l v ś ṣ s h".split(), strict=True))
SIGNS = {"ं": "ṃ", "ः": "ḥ", "ँ": "m̐", "ऽ": "'"}
VIRAMA = "्"
SUPERSCRIPTS = str.maketrans("0123456789+-=()n", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⁼⁽⁾ⁿ")
SUBSCRIPTS = str.maketrans("0123456789+-=()", "₀₁₂₃₄₅₆₇₈₉₊₋₌₍₎")
LATEX_SIGNS = [("\\sqrt", "√"), ("\\rightarrow", "→"), ("\\Rightarrow", "⇒"), ("\\dot{N}", "Ṅ"), ("\\dot{n}", "ṅ"), ("\\bar{a}", "ā"), ("\\bar{u}", "ū"), ("\\bar{i}", "ī"), ("\\emptyset", "∅"), ("\\quad", " ")]
# ---------------------------------------------------------------------------------------------


def ratio(a: str | None, b: str | None) -> float:
    """Ratcliff-Obershelp similarity of two texts, trimmed and lower-cased; an empty one gives 0.

    The order of the arguments matters.
    """
    a, b = (a or "").strip().lower(), (b or "").strip().lower()
    return difflib.SequenceMatcher(None, a, b).ratio() if a and b else 0.0


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


_SYLLABLE = re.compile(f"([{''.join(CONSONANTS)}])([{VIRAMA}{''.join(VOWEL_SIGNS)}]?)")
_SINGLE = str.maketrans(VOWELS | VOWEL_SIGNS | SIGNS | {VIRAMA: ""})


def deva_to_iast(text: str | None) -> str | None:
    """Devanagari in the scholarly Latin transliteration: a consonant has an inherent a unless a sign follows."""
    if text is None:
        return None

    def syllable(m: re.Match) -> str:
        sign = m[2]
        return CONSONANTS[m[1]] + ("" if sign == VIRAMA else VOWEL_SIGNS.get(sign, "a"))

    return _SYLLABLE.sub(syllable, text).translate(_SINGLE)


_TO_DEVA = {v: k for k, v in VOWELS.items()}
_TO_SIGN = {v: k for k, v in VOWEL_SIGNS.items()}
_TO_CONSONANT = {v: k for k, v in CONSONANTS.items()}
_TO_OTHER = {v: k for k, v in SIGNS.items()}
_IAST = re.compile("|".join(sorted(map(re.escape, [*_TO_DEVA, *_TO_CONSONANT, *_TO_OTHER]), key=len, reverse=True)))


def iast_to_deva(text: str | None) -> str | None:
    """The reverse of ``deva_to_iast``."""
    if text is None:
        return None
    out, at, open_consonant = [], 0, False
    for m in _IAST.finditer(text):
        if m.start() > at:
            out += ([VIRAMA] if open_consonant else []) + [text[at : m.start()]]
            open_consonant = False
        x, at = m[0], m.end()
        if x in _TO_CONSONANT:
            out += ([VIRAMA] if open_consonant else []) + [_TO_CONSONANT[x]]
            open_consonant = True
        elif x in _TO_DEVA:
            out.append("" if open_consonant and x == "a" else _TO_SIGN[x] if open_consonant else _TO_DEVA[x])
            open_consonant = False
        else:
            out += ([VIRAMA] if open_consonant else []) + [_TO_OTHER[x]]
            open_consonant = False
    return "".join(out) + (VIRAMA if open_consonant else "") + text[at:]


#: What opens a formula, and what closes it.  One in dollar signs or round brackets ends in its line.
_FORMULAS = {r"\begin{aligned}": r"\end{aligned}", r"\(": r"\)", "$$": "$$", "$": "$"}
_SPECIAL = re.compile(r"[\\$_]")
_SCRIPT = re.compile(r"\^\{?([0-9a-zA-Z+-]+)\}?")
_INDEX = re.compile(r"(?<=[a-zA-Z])_\{?([0-9]+)\}?")
_ARGUMENT = re.compile(r"\\(mathrm|mathbf|text|textbf|textit|sqrt)\{([^}]+)\}")


def _formula(text: str, at: int) -> tuple[str, int] | None:
    """The formula that begins at ``at`` as plain text, and where it ends; None if none begins or it isn't closed."""
    for opening, closing in _FORMULAS.items():
        begin = at + len(opening)
        end = text.find(closing, begin) if text.startswith(opening, at) else -1
        if end >= 0 and (closing == _FORMULAS[r"\begin{aligned}"] or "\n" not in text[begin:end]):
            script = _SCRIPT.fullmatch(text, begin, end) if opening == "$" else None
            return script[1].translate(SUPERSCRIPTS) if script else latex_to_unicode(text[begin:end]), end + len(closing)
    return None


def _command(text: str, at: int) -> tuple[str, int] | None:
    """The same for an index, a command with an argument or a sign."""
    if m := _INDEX.match(text, at):
        return m[1].translate(SUBSCRIPTS), m.end()
    if m := _ARGUMENT.match(text, at):
        return "√" * (m[1] == "sqrt") + latex_to_unicode(m[2]), m.end()
    return next(((char, at + len(sign)) for sign, char in LATEX_SIGNS if text.startswith(sign, at)), None)


def latex_to_unicode(text: str | None) -> str | None:
    """LaTeX scripts, wrappers and signs as plain Unicode, read once from left to right; what isn't LaTeX stays."""
    if text is None:
        return None
    out, at = [], 0
    while special := _SPECIAL.search(text, at):
        out.append(text[at : special.start()])
        plain, at = _formula(text, special.start()) or _command(text, special.start()) or (special[0], special.end())
        out.append(plain)
    return "".join(out) + text[at:]


def replace_tokens(text: str | None, mapping: dict[str, str] | None) -> tuple[str | None, int]:
    """A token corrected by a mapping, and the number of hits.

    An entry for the whole token counts first, looked up without and then with its blanks (of which
    one stays on either side).  Otherwise all entries are sought at once, from left to right and the
    longest first: words at word boundaries, other strings of three characters or more anywhere;
    what was put in isn't corrected again.
    """
    if not text or not mapping:
        return text, 0
    if whole := mapping.get(text.strip()):
        return f"{text[: text.startswith(' ')]}{whole}{text[len(text) - text.endswith(' ') :]}", 1
    if text.strip() in mapping or text in mapping:
        return mapping.get(text.strip(), mapping.get(text)), 1
    word = {old: re.fullmatch(r"\w+", old) is not None for old, new in mapping.items() if old and old != new}
    usable = sorted((old for old in word if word[old] or len(old) >= 3), key=lambda old: (-len(old), old))
    if not usable:
        return text, 0
    sought = "|".join(rf"(?<!\w){re.escape(old)}(?!\w)" if word[old] else re.escape(old) for old in usable)
    return re.subn(sought, lambda m: mapping[m[0]], text)


def _strings(f):
    @F.pandas_udf(T.StringType())
    def udf(c: pd.Series) -> pd.Series:
        return c.map(lambda x: f(x) if isinstance(x, str) else None)

    return udf


to_iast = _strings(deva_to_iast)
to_devanagari = _strings(iast_to_deva)
clean_latex = _strings(latex_to_unicode)

_REPLACED = T.StructType([T.StructField("text", T.StringType()), T.StructField("hits", T.IntegerType())])


@F.pandas_udf(_REPLACED)
def corrected(text: pd.Series, mapping: pd.Series) -> pd.DataFrame:
    rows = [replace_tokens(t, dict(m) if m is not None else None) for t, m in zip(text, mapping, strict=True)]
    return pd.DataFrame(rows, columns=["text", "hits"])


_QUOTES = "\"'‘’‚“”„«»‹›"


def apply_italics(text: str | None, phrases: list[str] | None) -> str | None:
    """Phrases of a text in emphasis marks, longest first, whatever the quotes; none within another."""
    if not text or not phrases:
        return text
    quote = f"[{re.escape(_QUOTES)}]"
    one = lambda p: "".join(quote if c in _QUOTES else r"\s+" if c.isspace() else re.escape(c) for c in p)
    usable = sorted({p.strip() for p in phrases if p and p.strip()}, key=lambda p: (-len(p), p))
    return re.sub("|".join(rf"(?<!\w){one(p)}(?!\w)" for p in usable), lambda m: f"_{m[0]}_", text) if usable else text


def clean_page_text(text: str | None, header: str | None = None) -> str | None:
    """A page's lines without header, folio and blank lines at its ends."""
    if text is None:
        return None
    lines = [x.rstrip() for x in text.splitlines()]
    drop = lambda x: not x.strip() or re.fullmatch(r"\W*\d{1,4}\W*", x) or header is not None and re.fullmatch(header, x.strip())
    while lines and drop(lines[0]):
        lines.pop(0)
    while lines and drop(lines[-1]):
        lines.pop()
    return "\n".join(lines)


@F.pandas_udf(T.StringType())
def italicised(text: pd.Series, phrases: pd.Series) -> pd.Series:
    return pd.Series([apply_italics(t, list(p) if p is not None else None) for t, p in zip(text, phrases, strict=True)])


cleaned_page = _strings(clean_page_text)
