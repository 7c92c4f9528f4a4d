"""Inline Markdown as Typst markup.

One scan takes code, bold and italic spans out of a text, innermost last, and leaves marks in their places; what
remains is escaped, and the marks give way to the finished spans.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiremill.functions.similarity import latex_to_unicode

# -- Fixed values -----------------------------------------------------------------------------
IMAGE = re.compile(r"!\[.*?\]\(.*?\)")
CODE = re.compile(r"`([^`]+)`")
STYLES = [
    ("strong", re.compile(r"\*\*(.+?)\*\*")),
    ("emph", re.compile(r"(?<!\*)\*(?!\*)(.+?)(?<!\*)\*(?!\*)")),
    ("emph", re.compile(r"(?<!_)_(?!_)(.+?)(?<!_)_(?!_)")),
]
ESCAPES = str.maketrans({c: "\\" + c for c in "\\[]<>$#@*_=`"})
LEADING_SLASH = re.compile(r"^(\s*)/", re.M)
NUMBER_DOT = re.compile(r"(\b\d+)\.(?=\s|$)")
# ---------------------------------------------------------------------------------------------

#: Separators of segments that are formatted apart; no line of a text holds them.
PART, LABEL, ITEM = "\x1e", "\x1f", "\x1d"
_OPEN, _CLOSE = "\ue000", "\ue001"
_DIGITS = {ord(str(i)): chr(0xE010 + i) for i in range(10)}
_BACK = {v: chr(k) for k, v in _DIGITS.items()}
_MARK = re.compile(f"{_OPEN}([\ue010-\ue019]+){_CLOSE}(\\(?)")
_OWN = re.compile("[\ue000\ue001\ue010-\ue019]")


class _Scan:
    def __init__(self):
        self.held: list[tuple[str, bool]] = []

    def hold(self, markup: str, styled: bool) -> str:
        self.held.append((markup, styled))
        return _OPEN + str(len(self.held) - 1).translate(_DIGITS) + _CLOSE

    def style(self, text: str) -> str:
        for name, pattern in STYLES:
            text = pattern.sub(lambda m: self.hold(f"#{name}[{self.style(m[1].strip())}]", True), text)
        text = LEADING_SLASH.sub(r"\1\\/", text.translate(ESCAPES))
        return NUMBER_DOT.sub(r"\1\\.", text)

    def filled(self, text: str) -> str:
        def span(m: re.Match) -> str:
            markup, styled = self.held[int("".join(_BACK[c] for c in m[1]))]
            # a bracket behind a span would be read as its argument
            return self.filled(markup) + ("\\(" if m[2] and styled else m[2])

        return _MARK.sub(span, text)


def inline_typst(text: str) -> str:
    """Inline Markdown as Typst: code, bold, italic, escapes; image placeholders go, LaTeX becomes text."""
    scan = _Scan()
    text = _OWN.sub(lambda m: scan.hold(m[0], False), text)
    text = IMAGE.sub("", latex_to_unicode(text)).strip()
    text = CODE.sub(lambda m: scan.hold("`" + m[1].replace("\\", "\\\\") + "`", False), text)
    return scan.filled(scan.style(text))


_SEPARATORS = re.compile(f"([{PART}{LABEL}{ITEM}])")


@F.pandas_udf(T.StringType())
def markup(text: pd.Series) -> pd.Series:
    """``inline_typst`` of each segment between separators."""
    one = lambda t: "".join(x if _SEPARATORS.fullmatch(x) else inline_typst(x) for x in _SEPARATORS.split(t))
    return text.map(one, na_action="ignore")
