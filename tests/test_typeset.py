"""Expected markup for every rule of the formatter."""

import pytest
from pyspark.sql import functions as F

from quiremill.functions.markup import inline_typst
from quiremill.operators import typeset as T


@pytest.mark.parametrize(
    "text, want",
    [
        ("plain", "plain"),
        ("a **b** c", "a #strong[b] c"),
        ("*a* and _b_", "#emph[a] and #emph[b]"),
        ("**a *b* c**", "#strong[a #emph[b] c]"),
        ("*a **b** c*", "#emph[a #strong[b] c]"),
        ("_a *b* c_", "#emph[a #emph[b] c]"),
        ("`x*y_z\\`", "`x*y_z\\\\`"),
        ("**a `b*` c**", "#strong[a `b*` c]"),
        ("*a*(b)", "#emph[a]\\(b)"),
        ("`a`(b)", "`a`(b)"),
        ("[x] <y> #1 @z = $5 *", "\\[x\\] \\<y\\> \\#1 \\@z \\= \\$5 \\*"),
        ("a\\b", "a\\\\b"),
        ("12. then 3.4 and 5.", "12\\. then 3.4 and 5\\."),
        ("/ a\n  /b c/d", "\\/ a\n  \\/b c/d"),
        ("see ![fig](img-0.jpeg) here", "see  here"),
        ("![fig](img-0.jpeg)", ""),
        ("**1.** x", "#strong[1\\.] x"),
        ("__a__", "\\_\\_a\\_\\_"),
        (" **b**", " #strong[b]"),
        ("", ""),
    ],
)
def test_inline(text, want):
    assert inline_typst(text) == want


def made(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [(r.kind, r.markup) for r in T.block_markup(df).orderBy("i").collect()]


def test_prose_and_its_labels(spark):
    got = made(spark, "one\n  two\n\nthree", "1. First thing", "१२. देव", "a. sub\nrun on", "(3) sub", "A. B. Name", "[ 12 ]", "(iv)", "1.2 section 3", "1.2.3 sutra", "", None, "  \n ", "\x1f a\x0bb")
    assert got == [
        ("prose", "one two three"),
        ("prose", "#block(spacing: 0.85em)[\n  #set par(justify: true, leading: 0.52em, first-line-indent: 0pt)\n  #grid(\n    columns: (2.0em, 1fr),\n    [1\\.],\n    [First thing]\n  )\n]"),
        ("prose", "#block(spacing: 0.85em)[\n  #set par(justify: true, leading: 0.52em, first-line-indent: 0pt)\n  #grid(\n    columns: (2.0em, 1fr),\n    [१२\\.],\n    [देव]\n  )\n]"),
        ("prose", "#block(inset: (left: 3.8em), spacing: 0.38em)[\n  #set par(hanging-indent: 1.5em)\n  a. sub run on\n]"),
        ("prose", "#block(inset: (left: 3.8em), spacing: 0.38em)[\n  #set par(hanging-indent: 1.5em)\n  (3) sub\n]"),
        ("prose", "A. B. Name"),
        ("prose", '#align(center)[#v(0.4em)#text(size: 11.5pt, weight: "bold")[\\[ 12 \\]]#v(0.4em)]'),
        ("prose", '#align(center)[#v(0.4em)#text(size: 11.5pt, weight: "bold")[(iv)]#v(0.4em)]'),
        ("prose", "1.2 section 3"),
        ("prose", "1.2.3 sutra"),
        ("empty", ""), ("empty", ""), ("empty", ""),
        ("prose", "a b"),
    ]


def test_lists(spark):
    sub, main = T.SUB_LIST, T.MAIN_LIST
    got = made(spark, "Lead *in*\n(a) one\nmore\n= gloss\n(b) two", "1. one\n2. two", "(1) *word*\n'a gloss'", "(1) word\nplain", "# 1.2 x\n(a) y\n# 3.4 z\n(b)  w", "a. \\ x \\ y\nb. z")
    assert got[0] == ("list", "Lead #emph[in]\n\n" + sub.format(body="    [(a)], [\n      one \\\n      more \\\n      #h(1.2em) \\= gloss\n    ],\n    [(b)], [\n      two\n    ]"))
    assert got[1] == ("list", main.format(body="    [1\\.], [\n      one\n    ],\n    [2\\.], [\n      two\n    ]"))
    assert got[2] == ("list", sub.format(body="    [(1)], [\n      #emph[word] \\\n      'a gloss'\n    ]"))
    assert got[3][0] == "prose"
    # a section number isn't an item, and loses its sign
    assert got[4] == ("list", "1.2 x\n\n" + sub.format(body="    [(a)], [\n      y \\\n      3.4 z\n    ],\n    [(b)], [\n      w\n    ]"))
    assert got[5][0] == "list"


def test_index_sutras_and_verse(spark):
    index = "\n".join(f"term {'x' * (i % 3 + 1)} {i}, {i + 2}" for i in range(1, 16))
    got = made(spark, index, "agni (1.2.3) a\nindra (4.5.6) b\nnone", "line one /\nline two //", "= a\n+ b\nc", "= a\nb")
    kind, text = got[0]
    left, right = text.split("],\n    [")
    assert kind == "index" and text.count("_term ") == 15 and left.count("_term ") == 8 and right.count("_term ") == 7
    assert "      _term xx_ 1, 3 \\\n      _term xxx_ 2, 4 \\\n" in left
    assert got[1] == ("sutras", "#block(spacing: 0.45em)[\n  #set par(first-line-indent: 0pt, hanging-indent: 1.5em, leading: 0.42em)\n  agni (1.2.3) a \\\n  indra (4.5.6) b \\\n  none\n]")
    assert got[2] == ("verse", "#block(inset: (left: 1.5em), spacing: 0.45em)[\n  #set par(first-line-indent: 0pt, leading: 0.45em)\n  line one / \\\n  line two //\n]")
    assert got[3][0] == "verse" and got[4][0] == "prose"


def tables(spark, *sets):
    df = spark.createDataFrame([(t, i, r) for t, rows in enumerate(sets) for i, r in enumerate(rows)], "t int, idx int, text string")
    return {r.t: r.markup for r in T.table_markup(df, ["t"]).collect()}


def test_tables(spark):
    got = tables(spark, ["|a|*b*|", "|--|:-:|", "| c | d |"], ["|1. Intro|1|", "|Two|ii|", "|3. Three||", "|Four|9|", "|Bibliography|12|"], ["|h|num|long|", "|aaaaaaaaaaaaaaaaaaaaaaa|1|bbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbb|", "|c|22|"], ["|--|--|"])
    assert got[0] == T.PAIR_TABLE.format(body="[a], [#emph[b]],\n  [c], [d]")
    assert got[1] == T.CONTENTS_TABLE.format(body="grid.cell(colspan: 3)[#v(0.8em)],\n  [1.], [Intro], [1],\n  [], [Two], [ii],\n  [3.], [Three], [],\n  [], [Four], [9],\n  grid.cell(colspan: 3)[#v(0.8em)],\n  [], [Bibliography], [12]")
    want = T.OPEN_TABLE.format(
        width="100%", size="9.2pt", columns="3fr, auto, 3fr", gutter="  row-gutter: 0.35em,\n", x="4pt", y="2.0pt",
        align="(col, row) => if col == 0 { left } else if col == 1 { center } else if col == 2 { left } else { left }",
        body="[h], \n    [num], \n    [long], \n    [aaaaaaaaaaaaaaaaaaaaaaa], \n    [1], \n    [bbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbb], \n    [c], \n    [22], \n    []",
    )
    assert got[2] == want and 3 not in got


BLOCKS = "job string, page int, idx int, type string, text string"


def test_notes_of_a_page(spark):
    rows = [(1, i, t) for i, t in enumerate(["1. not a note", "text", "more", "1. first *note*", "goes on\nhere", "² second"])]
    rows += [(2, 0, "1. alone"), (3, 0, "a"), (3, 1, "b"), (4, 0, "x"), (4, 1, "* starred"), (4, 2, "more")]
    x = T.with_notes(spark.createDataFrame([("b", p, i, "p", t) for p, i, t in rows], BLOCKS))
    got = {(r.page, r.idx) for r in x.where("is_note").collect()}
    assert got == {(1, 3), (1, 4), (1, 5), (4, 1), (4, 2)}
    notes = {r.page: r.markup for r in T.notes_markup(x.where("is_note")).collect()}
    assert notes[1] == T.NOTES.format(body=T.NOTE_MARKED.format(label="1", body="first #emph[note] goes on here") + "\n\n  " + T.NOTE_MARKED.format(label="2", body="second"))
    assert notes[4] == T.NOTES.format(body="#par[\\* starred more]")


def test_running_headers(spark):
    rows = {1: ["12", "LESSON 5", "text"], 2: ["The Chapter", "12", "x"], 3: ["xiv", "text"], 4: ["text", "12"], 5: ["CHAPTER 2", "The Book", "more"], 6: ["1234567", "text"], 7: []}
    types = {5: "h1"}
    blocks = spark.createDataFrame([("b", p, i, types.get(p, "p") if i == 0 else "p", t) for p, ts in rows.items() for i, t in enumerate(ts)], BLOCKS)
    pages = spark.createDataFrame([("b", p, "12", "the chapter", p == 5, "The Book") for p in rows], "job string, page int, label string, chapter string, is_chapter boolean, book string")
    kept = {}
    for r in T.without_running_headers(blocks, pages).orderBy("page", "idx").collect():
        kept.setdefault(r.page, []).append(r.text)
    assert kept == {1: ["text"], 2: ["x"], 3: ["text"], 4: ["text", "12"], 5: ["more"], 6: ["1234567", "text"]}


def test_contents_page(spark):
    rows = ["Contents", "xi", "LESSON ONE PAGE 3", "Grammar: the nouns", "and verbs 4", "Vocabulary; words 5", "INTRODUCTION", "| Readings | first | 7 |", "|--|--|--|", "TABLES of sounds 9", "no page here", "at all"]
    blocks = spark.createDataFrame([("b", 1, i, "p", t) for i, t in enumerate(rows)], BLOCKS)
    pages = spark.createDataFrame([("b", 1, True, ""), ("b", 2, False, "xii")], "job string, page int, is_first boolean, label string")
    got = {r.page: r.markup for r in T.contents_markup(blocks, pages).collect()}
    sub = lambda c, t, p: f'  {"[#text(size: 8.5pt, weight: " + chr(34) + "medium" + chr(34) + ")[" + c + "]]" if c else "[]"}, [#text(size: 8.5pt)[{t}]], [#align(right)[#text(size: 8.5pt)[{p}]]],'
    major = lambda t, p: T.MAJOR_ROW.format(body=t, page=T.MAJOR_PAGE.format(page=p) if p else "[]")
    body = [T.CONTENTS_HEAD, major("LESSON ONE", "3"), sub("Grammar:", "the nouns and verbs", "4"), sub("Vocabulary:", "words", "5"), major("INTRODUCTION", ""), sub("Readings", "first", "7"), major("TABLES", ""), sub("", "of sounds", "9"), T.OTHER_ROW.format(body="no page here"), T.OTHER_ROW.format(body="at all")]
    assert got[1] == T.CONTENTS_PAGE.format(first="true", roman="xi", body="\n".join(body))
    assert got[2] == T.CONTENTS_PAGE.format(first="false", roman="xii", body="")


def test_glyphs_and_figures(spark):
    df = spark.createDataFrame([([("ka", "k.png", 0.0, 100.0), ("kha", "kh.png", 60.0, 100.0), ("ga", None, 10.0, 100.0), ("gha", "gh.png", 20.0, 100.0)],)], "p array<struct<label:string,path:string,x:double,page_w:double>>")
    r = df.select(T.glyphs_beside(F.col("p")).alias("a"), T.glyphs_below(F.slice("p", 1, 2)).alias("b"), *[T.image_markup(F.lit("p.png"), F.lit(w), F.lit(100.0)).alias(f"w{w}") for w in (60, 40, 20)]).first()
    assert r.a == T.BESIDE_GRID.format(body='  [#strong[ka]], image("k.png", height: 44pt), [], [#strong[kha]], image("kh.png", height: 44pt),\n  [#strong[ga]], [], [], [], [],\n  [#strong[gha]], image("gh.png", height: 44pt), [], [], [],')
    assert r.b == T.BELOW_GRID.format(columns="65pt, 65pt", aligns="horizon + center, horizon + center", images='image("k.png", height: 42pt), image("kh.png", height: 42pt)', labels="[#strong[ka]], [#strong[kha]]")
    assert [r.w60, r.w40, r.w20] == ['#align(center)[#image("p.png", width: 85%)]', '#align(center)[#image("p.png", width: 55%)]', '#align(center)[#image("p.png", height: 50pt)]']


def test_pages_and_documents(spark):
    rows = [
        ("a", 1, 0, "h1", "Lesson 1"), ("a", 1, 1, "sidehead", "note\nhere"), ("a", 1, 2, "h2", "*Sounds*"), ("a", 1, 3, "p", "text"), ("a", 1, 4, "table_row", "|k|v|"), ("a", 1, 5, "table_row", "|l|w|"), ("a", 1, 6, "p", "after ![x](img-1.png)"),
        ("a", 1, 7, "p", "| h | i |\n| --- | --- |\n| j | k |"), ("a", 1, 8, "p", "1. a note"),
        ("a", 2, 0, "p", "LESSON 1"), ("a", 2, 1, "p", "2"), ("a", 2, 2, "p", "(a) one\n(b) two"), ("a", 2, 3, "p", "  "),
        ("a", 3, 0, "p", "Start"), ("c", 1, 0, "p", "only"),
    ]
    blocks = spark.createDataFrame(rows, BLOCKS)
    pages = spark.createDataFrame([("a", 1, "1", ""), ("a", 2, "2", ""), ("a", 3, "3", ""), ("a", 4, "", ""), ("c", 1, None, None)], "job string, page int, label string, book string")
    toc = spark.createDataFrame([("a", 1, 1, "Old: x", 3), ("a", 2, 1, "Second: the rest", 3), ("a", 3, 2, "below", 2)], "job string, ord int, level int, title string, page int")
    m = T.page_markup(blocks, pages, toc)
    got = {(r.job, r.page): r.markup for r in m.collect()}
    assert got["a", 1] == "\n\n".join([
        "= LESSON 1", "#sidehead(dx: -160.0pt, width: 115.0pt)[note \\ here]", "== #emph[Sounds]", "text", T.PAIR_TABLE.format(body="[k], [v],\n  [l], [w]"), "after",
        T.PAIR_TABLE.format(body="[h], [i],\n  [j], [k]"), T.NOTES.format(body=T.NOTE_MARKED.format(label="1", body="a note")),
    ])
    assert got["a", 2] == T.SUB_LIST.format(body="    [(a)], [\n      one\n    ],\n    [(b)], [\n      two\n    ]")
    assert got["a", 3] == "= Second\n\nStart" and got["a", 4] == "" and got["c", 1] == "only"
    ch = {(r.job, r.page): (r.is_chapter, r.chapter) for r in T.chapters(blocks, toc).collect()}
    assert ch == {("a", 1): (True, "LESSON 1"), ("a", 2): (False, "LESSON 1"), ("a", 3): (True, "Second"), ("c", 1): (False, None)}
    meta = spark.createDataFrame([("a", "A [b]", "C", "2020-01-02T00", "eng+deu", 2), ("c", None, None, None, None, None)], "job string, title string, author string, date string, language string, front_pages int")
    full = pages.join(m, ["job", "page"]).join(T.chapters(blocks, toc).select("job", "page", "is_chapter"), ["job", "page"], "left")
    docs = {r.job: r.content for r in T.document(full, meta).collect()}
    assert docs["a"].count("#pagebreak()") == 3 and docs["a"].count("#fit-page[\n") == 4 and docs["c"].count("#pagebreak()") == 0
    assert '  title: "A \\[b\\]",\n' in docs["a"] and 'lang: "en"' in docs["a"] and 'page_labels: ("1", "2", "3", "")' in docs["a"] and "front_matter_pages: 2" in docs["a"]
    assert docs["c"].endswith("// --- Original Page 1 (printed: ) ---\n#fit-page[\nonly\n]\n") and 'title: "Untitled Book"' in docs["c"] and 'lang: "de"' in docs["c"]
    flow = {r.job: r.content for r in T.document(full, meta, preserve_pages=False).collect()}
    assert flow["a"].count("#pagebreak(weak: true)") == 1 and '#orig-page("2")' in flow["a"] and '#orig-page("4")' in flow["a"]
