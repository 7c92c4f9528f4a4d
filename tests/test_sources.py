import io
import json
import xml.etree.ElementTree as ET
import zipfile

import pytest
from pyspark.sql import functions as F

from quiremill.sources import documents as D
from quiremill.sources import exports as E
from quiremill.sources import metadata as M

HOCR = """<html xmlns="http://www.w3.org/1999/xhtml"><body><div class="ocr_page" title="bbox 0 0 100 200">
<p class="ocr_par" title="bbox 1 2 30 40"><span class="ocrx_word" id="w1" title="bbox 1 2 10 12; x_wconf 91">Foo</span>
<span class="ocrx_word" id="w2" title="bbox 12 2 20 12; x_wconf 30.5">bär</span></p></div></body></html>"""


def test_vision_json(spark):
    page = {
        "source": "scans/p1.png",
        "pages": [
            {
                "index": 0,
                "dimensions": {"width": 100, "height": 200},
                "blocks": [
                    {"type": "header", "content": "Running", "top_left_x": 1.4, "top_left_y": 2.6, "bottom_right_x": 3, "bottom_right_y": 4},
                    {"type": "title", "content": "# Big"},
                    {"type": "text", "content": "a sepa-\n rated word"},
                    {"type": "table", "content": "|a|b|\n|-|-|\n|1|2|"},
                    {"type": "image", "content": "pic", "image_id": "img-0"},
                    {"type": "text", "content": "  "},
                ],
            }
        ],
    }
    p = spark.createDataFrame([("j", "p1", json.dumps(page)), ("j", "p2", "not json")], "job string, page string, json string")
    got = D.vision_blocks(p).orderBy("idx").collect()
    assert [(r.type, r.text) for r in got] == [("h2", "Running"), ("h1", "Big"), ("p", "a separated word"), ("table_row", "|a|b|"), ("table_row", "|-|-|"), ("table_row", "|1|2|"), ("image", "pic")]
    assert got[0].bbox == [1, 3, 3, 4] and got[1].bbox == [0, 0, 0, 0] and got[6].image_id == "img-0"
    heads = spark.createDataFrame([("j", "p1", "running", "RUNNING")], "job string, page string, key string, text string")
    assert D.vision_blocks(p, heads).orderBy("idx").first().type == "sidehead"


def test_markdown():
    text = "# One\n\npara-\ngraph goes\non\n- item\n|a|b|\n#bad\nSide\nhead x\n\ntail"
    assert D.parse_markdown(text, {"sideheadx": "Side head x"}) == [
        ("h1", "One"), ("p", "paragraph goes on"), ("p", "- item"), ("table_row", "|a|b|"), ("h1", "bad"), ("sidehead", "Side head x"), ("p", "tail"),
    ]
    assert D.parse_markdown("") == []


def test_hocr(spark):
    p = spark.createDataFrame([("j", "p", HOCR), ("j", "q", "<broken x_wconf 50"), ("j", "r", None)], "job string, page string, text string")
    w = D.hocr_words(p).orderBy("idx").collect()
    assert [(r.id, r.text, r.conf, r.x0, r.y1) for r in w] == [("w1", "Foo", 91.0, 1, 12), ("w2", "bär", 30.5, 12, 12)]
    b = D.hocr_blocks(p).collect()
    assert [(r.type, r.text, r.bbox) for r in b] == [("p", "Foo bär", [1, 2, 30, 40])]
    assert sorted((r.page, r.conf) for r in D.hocr_confidences(p).collect()) == [("p", 30.5), ("p", 91.0), ("q", 50.0)]


def test_tsv(spark):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext"
    rows = [head, "5\t1\t1\t1\t1\t1\t10\t20\t5\t6\t87.5\tfoo", "5\t1\t1\t1\t1\t2\t10\t20\t5\t6\t-1\tx", "5\t1\t1\t1\t1\t3\t10\t20\t5\t6\t50\t ", "5\t1", "5\t1\t1\t1\t1\t4\t1\t2\t3\t4\t60\ta\tb"]
    x = spark.createDataFrame([("j", "p", i, r) for i, r in enumerate(rows)], "job string, page string, n int, line string")
    got = D.read_tsv_words(x).orderBy("idx").collect()
    assert [(r.text, r.conf, r.x0, r.y0, r.x1, r.y1) for r in got] == [("foo", 87.5, 10, 20, 15, 26), ("a\tb", 60.0, 1, 2, 4, 6)]


def test_discover_and_priority(spark, tmp_path):
    for name in ("job/p2.txt", "job/p1.md", "job/p1.json", "job/p1.corrected.hocr", "job/p1.hocr", "job/x.bin"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    f = D.discover(spark, str(tmp_path))
    assert {(r.stem, r.kind, r["rank"]) for r in f.collect()} == {("p1", ".json", 1), ("p1", ".md", 1), ("p1", ".corrected.hocr", 1), ("p1", ".hocr", 1), ("p2", ".txt", 2)}
    best = D.best_source(f, ["job", "stem"])
    assert {(r.stem, r.kind) for r in best.collect()} == {("p1", ".json"), ("p2", ".txt")}
    c = spark.createDataFrame([("p", 1, None, "a"), ("p", 2, "box", "b")], "page string, prio int, bbox string, t string")
    assert tuple(D.best_source(c, ["page"], inherit="bbox").first()) == ("p", 1, "box", "a")


@pytest.mark.parametrize(
    "text, want",
    [
        ('[[1, "A", 2],]', [(1, "A", 2)]),
        ("# One 3\n## Two 14", [(1, "One", 3), (2, "Two", 14)]),
        ("Intro ..... 7\nno page", [(1, "Intro", 7)]),
        ("# title: X\nA | 1\n  B | 2\n    C | 3", [(1, "A", 1), (2, "B", 2), (3, "C", 3)]),
        ("", []),
    ],
)
def test_toc(text, want):
    assert M.parse_toc(text) == want


def test_iiif(spark):
    v3 = {"label": {"en": ["Book 1878"]}, "items": [{"id": "c1", "label": {"none": ["1r"]}, "width": 10, "height": 20, "items": [{"items": [{"body": {"id": "u", "service": [{"id": "https://i/1"}]}}]}]}]}
    v2 = {"label": "Old", "sequences": [{"canvases": [{"@id": "c", "label": "1", "width": 1, "height": 2, "images": [{"resource": {"@id": "u2"}}]}]}]}
    m = spark.createDataFrame([("a", json.dumps(v3)), ("b", json.dumps(v2)), ("c", "{")], "job string, json string")
    got = {r.job: r for r in M.iiif_pages(m).collect()}
    assert got["a"].image_url == "https://i/1/full/max/0/default.jpg" and got["a"].label == "1r"
    assert got["b"].image_url == "u2" and "c" not in got
    assert {r.job: r.year for r in M.iiif_metadata(m).collect()}["a"] == "1878"
    pages = spark.createDataFrame([("a", 1), ("a", 2)], "job string, page_num int")
    urls = spark.createDataFrame([("a", "0001", "U")], "job string, page_key string, image_url string")
    assert [r.iiif_url for r in M.page_urls(pages, urls, "t/{p:03d}").orderBy("page_num").collect()] == ["U", "t/002"]


def test_canonical_shapes(spark):
    shapes = [[{"ref": "1", "text": "x"}], {"sutras": [{"id": 1, "devanagari": "x"}]}, {"entries": [{"code": "1", "dhatu": "x"}]}, {"1": "x"}]
    t = spark.createDataFrame([(str(i), json.dumps(s)) for i, s in enumerate(shapes)], "job string, json string")
    assert {(r.job, r.ref, r.text) for r in M.canonical_entries(t).collect()} == {(str(i), "1", "x") for i in range(4)}


def test_config(spark):
    f = spark.createDataFrame([("j", 1, "{bad"), ("j", 2, '{"title": "T", "year": 1900, "heuristics": {"a": "true"}}'), ("j", 3, '{"title": "U"}')], "job string, prio int, json string")
    r = M.job_config(f).first()
    assert (r.title, r.year, r.heuristics) == ("T", "1900", {"a": "true"})


@pytest.fixture
def book(spark):
    rows = [("j", 1, 0, "h1", "A & B"), ("j", 1, 1, "p", "x < y"), ("j", 1, 2, "table_row", "|a|b|"), ("j", 1, 3, "table_row", "|1|2|"), ("j", 2, 0, "h1", "Next"), ("j", 2, 1, "sidehead", "note")]
    b = spark.createDataFrame(rows, "job string, page int, idx int, type string, text string")
    return b, spark.createDataFrame([("j", 'The "Title"', "An Author")], "job string, title string, author string")


def test_json_and_markdown(book):
    b, meta = book
    j = json.loads(E.book_json(b, meta).first().content)
    assert j["metadata"]["page_count"] == 2 and [len(p["blocks"]) for p in j["pages"]] == [4, 2]
    text = E.book_markdown(b, meta).first().content
    assert text.startswith('---\njob: "j"\ntitle: "The \\"Title\\""') and "|a|b|\n|1|2|\n\n" in text and "<!-- page 2 -->\n\n# Next\n\n**note**" in text


def test_tei(book):
    root = ET.fromstring(E.tei_xml(*book).first().content.encode())
    ns = {"t": "http://www.tei-c.org/ns/1.0"}
    assert [d.find("t:head", ns).text for d in root.findall(".//t:div", ns)] == ["A & B", "Next"]
    assert [p.get("n") for p in root.findall(".//t:pb", ns)] == ["1", "2"]


def test_epub(book):
    data = E.epub(*book).first().content
    z = zipfile.ZipFile(io.BytesIO(bytes(data)))
    first = z.infolist()[0]
    assert first.filename == "mimetype" and first.compress_type == zipfile.ZIP_STORED
    assert sum(n.startswith("OEBPS/section_") for n in z.namelist()) == 2
    for n in z.namelist():
        if n.endswith((".xhtml", ".opf", ".ncx")):
            ET.fromstring(z.read(n))


def test_corrected_layers(spark):
    x = spark.createDataFrame([(HOCR, {"w2": "bar"}), ("<broken", {"w2": "x"})], "t string, c map<string,string>").select(E.corrected_hocr("t", "c").alias("r")).collect()
    assert ">bar<" in x[0].r and "x_wconf 100" in x[0].r and x[1].r == "<broken"
    stream = b"BT <" + "teh ".encode("utf-16-be").hex().encode() + b"> Tj ET"
    out, n = E.correct_stream(stream, {"teh": "the"})
    assert n == 1 and "the ".encode("utf-16-be").hex().upper().encode() in out
    assert E.correct_stream(b"x" * (E.LONGEST_STREAM + 1), {"teh": "the"})[1] == 0
    fix = {"teh": "the", "naïve": "na(ive", "x": "\u0915"}
    for before, after, hits in [
        (rb"[(teh) -120 (a \(teh\) b)] TJ", rb"[(the) -120 (a \(the\) b)] TJ", 2),
        (rb"(keep \050 \b) Tj (na\357ve) Tj", rb"(keep \050 \b) Tj (na\(ive) Tj", 1),
        (b"<</A(teh)>> (x) Tj", b"<</A(teh)>> (?) Tj", 1),
        (b"(out (teh) in) Tj (teh", rb"(out \(the\) in) Tj (the)", 2),
        (b"[<" + "teh".encode("utf-16-be").hex().encode() + b"> 3 <zz> <41>] TJ", b"[<" + "the".encode("utf-16-be").hex().upper().encode() + b"> 3 <zz> <41>] TJ", 1),
    ]:
        assert E.correct_stream(before, fix) == (after, hits)
    assert E.literal_text(rb"\101\n\)\q") == "A\n)q" and E.literal_text(E.literal_bytes("(a\\b)\t")) == "(a\\b)\t"
    rows = [("j", 1, "a", bytearray(b"(teh)")), ("j", 1, "b", None), ("j", 2, "c", bytearray(E.LONGEST_STREAM + 1))]
    streams = spark.createDataFrame(rows, "job string, page int, label string, data binary")
    maps = spark.createDataFrame([("j", 1, {"teh": "the"})], "job string, page int, mapping map<string,string>")
    got = {r.label: (r.hits, r.skipped, None if r.data is None else bytes(r.data)[:5]) for r in E.correct_streams(streams, maps).collect()}
    assert got == {"a": (1, False, b"(the)"), "b": (0, False, None), "c": (0, True, bytes(5))}
    s = spark.createDataFrame([("j", 1, bytearray(stream))], "job string, page int, data binary").select("job", "page", F.decode("data", "UTF-8").alias("data"))
    assert D.pdf_stream_tokens(s).first().token == "teh "


def test_reports(spark):
    report = spark.createDataFrame([("j", 2, 80.0, "B", 0.004)], "job string, pages int, mean_confidence double, tier string, cost double")
    decisions = spark.createDataFrame([("j", 1, 90.0, "pass"), ("j", 2, 70.0, "fallback")], "job string, page int, mean_confidence double, decision string")
    files = spark.createDataFrame([("j", "a.pdf", 2048, "document")], "job string, file string, size long, purpose string")
    text = E.report_markdown(report, decisions, files).first().content
    assert "| Tier | B |" in text and "| 2 | 70.0 | fallback | fallback text | corrected |" in text and "| a.pdf | .pdf | 2.0 KB | document |" in text
    assert "1 pages under 85:\n\n- page 2: 70.0 (fallback text)\n" in text and "| Passed | 1 of 2 (50.0 %), threshold 85 |" in text and "| Mean confidence | 80.0, from 70.0 to 90.0 |" in text
    assert [x for x in text.split("\n") if x.startswith("#")] == ["# Report j", "## 1. Summary", "## 2. Master data", "## 3. Steps", "## 4. Pages", "### Outliers", "## 5. Files"]
    made = spark.createDataFrame([("j", "j.epub", 1024, "e-book")], "job string, file string, size long, purpose string")
    about = spark.createDataFrame([("j", "A Book", None)], "job string, title string, year string")
    text = E.report_markdown(report, decisions.where("false"), made, about, threshold=60.0).first().content
    assert "| title | A Book |\n| year | - |" in text and "10. E-book: j.epub, 1.0 KB\n" in text and "5. Facsimile with text layer: not made\n" in text and "### Outliers\n\nNone.\n" in text
    pages = spark.createDataFrame([("j", 1, "PASS", 0.9)], "job string, page int, status string, overlap double")
    assert "| 1 | PASS | 90.0% |" in E.audit_markdown(pages).first().content
