import numpy as np
from pyspark.sql import functions as F

from quiremill.functions import images as I
from quiremill.functions import similarity as X
from quiremill.operators import layout as L
from quiremill.operators import structure as S


def test_accumulate_and_toc_lines(spark):
    rows = [("j", 0, "intro"), ("j", 1, "1. one"), ("j", 2, "runs on"), ("j", 3, "2. two")]
    x = spark.createDataFrame(rows, "job string, idx int, text string")
    got = S.accumulate(x, F.col("text").rlike(r"^\d+\."), ["job"], "idx").orderBy("item").collect()
    assert [r.text for r in got] == ["intro", "1. one runs on", "2. two"]
    t = spark.createDataFrame([("j", 0, "A long"), ("j", 1, "title 7"), ("j", 2, "B 9"), ("j", 3, "tail")], "job string, idx int, text string")
    assert [r.text for r in S.merge_toc_lines(t, ["job"]).orderBy("idx").collect()] == ["A long title 7", "B 9", "tail"]


def test_boxes_and_crops(spark):
    w = spark.createDataFrame([("a", 1, 3, 4, 9, 8), ("a", 1, 1, 5, 4, 9)], "job string, page int, x0 int, y0 int, x1 int, y1 int")
    i = spark.createDataFrame([("a", 1), ("a", 2)], "job string, page int")
    assert [tuple(r)[2:] for r in S.text_boxes(w, i).orderBy("page").collect()] == [(1, 4, 9, 9), (None,) * 4]
    b = spark.createDataFrame([("a", 1, "i"), ("a", 1, None)], "job string, page int, image_id string")
    c = spark.createDataFrame([("a", 1, "i", "p.png")], "job string, page int, image_id string, path string")
    assert sorted(str(r.crop) for r in S.with_crops(b, c).collect()) == ["None", "p.png"]
    t = spark.createDataFrame([("a", "b"), ("a", "a"), ("a", "b")], "job string, text string")
    assert S.distinct_tokens(t, ["job"]).first().tokens == ["a", "b"]


def test_typographic_diff(spark):
    p = spark.createDataFrame([(1, 1.0, None, 0.1), (2, -2.0, 0.0, 0.0), (3, 0.0, 9.0, 0.0), (4, 0.0, 0.0, 0.6)], "page int, footer_delta double, hairline_delta double, superscript_delta double")
    got = L.typographic_diff(p).orderBy("page").collect()
    assert [r.verdict for r in got] == ["PASS", "WARN", "WARN", "WARN"] and got[1].footer_status == "WARN" and got[2].hairline_status == "FAIL"


def test_italics_and_pages():
    assert X.apply_italics('the "De Anima" and De  Anima Minor', ["De Anima", "“De Anima”", "De Anima Minor"]) == 'the _"De Anima"_ and _De  Anima Minor_'
    assert X.apply_italics(None, ["x"]) is None and X.apply_italics("x", []) == "x"
    assert X.clean_page_text("\n- 12 -\nHEAD\nbody\n\nmore\n13\n", "HEAD") == "body\n\nmore"


def test_routes_and_leading(spark):
    g = np.full((100, 80), 255, np.uint8)
    for y in (20, 40, 60):
        g[y : y + 5, 10:70] = 0
    assert I.leading(g) == 20.0 and I.leading(np.full((5, 5), 255, np.uint8)) is None
    red = np.repeat(g[:, :, None], 3, axis=2)
    red[:, :, 0] = 255
    assert I.route(red, 1)[0] == "RGB" and I.route(np.repeat(g[:, :, None], 3, axis=2), 1)[0] == "L"
    x = spark.createDataFrame([(bytearray(g.tobytes()), 100, 80, "L", 1)], "data binary, h int, w int, mode string, page int")
    r = x.select(I.routed("data", "h", "w", "mode", "page").alias("r")).first().r
    assert r.mode == "L" and len(r.data) == 8000
