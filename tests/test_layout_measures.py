"""Layout audit, calibration and profile on small books, with values worked out by hand."""

import oracle

from quiremill.operators import layout as L
from quiremill.plans import queries  # noqa: F401
from quiremill.plans.registry import ORACLE_SQL, QUERIES

WORDS = "page int, x0 double, y0 double, x1 double, y1 double"
PAGES = "job string, page int, page_w double, page_h double"
BLOCKS = "job string, page int, block_type int, x0 double, y0 double, x1 double, y1 double, text string"
SPANS = "job string, page int, size double, text string"
LINES = "job string, page int, block int, line int, y0 double, y1 double"


def test_audit_of_all_faults(spark):
    def line(page, n):
        return [(page, 10.0 * i, 0.0, 10.0 * i + 5, 8.0) for i in range(n)]

    clash = [(2, 0.0, 0.0, 20.0, 8.0), (2, 10.0, 0.0, 30.0, 8.0), (2, 20.0, 0.0, 40.0, 8.0)]
    words = spark.createDataFrame(line(1, 30) + clash + line(3, 30) + line(4, 24) + line(5, 15), WORDS)
    pages = spark.createDataFrame([(p, 400.0) for p in range(1, 7)], "page int, page_w double")
    long = "long enough"
    blocks = spark.createDataFrame([(1, 0.0, 300.0, long), (3, 50.0, 140.0, long), (3, 0.0, 400.0, "short"), (4, 50.0, 140.0, long), (5, 0.0, 100.0, long)], "page int, x0 double, x1 double, text string")
    spans = spark.createDataFrame([(1, 5.5, "x"), (1, 2.0, " "), (3, 4.0, "x"), (5, 5.0, "x"), (2, 1.0, "x"), (4, None, "x")], "page int, size double, text string")
    a = L.layout_audit(words, pages, ["page"], blocks=blocks, spans=spans)
    got = {r.page: (r.clashes, r.narrow, r.tiny, r.faulty) for r in a.collect()}
    assert got == {1: (0, False, False, False), 2: (2, False, False, True), 3: (0, True, True, True), 4: (0, False, False, False), 5: (0, False, True, True), 6: (0, False, False, False)}
    s = L.audit_summary(a, reference_pages=7).first()
    assert tuple(s) == (6, 3, 50.0, 1, 1, 2, False)
    none = L.audit_summary(a.where("false")).first()
    assert (none.pages, none.quality_percent, none.concordance_ok) == (0, 100.0, True)


def _book(spark, job, pages, w, h, left, bottom, size=10.0, lines=3, gap=2.0):
    p = [(job, n, w, h) for n in range(pages)]
    # Recto pages have the wider margin outside.
    x = [(job, n, 0, left + (6.0 if n % 2 else 0.0), 100.0 + 20 * k, w - 60.0, (bottom if k == 2 else 110.0 + 20 * k), "some text") for n in range(pages) for k in range(3)]
    s = [(job, n, size, "text") for n in range(pages)]
    y = [(job, n, 0, k, 100.0 + k * (10 + gap), 110.0 + k * (10 + gap)) for n in range(pages) for k in range(lines)]
    return spark.createDataFrame(p, PAGES), spark.createDataFrame(x, BLOCKS), spark.createDataFrame(s, SPANS), spark.createDataFrame(y, LINES)


def test_calibration(spark):
    p, x, s, y = _book(spark, "a", 20, 400.0, 600.0, 30.0, 400.0)
    r = L.layout_calibration(p, x, s, y).first()
    assert (r.width, r.height, r.left, r.right, r.top, r.bottom) == (400.0, 600.0, 33.0, 60.0, 100.0, 200.0)
    assert (r.inside, r.outside, r.is_asymmetric, r.font_size, r.leading) == (45.0, 48.0, False, 10.0, 2.0)
    tall = L.layout_calibration(*_book(spark, "b", 6, 500.0, 800.0, 5.0, 780.0, lines=12)).first()
    # margins of less than 18 points are widened; small type on a tall type area is set up
    assert (tall.left, tall.bottom, tall.font_size, tall.leading) == (18.0, 20.0, 15.0, 9.5)
    assert L.layout_calibration(p, x.where("text = 'none'"), s, y).count() == 0


def test_calibration_takes_pages_from_the_eleventh(spark):
    p, x, s, y = _book(spark, "a", 70, 400.0, 600.0, 30.0, 400.0)
    odd = x.where("page >= 10 and page < 60").unionByName(x.where("page < 10 or page >= 60").withColumn("y0", x.y0 - 90))
    assert L.layout_calibration(p, odd, s, y).first().top == 100.0


def test_profile(spark):
    pages = spark.createDataFrame([("a", n, 400.0, 800.0) for n in range(4)] + [("e", 0, 400.0, 800.0)], PAGES)
    main = [("a", n, 0, 120.0, 100.0 + 50 * k, 340.0, 140.0 + 50 * k, "body text") for n in range(4) for k in range(3)]
    side = [("a", 1, 0, 40.0, 100.0, 100.0, 110.0, "head"), ("a", 2, 0, 40.0, 20.0, 100.0, 30.0, "header"), ("a", 2, 1, 40.0, 100.0, 100.0, 110.0, "image")]
    blocks = spark.createDataFrame(main + side, BLOCKS)
    spans = spark.createDataFrame([("a", 0, 11.0, "text"), ("a", 1, 13.0, "text"), ("a", 1, 30.0, "text"), ("a", 1, 9.0, "x")], SPANS)
    lines = spark.createDataFrame([("a", 0, 0, 0, 0.0, 10.0), ("a", 0, 0, 1, 13.0, 20.0), ("a", 0, 1, 0, 60.0, 70.0)], LINES)
    got = {r.job: r for r in L.layout_profile(pages, blocks, spans, lines).collect()}
    r = got["a"]
    assert (r.macro_layout, r.pages_with_marginalia, r.marginalia_ratio, r.pages_with_multicolumn) == ("marginal_sideheads", 1, 0.25, 0)
    assert (r.left, r.right, r.inside, r.outside, r.is_asymmetric, r.top, r.bottom) == (120.0, 60.0, 90.0, 90.0, False, 150.0, 360.0)
    assert (r.font_size, r.leading) == (12.0, 3.0)
    assert tuple(r.marginal_zone) == (40.0, 100.0, 60.0, 20.0) and tuple(r.body_zone) == (120.0, 340.0, 220.0)
    e = got["e"]
    assert (e.macro_layout, e.left, e.right, e.top, e.bottom, e.font_size, e.marginal_zone) == ("single_column", 50.0, 50.0, 55.0, 55.0, None, None)


def test_leading_of_a_tie_with_noise(spark):
    p, x, s, _ = _book(spark, "a", 6, 400.0, 600.0, 30.0, 400.0)
    # Gaps of 7.9, which is 7.899999999999999 as a difference, and 8: their median is a tie, and 8.0 has the even digit.
    y = spark.createDataFrame([("a", n, 0, k, *box) for n, y0 in ((0, 63.9), (1, 64.0)) for k, box in enumerate([(50.0, 56.0), (y0, 70.0)])], LINES)
    assert L.layout_calibration(p, x, s, y).first().leading == 8.0


def test_calibration_query_has_pages_without_key_last(spark, tmp_path):
    keys = [3, None, 1, 2]
    spark.createDataFrame([(k, 7) for k in keys], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    rows = [(k, 10 * k + i, n, 20.0 + k, 5.0) for k in (1, 2, 3) for i, n in enumerate((1, 2, 3, None))]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    oracle.same(QUERIES["layout_calibration"](spark, str(tmp_path)), ORACLE_SQL["layout_calibration"], str(tmp_path))
