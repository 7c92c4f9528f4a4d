from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quiremill.operators import alignment as A
from quiremill.operators import cleaning as C
from quiremill.operators import jobs as J
from quiremill.operators import layout as L
from quiremill.operators import quality as Q
from quiremill.operators import structure as S

BLOCKS = "job string, page int, idx int, type string, text string"


def test_gate_edges(spark):
    w = spark.createDataFrame([(1, 84.9995), (1, 85.0005), (2, 10.0)], "page int, conf double")
    pages = spark.createDataFrame([(1,), (2,), (3,)], "page int")
    g = {r.page: r for r in Q.quality_gate(w, 85.0, pages=pages).collect()}
    assert g[1].decision == "pass" and g[2].decision == "fallback"
    assert (g[3].word_count, g[3].mean_confidence, g[3].decision, g[3].low_samples) == (0, 0.0, "fallback", [])
    assert g[3].note


def test_clean_pages(spark):
    rows = [
        ("b", 1, 0, "p", "- 24 -"), ("b", 1, 1, "h1", "Title"), ("b", 1, 2, "p", "[ १ ]"), ("b", 1, 3, "p", "12"), ("b", 1, 4, "p", "same"), ("b", 1, 5, "p", "same"),
        ("b", 1, 6, "p", "same"), ("b", 1, 7, "p", "same"), ("b", 1, 8, "p", "The Ground Truth image displays x"), ("b", 1, 9, "p", "中中中a"), ("b", 1, 10, "p", "  "), ("b", 1, 11, "p", "99"),
    ]
    out = C.clean_page_artifacts(spark.createDataFrame(rows, BLOCKS)).orderBy("idx").collect()
    assert [r.idx for r in out] == [1, 2, 3, 4, 5, 6]
    assert {r.printed_page for r in out} == {"24"}
    again = C.clean_page_artifacts(spark.createDataFrame(rows, BLOCKS).repartition(5)).orderBy("idx").collect()
    assert again == out
    kept = C.clean_page_artifacts(spark.createDataFrame(rows, BLOCKS), language="zho").select("idx").collect()
    assert 9 in [r.idx for r in kept]


def test_running_headers_and_footnotes(spark):
    rows = [("b", 1, 0, "p", "12"), ("b", 1, 1, "p", "CHAPTER IV"), ("b", 1, 2, "p", "body"), ("b", 2, 0, "p", "Index"), ("b", 2, 1, "p", "x"), ("b", 2, 2, "p", "1) note"), ("b", 2, 3, "p", "more")]
    b = spark.createDataFrame(rows, BLOCKS)
    assert [(r.page, r.idx) for r in C.strip_running_headers(b).orderBy("page", "idx").collect()] == [(1, 2), (2, 1), (2, 2), (2, 3)]
    notes = C.split_footnotes(b).where("is_footnote").orderBy("page", "idx").collect()
    assert [(r.page, r.idx) for r in notes] == [(2, 2), (2, 3)]


def test_noise_tokens(spark):
    words = ["", "aaab", "x..y", "--12", "क3", "word", "it"]
    x = spark.createDataFrame([(w,) for w in words], "w string").select(C.is_noise_token(F.col("w")).alias("n"))
    assert [r.n for r in x.collect()] == [True] * 5 + [False] * 2


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-2, 7), min_size=1, max_size=12))
def test_levels_are_the_fold(spark, raw):
    want, last = [], 0
    for i, x in enumerate(raw):
        last = 1 if i == 0 else min(max(x, 1), last + 1)
        want.append(last)
    t = spark.createDataFrame([("b", i, x) for i, x in enumerate(raw)], "job string, ord int, level int")
    assert [r.level for r in S.normalize_levels(t).orderBy("ord").collect()] == want


def test_toc_and_text(spark):
    b = spark.createDataFrame([("b", 1, 0, "h1", "One"), ("b", 2, 0, "h1", " one "), ("b", 3, 0, "h2", "Two"), ("b", 3, 1, "p", "x"), ("b", 4, 0, "h3", "no")], BLOCKS)
    toc = S.toc_from_headings(b)
    assert [(r.level, r.title, r.page) for r in toc.orderBy("ord").collect()] == [(1, "One", 1), (2, "Two", 3)]
    assert S.toc_text(toc).first().text == "One | 1\n  Two | 3"
    assert S.valid_toc(toc, F.lit(2)).count() == 1


def test_page_labels(spark):
    schema = "job string, idx int, printed_page string, roman string, body_start int"
    rows = [("a", i, None, "v" if i == 4 else "", 8) for i in range(9)]
    got = [r.label for r in S.page_labels(spark.createDataFrame(rows, schema)).orderBy("idx").collect()]
    assert got == ["", "", "", "iv", "v", "vi", "vii", "1", "2"]
    rows = [("a", 0, None, "", 1), ("a", 1, "१२", "", 1), ("a", 2, "१३", "", 1)]
    assert [r.label for r in S.page_labels(spark.createDataFrame(rows, schema)).orderBy("idx").collect()] == ["११", "१२", "१३"]


def test_label_ranges(spark):
    r = spark.createDataFrame([("b", 1, "", "r", 1), ("b", 4, "A-", "D", 10)], "job string, startpage int, prefix string, style string, firstpagenum int")
    p = spark.createDataFrame([("b", i) for i in range(1, 6)], "job string, page int")
    assert [x.label for x in S.labels_from_ranges(p, r).orderBy("page").collect()] == ["i", "ii", "iii", "A-10", "A-11"]


def test_offset_mode_takes_first_of_ties(spark):
    x = spark.createDataFrame([("a", 0, 5), ("a", 1, 3), ("a", 2, 3), ("a", 3, 5), ("b", 0, 7)], "job string, idx int, off int")
    assert [tuple(r) for r in S.offset_mode(x, "off", ["job"], "idx").collect()] == [("a", 5, 2)]


def test_sideheads_merge(spark):
    f = spark.createDataFrame([("b", 1, 0.0, 0.0, 10.0, 10.0, "A"), ("b", 1, 2.0, 20.0, 12.0, 30.0, "B"), ("b", 1, 0.0, 60.0, 9.0, 70.0, "C")], "job string, page int, x0 double, y0 double, x1 double, y1 double, text string")
    assert [(r.text, r.y0, r.y1) for r in S.merge_sideheads(f).orderBy("y0").collect()] == [("A\nB", 0.0, 30.0), ("C", 60.0, 70.0)]


def test_glyph_pairs(spark):
    rows = [("b", 1, 0, "p", "ka", None), ("b", 1, 1, "image", "", "i1"), ("b", 1, 2, "p", "kha", None), ("b", 1, 3, "image", "", "i2"), ("b", 1, 4, "p", "text", None)]
    b = spark.createDataFrame(rows, BLOCKS + ", image_id string")
    assert [(r.label, r.image_id) for r in S.glyph_pairs(b).orderBy("idx").collect()] == [("ka", "i1"), ("kha", "i2")]


def test_verdicts(spark):
    schema = "o double, a int, b int, lost boolean, fd double, fo double, c double"
    rows = [(0.4, 30, 5, False, 0.0, 0.0, 0.0), (0.6, 16, 5, False, 0.0, 0.0, 0.0), (0.6, 15, 5, False, 0.0, 0.0, 0.0), (0.9, 50, 50, True, 0.0, 0.0, 0.0), (0.9, 5, 5, False, 0.36, 0.41, 0.0), (0.9, 5, 5, False, 0.3504, 0.41, 0.0), (0.9, 5, 5, False, 0.0, 0.0, 0.2)]
    x = spark.createDataFrame(rows, schema)
    status, warnings = L.page_verdict(*[F.col(c) for c in ("o", "a", "b", "lost", "fd", "fo", "c")])
    got = x.select(status.alias("s"), F.size(warnings).alias("n")).collect()
    assert [r.s for r in got] == ["FAIL", "WARN", "PASS", "WARN", "WARN", "PASS", "WARN"]
    s = spark.createDataFrame([("PASS", 1.0)] * 19 + [("FAIL", 0.1)], "status string, overlap double")
    assert L.concordance(s).first().verdict == "WARN"
    assert L.concordance(s, F.lit(3)).first().verdict == "FAIL"


def test_audit_of_no_pages(spark):
    a = spark.createDataFrame([], "page int, clashes long, faulty boolean")
    assert L.clean_share(a).first().clean_percent == 100.0


def test_fit_levels(spark):
    p = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 99.0)], "job string, page int, need double")
    assert {tuple(r) for r in L.fit_levels(p, [(0, 4.0), (1, 8.0)]).collect()} == {("a", 1, 1, True), ("a", 2, 1, False)}


def test_canonical_alignment(spark):
    canon = spark.createDataFrame([("b", 0, "1.1.1", ["1.1.1"], "alpha beta"), ("b", 1, "1.1.2", ["1.1.2"], "gamma delta"), ("b", 2, "1.1.3", ["1.1.3"], "epsilon")], "job string, ord int, ref string, keys array<string>, text string")
    keys = canon.select("job", F.explode("keys").alias("key"), "ord")
    blocks = spark.createDataFrame([("b", 1, 0, "h2", "alpha bета"), ("b", 1, 1, "h2", "alpha betta"), ("b", 1, 2, "p", "text"), ("b", 2, 0, "h2", "01.1.3 something"), ("b", 2, 1, "h2", "gamma delta")], BLOCKS)
    a = A.align_canonical(S.entries(blocks), canon, keys, 0.6).orderBy("ord").collect()
    # the explicit reference moves the cursor past the entry that would have matched
    assert [(r.ref, r.body) for r in a] == [("1.1.1", ""), ("1.1.3", "")]
    # at half, where it stands by default, "alpha betta" is like enough to "gamma delta"
    assert [r.ref for r in A.align_canonical(S.entries(blocks), canon, keys).orderBy("ord").collect()] == ["1.1.1", "1.1.2", "1.1.3"]


def test_windowed_alignment_and_fill(spark):
    roots = spark.createDataFrame([("b", i, 1, i * 10, "", "", w, w + " going") for i, w in enumerate(["bhu", "edh", "spardh"])], "job string, ord int, class int, id long, root string, meaning string, iast_root string, iast_meaning string")
    lines = spark.createDataFrame([("b", 30, 0, 1, "bhu going"), ("b", 31, 0, 1, "XIV"), ("b", 32, 0, 1, "spardh going")], "job string, page long, idx int, class int, text string")
    full = A.fill_unmatched(roots, A.align_windowed(lines, roots)).orderBy("ord").collect()
    assert [(r.id, r.page, r.interpolated) for r in full] == [(0, 30, False), (10, 30, True), (20, 32, False)]


def test_token_alignment():
    m = A.align_tokens(["Tbe", "quick", "Verbal....69", "~~~~", "brownfox", "end"], "The quick Verbal brown fox end")
    assert m["Tbe"] == "The" and m["Verbal....69"] == "Verbal 69" and m["~~~~"] == ""
    assert A.align_tokens(["brownfox"], "brown fox") == {"brownfox": "brown fox"}
    assert A.align_tokens([], "") == {}


def test_access(spark):
    schema = "admin boolean, auth boolean, user string, email string, assigned string"
    rows = [(True, True, "a", "a@x", "z"), (False, True, "z", "z@x", "z"), (False, True, "q", "z", "z"), (False, True, "q", "q@x", "z"), (False, False, None, None, "z"), (False, False, None, None, None), (False, True, "q", "q@x", "")]
    x = spark.createDataFrame(rows, schema)
    args = [F.col(c) for c in ("admin", "auth", "user", "email", "assigned")]
    got = x.select(J.may("view", *args).alias("v"), J.may("trigger", *args).alias("t")).collect()
    assert [r.v for r in got] == [True, True, True, False, False, True, True]
    assert [r.t for r in got] == [True, True, True, False, False, False, True]


def test_validators(spark):
    rows = [("ok-1", " deu+eng ", "85", "10", "paginated", " A4 "), ("../x", "Deutsch!", "101", "-1", "grid", "a3"), (None, None, None, None, None, None), ("a.b", "x", "85.5", "+7", "", "")]
    x = spark.createDataFrame(rows, "j string, l string, t string, n string, m string, p string")
    checks = (J.valid_job_name, J.valid_language, J.valid_threshold, J.valid_limit, J.valid_mode, J.valid_paper)
    got = x.select(*[f(F.col(c)) for f, c in zip(checks, "jltnmp", strict=True)], J.valid_run_id(F.col("j"))).collect()
    assert [tuple(r) for r in got] == [
        (True, "deu+eng", True, True, "paginated", "a4", True),
        (False, "deu+eng", False, False, "", "", False),
        (False, "deu+eng", False, False, "", "", False),
        (True, "deu+eng", False, True, "", "", True),
    ]


def test_security(spark):
    rules = spark.createDataFrame([("key", "secret=\\w+", "high")], "rule string, pattern string, severity string")
    files = spark.createDataFrame([("a.py", "x\nsecret=abc secret=d\nsecret=e # ok"), ("k.pem", None)], "file string, text string")
    assert [tuple(r) for r in C.security_scan(files, rules, allow="# ok").collect()] == [("a.py", 2, "key", "high", "secret=abc")]
    assert [r.file for r in C.forbidden_files(files, [r"\.pem$"]).collect()] == ["k.pem"]


def test_report_pages(spark):
    p = spark.createDataFrame([("a", i, "PASS" if i % 2 else "WARN") for i in range(6)] + [("b", i, "PASS") for i in range(20)], "job string, page int, status string")
    got = J.flagged_rows(p).groupBy("job").count().collect()
    assert {r.job: r["count"] for r in got} == {"a": 3, "b": 15}
