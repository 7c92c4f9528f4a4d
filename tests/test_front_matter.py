"""Pages of front matter, with values worked out by hand."""

from quiremill.operators import front_matter as M

BLOCKS = "job string, page int, idx int, text string"
META = "job string, title string, author string"


def test_title_pages(spark):
    rows = [
        ("b", 1, 0, "Sanskrit Primer"),
        ("b", 2, 0, "A Sanskrit Primer: First Steps"), ("b", 2, 1, "Jane Roe"), ("b", 2, 2, "North Press Ltd"),
        ("b", 3, 0, "Sanskrit Primer, all rights reserved"),
        ("b", 4, 0, "Primer " + "x" * 400),
        ("b", 5, 0, "Sanskrit Primer"),
        ("c", 1, 0, "Something else"), ("c", 2, 0, None),
    ]
    meta = spark.createDataFrame([("b", "Sanskrit Primer (2nd ed): Part One", "Jane Roe"), ("c", None, None)], META)
    got = M.title_pages(M.page_texts(spark.createDataFrame(rows, BLOCKS)), meta).orderBy("page").collect()
    assert [(r.page, r.kind, r.title, r.subtitle, r.author, r.publisher) for r in got] == [
        (1, "half_title", "Sanskrit Primer", "Part One", None, None),
        (2, "full_title", "Sanskrit Primer", "Part One", "Jane Roe", "North Press Ltd"),
    ]


def test_imprint(spark):
    texts = [
        "First edition: 1950 Reprint: 1960 Delhi", "© Someone 1950", "ISBN: 12 34", "For sale in India only", "North Press", "12 Road, Delhi 110 007 Office, Mumbai 400 026",
        "West Publishers, Pune 411 002", "a line", "Printed in India", "by hand", "territory: all",
    ]
    rows = [("b", 2, i, t) for i, t in enumerate(texts)] + [("b", 3, 0, "isbn and contents"), ("b", 6, 0, "ISBN: 1"), ("b", 1, 0, None)]
    got = M.imprints(spark.createDataFrame(rows, BLOCKS)).collect()
    assert len(got) == 1
    r = got[0]
    assert r.editions == ["First edition: 1950", "Reprint: 1960", "Delhi"]
    assert (r.copyright, r.isbn, r.publisher, r.sales) == ("© Someone 1950", "ISBN: 12 34", "North Press", "territory: all")
    assert r.addresses == ["12 Road, Delhi 110 007", "Office, Mumbai 400 026", "West Publishers, Pune 411 002"]
    assert r.colophon == ["a line", "Printed in India", "by hand"] and r.available_at == ""


def test_contents_run_on(spark):
    rows = [
        ("b", 1, 0, "Preface"), ("b", 2, 0, "x\n**Contents**"), ("b", 3, 0, "LESSON ONE 3\nLESSON TWO 9"), ("b", 4, 0, "INDEX xii\nTABLES 7"),
        ("b", 5, 0, "text"), ("b", 6, 0, "LESSON ONE 3\nLESSON TWO 9"), ("b", 30, 0, "Contents"),
    ]
    p = M.page_texts(spark.createDataFrame(rows, BLOCKS))
    assert [r.page for r in M.contents_pages(p).where("is_contents").orderBy("page").collect()] == [2, 3, 4]
    body = spark.createDataFrame([("b", 4)], "job string, body_start int")
    assert [r.page for r in M.contents_pages(p, body).where("is_contents").orderBy("page").collect()] == [2, 3]


def test_lessons(spark):
    rows = [
        ("b", 9, 0, "LESSON TWENTY-ONE"), ("b", 9, 1, "Aphabet: vowels\nlong ones\nGrammar:\nverbs"), ("b", 9, 2, None),
        ("b", 10, 0, "Lesson 4 Grammar: a"), ("b", 11, 0, "LESSON X\nGrammar: a\nReadings: b"),
    ] + [("b", 12, i, "LESSON ONE\nGrammar: a\nReadings: b") for i in range(13)]
    got = M.lesson_pages(spark.createDataFrame(rows, BLOCKS)).orderBy("page").collect()
    assert [(r.page, r.number, r.title, [(g.name, g["items"]) for g in r.syllabus]) for r in got] == [
        (9, 21, "LESSON TWENTY-ONE", [("Alphabet:", ["vowels", "long ones"]), ("Grammar:", ["verbs"])]),
        (11, None, "LESSON X", [("Grammar:", ["a"]), ("Readings:", ["b"])]),
    ]


def test_body_start(spark):
    long = "word " * 80
    rows = [
        ("a", 1, 0, "Primer"), ("a", 2, 0, "ISBN 1"), ("a", 3, 0, "CONTENTS"), ("a", 4, 0, "one 1\ntwo 20\nthree 300"), ("a", 5, 0, "one 400\n" + long), ("a", 6, 0, "printed in Rome " + long), ("a", 31, 0, "ISBN"),
        ("b", 1, 0, long), ("c", 40, 0, "ISBN"), ("d", 1, 0, "short"), ("d", 2, 0, long), ("d", 7, 0, long),
    ]
    meta = spark.createDataFrame([(j, "Primer", None) for j in "abcd"], META)
    blocks = spark.createDataFrame(rows, BLOCKS)
    assert {tuple(r) for r in M.body_start(blocks, meta).collect()} == {("a", 7), ("b", 1), ("c", 1), ("d", 2)}
    side = spark.createDataFrame([("d", 3), ("d", 7), ("a", 5)], "job string, page int")
    assert {tuple(r) for r in M.body_start(blocks, meta, side).collect()} == {("a", 7), ("b", 1), ("c", 1), ("d", 7)}
    empty = spark.createDataFrame([], BLOCKS)
    assert M.body_start(empty, meta).count() == 0 and M.imprints(empty).count() == 0 and M.lesson_pages(empty).count() == 0
