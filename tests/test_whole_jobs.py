"""Queries over whole tables: nothing left out by length, prefix or remainder."""

import random
import re
from collections import Counter

import oracle
import pytest

from quiremill.operators import layout as L
from quiremill.operators import structure as S
from quiremill.plans import queries  # noqa: F401
from quiremill.plans.registry import QUERIES

def test_token_overlaps_by_hand(spark):
    o = spark.createDataFrame([(1, "one two"), (2, ""), (3, "zz yy one"), (4, None), (5, "only here")], "page long, text string")
    d = spark.createDataFrame([(1, "two one one " + "more " * 999), (2, None), (3, "ONE"), (4, "x1"), (6, "only there")], "page long, text string")
    got = {r.page: (r.original_tokens, r.digital_tokens, r.shared, round(r.overlap, 6)) for r in L.token_overlaps(L.page_pairs(o, d, ["page"])).collect()}
    assert got == {1: (2, 3, 2, 0.666667), 2: (0, 0, 0, 1.0), 3: (3, 1, 1, 0.333333), 4: (0, 1, 0, 0.0)}


def test_pairs_by_plain_sets(spark, sf):
    pages = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    token = re.compile(r"[\w-]+")
    tokens = lambda t: {w for w in token.findall((t or "").lower()) if len(w) > 1 or w in ("a", "i", "u")}
    vowels = str.maketrans("aeiou", "ouaie")
    digital = lambda i, t: t if i % 3 == 0 else re.sub(" [aeiou][a-z]*", "", t) if i % 3 == 1 else t.translate(vowels)
    statuses = set()
    for r in QUERIES["edition_jaccard"](spark, sf).collect():
        a, b = tokens(pages[r.doc_id]), tokens(digital(r.doc_id, pages[r.doc_id]))
        assert (r.original_tokens, r.digital_tokens, r.shared) == (len(a), len(b), len(a & b))
    for r in QUERIES["edition_verdict"](spark, sf).collect():
        statuses.add(r.status)
    assert len(statuses) == 3


def test_cross_overlaps_by_hand(spark):
    # two passages and two documents of one id, and rows without id, are rows of their own
    b = spark.createDataFrame([(1, "one two"), (2, ""), (3, "zz yy one"), (3, None), (None, "ONE")], "item_id long, text string")
    d = spark.createDataFrame([(7, "two one one " + "more " * 999), (8, None), (9, "zz"), (9, "zz"), (None, "x1")], "doc_id long, text string")
    got = Counter((r.item_id, r.doc_id, r.item_tokens, r.doc_tokens, r.shared, round(r.overlap, 6)) for r in L.cross_overlaps(b, d).collect())
    items, docs = [(1, {"one", "two"}), (2, set()), (3, {"zz", "yy", "one"}), (3, set()), (None, {"one"})], [(7, {"two", "one", "more"}), (8, set()), (9, {"zz"}), (9, {"zz"}), (None, {"x1"})]
    assert got == Counter((i, j, len(x), len(y), len(x & y), round(len(x & y) / len(x | y), 6) if x | y else 1.0) for i, x in items for j, y in docs)
    assert L.cross_overlaps(b.limit(0), d).count() == L.cross_overlaps(b, d.limit(0)).count() == 0


_TOK = r"list_distinct(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_-]+'), lambda x: length(x) > 1 OR x IN ('a', 'i', 'u')))"
_ALL_PAIRS = f"""WITH b AS (SELECT item_id, {_TOK} AS s FROM benchmark), d AS (SELECT doc_id, {_TOK} AS s FROM documents),
k AS (SELECT item_id, doc_id, len(b.s) AS nb, len(d.s) AS nd, len(list_intersect(b.s, d.s)) AS k FROM b, d),
p AS (SELECT *, CASE WHEN nb + nd = 0 THEN 1.0 ELSE k / (nb + nd - k) END AS j FROM k),
v AS (SELECT *, CASE WHEN j < 0.45 AND (nb > 20 OR nd > 20) THEN 'FAIL' WHEN j < 0.65 AND nb > 15 THEN 'WARN' ELSE 'PASS' END AS status FROM p)"""


def test_token_jaccard_has_all_pairs(spark, sf):
    oracle.same(QUERIES["token_jaccard"](spark, sf), _ALL_PAIRS + " SELECT item_id, doc_id, round(j, 9) AS overlap FROM v", sf)


def test_concordance_verdict_has_all_pairs(spark, sf):
    oracle.same(QUERIES["concordance_verdict"](spark, sf), _ALL_PAIRS + " SELECT item_id, doc_id, status FROM v", sf)


def test_concordance_summary_is_over_all_pairs(spark, sf):
    sql = """, a AS (SELECT count(*) AS pages, count(*) FILTER (status = 'PASS') AS pass, count(*) FILTER (status = 'WARN') AS warn, count(*) FILTER (status = 'FAIL') AS fail, round(avg(j), 6) AS mean_overlap FROM v)
SELECT *, CASE WHEN fail > 0 THEN CASE WHEN fail > 0.05 * pages THEN 'FAIL' ELSE 'WARN' END WHEN warn > 0.2 * pages THEN 'WARN' ELSE 'PASS' END AS verdict FROM a"""
    oracle.same(QUERIES["concordance_summary"](spark, sf), _ALL_PAIRS + sql, sf)


def test_missing_references_by_hand(spark):
    r = spark.createDataFrame([(1, 41, "a long reference"), (1, 41, "short"), (1, 41, "short"), (1, 7, "x"), (2, 8, "y"), (2, 9, None), (3, 1, "gone"), (4, 5, "here")], "job long, page long, ref string")
    p = spark.createDataFrame([(1, 41, "a long refuge"), (1, 7, "." * 3000 + "x"), (2, 8, None), (4, 5, "where")], "job long, page long, text string")
    got = {(x.job, x.page): x.missing for x in L.missing_references(r, p).collect()}
    assert got == {(1, 41): ["a long reference", "short"], (2, 8): ["y"], (3, 1): ["gone"]}


@pytest.mark.parametrize("n", [1, 4, 5, 9, 10, 101])
def test_index_percentile(spark, n):
    v = [(i * 7) % 5 + i / 100 for i in range(n)]
    df = spark.createDataFrame([(x,) for x in v], "v double")
    for q in (0.0, 0.2, 0.5, 0.9):
        assert df.agg(L.index_percentile("v", q).alias("p")).first().p == sorted(v)[int(n * q)]


def test_first_match_in_bins(spark):
    rnd = random.Random(1)
    pages = [(j, p, rnd.choice(["alpha", "beta", "none", None])) for j in (1, 2) for p in range(-5, 300)]
    ranges = [(rnd.choice([1, 2, 3]), i, s, s + rnd.choice([-1, 0, 5, 64, 200]), rnd.choice(["alp", "zzz"]), rnd.choice(["bet", "zzz"])) for i, s in enumerate(rnd.choices(range(-10, 320), k=60))]
    p = spark.createDataFrame(pages, "job int, page int, text string")
    r = spark.createDataFrame(ranges, "job int, name int, s int, e int, pattern string, fallback string")
    got = {x.name: x.page for x in S.first_match_in_range(p, r, -99).collect()}
    for job, name, s, e, pattern, fallback in ranges:
        inside = sorted((q, t) for j, q, t in pages if j == job and s <= q <= e)
        first = lambda x: next((q for q, t in inside if t and x in t), None)
        strict, loose = first(pattern), first(fallback)
        assert got[name] == (strict if strict is not None else loose if loose is not None else -99)


def test_format_sizes(spark, sf, tmp_path):
    rows = [(1, 255), (2, 1024 + 256), (3, 1024 + 768), (4, 1 << 20), (5, (1 << 20) - 1), (6, 13 << 18), (7, 41 << 17), (8, 0), (9, None), (10, 1023)]
    spark.createDataFrame(rows, "doc_id long, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.size for r in QUERIES["format_sizes"](spark, str(tmp_path)).collect()}
    # as Python's round() has them: one place for KB, up to two for MB
    assert got == {1: "255 B", 2: "1.2 KB", 3: "1.8 KB", 4: "1.0 MB", 5: "1024.0 KB", 6: "3.25 MB", 7: "5.12 MB", 8: "0 B", 9: None, 10: "1023 B"}
    sql = "SELECT doc_id, CASE WHEN n_chars < 1024 THEN n_chars || ' B' ELSE printf('%.1f KB', n_chars / 1024.0) END AS size FROM documents"
    oracle.same(QUERIES["format_sizes"](spark, sf), sql, sf)
