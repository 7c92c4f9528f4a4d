"""Layout queries: ``lineitem`` stands for words with boxes, an order for a page."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from quiremill.functions import text as X
from quiremill.operators import layout as L
from quiremill.plans.quality_queries import table
from quiremill.plans.registry import query


def _words(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_quantity").alias("y0"), F.col("l_extendedprice").alias("x0"), (F.col("l_extendedprice") + F.col("l_quantity") * 100).alias("x1"))


_LAP = """WITH w AS (SELECT l_suppkey AS page, round_even(l_quantity / 1.5, 0) * 1.5 AS line, l_extendedprice AS x0, l_extendedprice + l_quantity * 100 AS x1 FROM lineitem),
n AS (SELECT *, lead(x0) OVER o AS nx0, lead(x1) OVER o AS nx1 FROM w WINDOW o AS (PARTITION BY page, line ORDER BY x0, x1)),
c AS (SELECT page, count(*) AS clashes FROM n WHERE least(x1, nx1) - nx0 > 3.0 GROUP BY page)"""


@query(
    "collision_audit",
    _LAP + " SELECT s_suppkey AS page, coalesce(clashes, 0) AS clashes, coalesce(clashes, 0) >= 2 AS faulty FROM supplier LEFT JOIN c ON c.page = s_suppkey",
)
def collision_audit(spark, d):
    w = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("page"), F.col("l_quantity").alias("y0"), F.col("l_extendedprice").alias("x0"), (F.col("l_extendedprice") + F.col("l_quantity") * 100).alias("x1"))
    return L.layout_audit(w, table(spark, d, "supplier").select(F.col("s_suppkey").alias("page")), ["page"])


@query(
    "clean_share",
    _LAP + " SELECT count(*) AS pages, count(*) FILTER (clashes >= 2) AS faulty_pages, round(100.0 * (count(*) - count(*) FILTER (clashes >= 2)) / count(*), 6)::DOUBLE AS clean_percent FROM supplier LEFT JOIN c ON c.page = s_suppkey",
)
def clean_share(spark, d):
    return L.clean_share(collision_audit(spark, d)).withColumn("clean_percent", F.round("clean_percent", 6))


@query(
    "layout_medians",
    """SELECT l_returnflag, l_linestatus, median(l_quantity) AS med_quantity, median(l_extendedprice) AS med_price,
  round(quantile_cont(l_extendedprice, 0.05), 4) AS p05, round(quantile_cont(l_extendedprice, 0.95), 4) AS p95,
  list_sort(list(l_discount))[floor(count(*) * 0.2)::INT + 1] AS index_p20 FROM lineitem GROUP BY ALL""",
)
def layout_medians(spark, d):
    t = table(spark, d, "lineitem")
    return t.groupBy("l_returnflag", "l_linestatus").agg(
        F.median("l_quantity").alias("med_quantity"), F.median("l_extendedprice").alias("med_price"),
        F.round(F.percentile("l_extendedprice", 0.05), 4).alias("p05"), F.round(F.percentile("l_extendedprice", 0.95), 4).alias("p95"), L.index_percentile("l_discount", 0.2).alias("index_p20"),
    )


@query(
    "macro_vote",
    """SELECT segment, round(multi, 9) AS multi, round(marginal, 9) AS marginal, CASE WHEN multi >= 0.25 THEN 'multi_column_grid' WHEN marginal >= 0.08 THEN 'marginal_sideheads' ELSE 'single_column' END AS macro_layout
FROM (SELECT c_mktsegment AS segment, avg((c_acctbal > 7500)::INT) AS multi, avg((c_acctbal < 0)::INT) AS marginal FROM customer GROUP BY 1)""",
)
def macro_vote(spark, d):
    p = table(spark, d, "customer").select(F.col("c_mktsegment").alias("segment"), (F.col("c_acctbal") > 7500).alias("is_multicolumn"), (F.col("c_acctbal") < 0).alias("has_marginalia"))
    return L.macro_layout(p, ["segment"]).withColumns({"multi": F.round("multi", 9), "marginal": F.round("marginal", 9)})


@query(
    "weighted_centroid",
    "SELECT l_orderkey AS page, round(sum(l_extendedprice * l_quantity) / sum(l_quantity) / 100000.0, 3) AS centre FROM lineitem GROUP BY 1",
)
def weighted_centroid(spark, d):
    t = table(spark, d, "lineitem")
    return t.groupBy(F.col("l_orderkey").alias("page")).agg(F.round(L.centre_of_mass(F.col("l_extendedprice"), F.col("l_quantity"), F.lit(100000.0)), 3).alias("centre"))


@query(
    "fill_ratio",
    "SELECT l_orderkey AS page, round((max(l_quantity + 1) - min(l_quantity)) / 60.0, 9) AS fill, min(l_quantity) AS top, max(l_quantity + 1) AS bottom FROM lineitem GROUP BY 1",
)
def fill_ratio(spark, d):
    b = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_quantity").alias("y0"), (F.col("l_quantity") + 1).alias("y1"), F.lit(60.0).alias("page_h"))
    return L.fill_ratio(b, ["page"]).withColumn("fill", F.round("fill", 9))


_TOK = r"list_distinct(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_-]+'), lambda x: length(x) > 1 OR x IN ('a', 'i', 'u')))"
# Of each third document's digital text the words that begin with a vowel are left out; another third has other vowels.
_PAIRS = f"""WITH t AS (SELECT doc_id, text AS original, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN regexp_replace(text, ' [aeiou][a-z]*', '', 'g') ELSE translate(text, 'aeiou', 'ouaie') END AS digital FROM documents),
b AS (SELECT doc_id, original, digital, coalesce({_TOK.replace("(text)", "(original)")}, []) AS o, coalesce({_TOK.replace("(text)", "(digital)")}, []) AS d FROM t),
k AS (SELECT *, len(o) AS no, len(d) AS nd, len(list_intersect(o, d)) AS k FROM b),
p AS (SELECT *, CASE WHEN no + nd = 0 THEN 1.0 ELSE k / (no + nd - k) END AS j FROM k),
v AS (SELECT *, CASE WHEN j < 0.45 AND (no > 20 OR nd > 20) THEN 'FAIL' WHEN j < 0.65 AND no > 15 THEN 'WARN' ELSE 'PASS' END AS status FROM p)"""


def _editions(spark, d):
    t = table(spark, d, "documents")
    third = F.col("doc_id") % 3
    digital = F.when(third == 0, F.col("text")).when(third == 1, F.regexp_replace("text", " [aeiou][a-z]*", "")).otherwise(F.translate("text", "aeiou", "ouaie"))
    return t.select("doc_id", "text"), t.select("doc_id", digital.alias("text"))


def _pairs(spark, d):
    """Each document as a page of two editions."""
    return _judged(L.token_overlaps(L.page_pairs(*_editions(spark, d), ["doc_id"])), "original_tokens", "digital_tokens")


def _judged(p, a, b):
    zero = F.lit(0.0)
    status, _ = L.page_verdict(F.col("overlap"), F.col(a), F.col(b), F.lit(False), zero, zero, zero)
    return p.withColumn("status", status)


@query("edition_jaccard", _PAIRS + " SELECT doc_id, no AS original_tokens, nd AS digital_tokens, k AS shared, round(j, 9) AS overlap FROM v")
def edition_jaccard(spark, d):
    return _pairs(spark, d).select("doc_id", "original_tokens", "digital_tokens", "shared", F.round("overlap", 9).alias("overlap"))


_CROSS = f"""WITH b AS (SELECT item_id, coalesce({_TOK}, []) AS s FROM benchmark), d AS (SELECT doc_id, coalesce({_TOK}, []) AS s FROM documents),
k AS (SELECT item_id, doc_id, len(b.s) AS nb, len(d.s) AS nd, len(list_intersect(b.s, d.s)) AS k FROM b, d),
p AS (SELECT *, CASE WHEN nb + nd = 0 THEN 1.0 ELSE k / (nb + nd - k) END AS j FROM k),
v AS (SELECT *, CASE WHEN j < 0.45 AND (nb > 20 OR nd > 20) THEN 'FAIL' WHEN j < 0.65 AND nb > 15 THEN 'WARN' ELSE 'PASS' END AS status FROM p)"""


def _cross(spark, d):
    """Every passage with every document, as no key of the tables ties one to the other."""
    return _judged(L.cross_overlaps(table(spark, d, "benchmark"), table(spark, d, "documents")), "item_tokens", "doc_tokens")


@query("token_jaccard", _CROSS + " SELECT item_id, doc_id, round(j, 9) AS overlap FROM v")
def token_jaccard(spark, d):
    return _cross(spark, d).select("item_id", "doc_id", F.round("overlap", 9).alias("overlap"))


@query("edition_verdict", _PAIRS + " SELECT doc_id, status FROM v")
def edition_verdict(spark, d):
    return _pairs(spark, d).select("doc_id", "status")


@query("concordance_verdict", _CROSS + " SELECT item_id, doc_id, status FROM v")
def concordance_verdict(spark, d):
    return _cross(spark, d).select("item_id", "doc_id", "status")


_ROLL_UP = """, a AS (SELECT count(*) AS pages, count(*) FILTER (status = 'PASS') AS pass, count(*) FILTER (status = 'WARN') AS warn, count(*) FILTER (status = 'FAIL') AS fail, round(avg(j), 6) AS mean_overlap FROM v)
SELECT *, CASE WHEN fail > 0 THEN CASE WHEN fail > 0.05 * pages THEN 'FAIL' ELSE 'WARN' END WHEN warn > 0.2 * pages THEN 'WARN' ELSE 'PASS' END AS verdict FROM a"""


@query("edition_summary", _PAIRS + _ROLL_UP)
def edition_summary(spark, d):
    return L.concordance(_pairs(spark, d)).withColumn("mean_overlap", F.round("mean_overlap", 6))


@query("concordance_summary", _CROSS + _ROLL_UP)
def concordance_summary(spark, d):
    return L.concordance(_cross(spark, d)).withColumn("mean_overlap", F.round("mean_overlap", 6))


@query(
    "page_parity",
    _PAIRS + """, r AS (SELECT doc_id, lower(digital) AS digital, unnest(o) AS ref FROM b)
SELECT doc_id, count(*) AS missing, min(ref) AS first_missing FROM r WHERE NOT contains(digital, ref) GROUP BY doc_id""",
)
def page_parity(spark, d):
    """The tokens of each original page that its digital page doesn't hold."""
    original, digital = _editions(spark, d)
    refs = original.select("doc_id", F.explode(F.array_distinct(X.concordance_tokens(F.col("text")))).alias("ref"))
    m = L.missing_references(refs, digital.withColumn("text", F.lower("text")), ["doc_id"])
    return m.select("doc_id", F.size("missing").cast("bigint").alias("missing"), F.get("missing", F.lit(0)).alias("first_missing"))


@query(
    "fit_levels",
    """SELECT o_custkey AS job, o_orderkey AS page, CASE WHEN o_totalprice <= 50000 THEN 0 WHEN o_totalprice <= 150000 THEN 1 ELSE 2 END AS level, o_totalprice <= 300000 AS converged FROM orders""",
)
def fit_levels(spark, d):
    p = table(spark, d, "orders").select(F.col("o_custkey").alias("job"), F.col("o_orderkey").alias("page"), F.col("o_totalprice").alias("need"))
    return L.fit_levels(p, [(0, 50000.0), (1, 150000.0), (2, 300000.0)])


@query(
    "layout_faults",
    """WITH w AS (SELECT l_partkey AS page, round_even(l_quantity / 1.5, 0) * 1.5 AS line, l_extendedprice AS x0, l_extendedprice + l_quantity * 100 AS x1, 5.4 + l_extendedprice / 10000 AS size FROM lineitem),
n AS (SELECT *, lead(x0) OVER o AS nx0, lead(x1) OVER o AS nx1 FROM w WINDOW o AS (PARTITION BY page, line ORDER BY x0, x1)),
c AS (SELECT page, count(*) AS words, count(*) FILTER (least(x1, nx1) - nx0 > 3.0) AS clashes, max(x1) - min(x0) AS text_w, min(size) AS min_size FROM n GROUP BY page),
a AS (SELECT p_partkey AS page, coalesce(clashes, 0) AS clashes, coalesce(words >= 25 AND text_w / (250000 + p_retailprice * 100) < 0.25, false) AS narrow, coalesce(words >= 15 AND min_size < 5.5, false) AS tiny
  FROM part LEFT JOIN c ON c.page = p_partkey)
SELECT *, clashes >= 2 OR narrow OR tiny AS faulty FROM a""",
)
def layout_faults(spark, d):
    w = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("page"), F.col("l_quantity").alias("y0"), F.col("l_extendedprice").alias("x0"), (F.col("l_extendedprice") + F.col("l_quantity") * 100).alias("x1"),
        (F.lit(5.4) + F.col("l_extendedprice") / 10000).alias("size"), F.lit("a line of text").alias("text"),
    )
    pages = table(spark, d, "part").select(F.col("p_partkey").alias("page"), (F.lit(250000) + F.col("p_retailprice") * 100).alias("page_w"))
    return L.layout_audit(w, pages, ["page"], blocks=w, spans=w).select("page", "clashes", "narrow", "tiny", "faulty")


_BOOK = """p AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY key) - 1 AS page, count(*) OVER (PARTITION BY job) AS n FROM (SELECT o_custkey // 40 AS job, o_orderkey AS key, 500.0 + o_orderkey % 7 AS page_w, 800.0 + o_custkey % 5 AS page_h FROM orders)),
s AS (SELECT *, least(60, n) - least(10, greatest(0, n - 1)) < 5 AS few FROM p),
t AS (SELECT * FROM s WHERE few OR (page >= least(10, greatest(0, n - 1)) AND page < least(60, n))),
b AS (SELECT l_orderkey AS key, count(*) AS n_blocks, min(l_quantity) AS x0, max(400.0 + l_linenumber) AS x1, min(40.0 + l_linenumber * 10) AS y0, max(46.0 + l_linenumber * 10 + l_quantity) AS y1 FROM lineitem GROUP BY 1)"""


@query(
    "layout_calibration",
    f"""WITH {_BOOK},
m AS (SELECT t.*, x0 AS l, page_w - x1 AS r, y0 AS top, page_h - y1 AS bottom FROM t JOIN b USING (key) WHERE n_blocks >= 3),
g AS (SELECT job, round_even(median(l), 1) AS l, round_even(median(r), 1) AS r, round_even(median(top), 1) AS top, round_even(list_sort(list(bottom))[floor(count(*) * 0.2)::INT + 1], 1) AS bottom,
  round_even(median(CASE WHEN page % 2 = 0 THEN l ELSE r END), 1) AS i, round_even(median(CASE WHEN page % 2 = 0 THEN r ELSE l END), 1) AS o FROM m GROUP BY job),
z AS (SELECT job, round_even(median(page_w), 1) AS width, round_even(median(page_h), 1) AS height FROM t GROUP BY job),
f AS (SELECT job, round_even(median(8.0 + l_linenumber), 1) AS font_size FROM m JOIN lineitem ON l_orderkey = key GROUP BY job),
v AS (SELECT job, round_even(median(gap), 1) AS "leading" FROM (SELECT m.job, lead(40.0 + l_linenumber * 10 + l_quantity / 10) OVER (PARTITION BY m.job, m.page ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) - (40.0 + l_linenumber * 10 + 6) AS gap FROM m JOIN lineitem ON l_orderkey = key) WHERE gap BETWEEN 0.5 AND 30 GROUP BY job),
k AS (SELECT job, width, height, round_even(greatest(18.0, least(l, width * 0.4)), 1) AS "left", round_even(greatest(18.0, least(r, width * 0.4)), 1) AS "right", round_even(greatest(18.0, least(top, height * 0.4)), 1) AS top,
  round_even(greatest(18.0, least(i, width * 0.4)), 1) AS inside, round_even(greatest(18.0, least(o, width * 0.4)), 1) AS outside, round_even(greatest(18.0, least(bottom, height * 0.4)), 1) AS bottom FROM g JOIN z USING (job))
SELECT k.*, abs(inside - outside) >= 4.0 AS is_asymmetric, font_size, "leading" FROM k LEFT JOIN f USING (job) LEFT JOIN v USING (job)""",
)
def layout_calibration(spark, d):
    w = Window.partitionBy("job").orderBy(F.asc_nulls_last("o_orderkey"))
    o = table(spark, d, "orders").withColumn("job", F.expr("o_custkey div 40")).withColumn("page", F.row_number().over(w) - 1)
    pages = o.select("job", "page", (F.lit(500.0) + F.col("o_orderkey") % 7).alias("page_w"), (F.lit(800.0) + F.col("o_custkey") % 5).alias("page_h"))
    place = F.lit(40.0) + F.col("l_linenumber") * 10
    order = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*[F.asc_nulls_last(c) for c in ("l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")]))
    t = table(spark, d, "lineitem").withColumn("line", order).join(o.select("job", "page", "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    text = F.lit("line of text").alias("text")
    blocks = t.select("job", "page", F.col("l_quantity").alias("x0"), (F.lit(400.0) + F.col("l_linenumber")).alias("x1"), place.alias("y0"), (place + 6 + F.col("l_quantity")).alias("y1"), text)
    spans = t.select("job", "page", (F.lit(8.0) + F.col("l_linenumber")).alias("size"), text)
    lines = t.select("job", "page", F.lit(0).alias("block"), "line", (place + F.col("l_quantity") / 10).alias("y0"), (place + 6).alias("y1"))
    return L.layout_calibration(pages, blocks, spans, lines)
