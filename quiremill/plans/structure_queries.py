"""Queries on order: contents, sections, carried values, islands, modes, labels."""

from pyspark.sql import functions as F

from quiremill.functions import text as X
from quiremill.operators import front_matter
from quiremill.operators import structure as S
from quiremill.plans.quality_queries import table
from quiremill.plans.registry import query
from quiremill.sources import metadata as M


def _headings(spark, d):
    p = table(spark, d, "pages")
    title = F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    level = F.when(F.col("page_id") % 4 == 0, "h1").otherwise("h2")
    return p.select((F.col("page_id") % 7).alias("job"), F.col("page_id").alias("page"), F.lit(0).alias("idx"), level.alias("type"), title.alias("text"))


_H = r"""(SELECT page_id % 7 AS job, page_id AS page, CASE WHEN page_id % 4 = 0 THEN 1 ELSE 2 END AS level,
  trim(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '\s+', ' ', 'g')) AS title FROM pages)"""


@query(
    "toc_from_headings",
    f"""SELECT job, row_number() OVER (PARTITION BY job ORDER BY page) AS ord, level, title, page FROM (
  SELECT *, lag(lower(title)) OVER (PARTITION BY job ORDER BY page) AS prev FROM {_H} WHERE title <> '' AND length(title) <= 80)
WHERE lower(title) IS DISTINCT FROM prev""",
)
def toc_from_headings(spark, d):
    return S.toc_from_headings(_headings(spark, d))


@query(
    "toc_levels",
    """WITH t AS (SELECT o_custkey AS job, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, (o_orderkey % 6)::INT AS raw FROM orders),
r AS (SELECT job, i, CASE WHEN i = 1 THEN 1 ELSE greatest(raw, 1) END - i AS x FROM t)
SELECT job, i AS ord, (i + min(x) OVER (PARTITION BY job ORDER BY i))::INT AS level FROM r""",
)
def toc_levels(spark, d):
    from pyspark.sql import Window

    o = table(spark, d, "orders")
    t = o.select(F.col("o_custkey").alias("job"), F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("ord"), (F.col("o_orderkey") % 6).cast("int").alias("level"))
    return S.normalize_levels(t).select("job", "ord", "level")


@query(
    "toc_dump",
    f"""SELECT job, string_agg(repeat('  ', level - 1) || title || ' | ' || page, chr(10) ORDER BY page) AS text FROM (
  SELECT *, lag(lower(title)) OVER (PARTITION BY job ORDER BY page) AS prev FROM {_H} WHERE title <> '' AND length(title) <= 80)
WHERE lower(title) IS DISTINCT FROM prev GROUP BY job""",
)
def toc_dump(spark, d):
    return S.toc_text(S.toc_from_headings(_headings(spark, d)))


@query(
    "sections",
    """WITH s AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS section FROM conversations)
SELECT conv_id, section, count(*) AS turns, md5(string_agg(text, chr(10) ORDER BY turn)) AS h FROM s GROUP BY conv_id, section""",
)
def sections(spark, d):
    s = S.sections(table(spark, d, "conversations"), F.col("role") == "user", ["conv_id"], ["turn"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x.text), "\n")
    return s.groupBy("conv_id", "section").agg(F.count("*").alias("turns"), F.md5(text).alias("h"))


@query(
    "entries",
    """WITH b AS (SELECT conv_id, turn, role = 'user' AS opens, text FROM conversations WHERE trim(text) <> ''),
s AS (SELECT *, sum(opens::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS entry FROM b)
SELECT conv_id AS page, entry, md5(coalesce(max(text) FILTER (opens), '')) AS heading, md5(coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (NOT opens), '')) AS body FROM s GROUP BY conv_id, entry""",
)
def entries(spark, d):
    c = table(spark, d, "conversations")
    b = c.select(F.lit("all").alias("job"), F.col("conv_id").alias("page"), F.col("turn").alias("idx"), F.when(F.col("role") == "user", "h2").otherwise("p").alias("type"), "text")
    return S.entries(b, delimiter="\u0001").select("page", "entry", F.md5("heading").alias("heading"), F.md5("body").alias("body"))


@query(
    "carry_forward",
    """SELECT event_id, coalesce(last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), -1.0) AS last_purchase FROM events""",
)
def carry_forward(spark, d):
    e = table(spark, d, "events").withColumn("p", F.when(F.col("event_type") == "purchase", F.col("value")))
    return S.carry_forward(e, "p", ["user_id"], ["ts", "event_id"], "last_purchase", -1.0).select("event_id", "last_purchase")


@query(
    "gap_merge",
    """WITH x AS (SELECT user_id, epoch(ts)::DOUBLE AS y0 FROM events),
n AS (SELECT *, CASE WHEN y0 - lag(y0) OVER (PARTITION BY user_id ORDER BY y0) <= 36000 THEN 0 ELSE 1 END AS new FROM x),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY y0 ROWS UNBOUNDED PRECEDING) AS island FROM n)
SELECT user_id, island, count(*) AS n, min(y0) AS y0, max(y0) AS y1 FROM s GROUP BY user_id, island""",
)
def gap_merge(spark, d):
    e = table(spark, d, "events").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("us"))
    e = e.select("user_id", (F.col("us") / 1e6).alias("y0"))
    g = S.gap_merge(e.withColumn("y1", F.col("y0")), "y0", "y1", ["user_id"], 36000.0)
    return g.groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("y0").alias("y0"), F.max("y1").alias("y1"))


@query(
    "label_offset_mode",
    """WITH o AS (SELECT o_custkey AS job, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS idx, o_orderkey FROM orders),
v AS (SELECT job, idx, (o_orderkey % 5)::BIGINT - 1 AS off FROM o),
c AS (SELECT job, off, count(*) AS votes, min(idx) AS first FROM v GROUP BY job, off),
b AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY votes DESC, first) AS n FROM c)
SELECT job, off, votes FROM b WHERE n = 1 AND votes >= 2 AND off > 0""",
)
def label_offset_mode(spark, d):
    from pyspark.sql import Window

    o = table(spark, d, "orders")
    v = o.select(F.col("o_custkey").alias("job"), (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).alias("idx"), (F.col("o_orderkey") % 5 - 1).alias("off"))
    return S.offset_mode(v, "off", ["job"], "idx")


@query(
    "page_label_ranges",
    """WITH r AS (SELECT c_nationkey AS job, min(c_custkey) AS s FROM customer GROUP BY 1)
SELECT o_custkey % 25 AS job, o_orderkey AS page, (o_orderkey - r.s + 1)::VARCHAR AS label FROM orders JOIN r ON r.job = o_custkey % 25 WHERE o_orderkey >= r.s
UNION ALL SELECT o_custkey % 25, o_orderkey, o_orderkey::VARCHAR FROM orders JOIN r ON r.job = o_custkey % 25 WHERE o_orderkey < r.s""",
)
def page_label_ranges(spark, d):
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").cast("bigint").alias("job")).agg(F.min("c_custkey").alias("startpage"))
    ranges = c.select("job", "startpage", F.lit("").alias("prefix"), F.lit("D").alias("style"), F.lit(1).alias("firstpagenum"))
    pages = table(spark, d, "orders").select((F.col("o_custkey") % 25).alias("job"), F.col("o_orderkey").alias("page"))
    return S.labels_from_ranges(pages, ranges)


@query(
    "running_class",
    """WITH p AS (SELECT user_id AS job, event_id AS page, max(CASE WHEN event_type = 'purchase' THEN 3 WHEN event_type = 'signup' THEN 2 ELSE 1 END) AS c FROM events GROUP BY 1, 2)
SELECT job, page, max(c) OVER (PARTITION BY job ORDER BY page) AS class FROM p""",
)
def running_class(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("job"), F.col("event_id").alias("page"), F.col("event_type").alias("text"))
    return S.running_class(e, [(2, "signup"), (3, "purchase")]).select("job", "page", "class").distinct()


@query(
    "first_heading_in_range",
    r"""WITH r AS (SELECT n_nationkey AS k, n_nationkey * 8 AS s, n_nationkey * 8 + 40 + n_regionkey * 100 AS e FROM nation)
SELECT k AS name, coalesce(min(page_id) FILTER (regexp_matches(url, '/fr/')), min(page_id) FILTER (regexp_matches(url, '/en/')), -1) AS page
FROM r LEFT JOIN pages ON page_id BETWEEN s AND e AND page_id % 3 = k % 3 GROUP BY k""",
)
def first_heading_in_range(spark, d):
    n = F.col("n_nationkey")
    r = table(spark, d, "nation").select((n % 3).alias("job"), n.alias("name"), (n * 8).alias("s"), (n * 8 + 40 + F.col("n_regionkey") * 100).alias("e"), F.lit("/fr/").alias("pattern"), F.lit("/en/").alias("fallback"))
    p = table(spark, d, "pages").select((F.col("page_id") % 3).alias("job"), F.col("page_id").alias("page"), F.col("url").alias("text"))
    return S.first_match_in_range(p, r, -1).select("name", "page")


@query(
    "page_ranges",
    "SELECT o_custkey AS job, o_orderkey AS page FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders WHERE o_orderkey BETWEEN 100 AND 5000 OR o_orderkey = 7777) WHERE n <= 2",
)
def page_ranges(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("job"), F.col("o_orderkey").alias("page"))
    return M.select_pages(o, "100-5000,7777", 2, "page")


@query(
    "sample_pages",
    "SELECT c_custkey, list_sort(list_distinct(list_filter([0, 1, n // 2, least(n - 1, 24), n - 1], lambda i: i >= 0 AND i < n)))::VARCHAR AS pages FROM (SELECT c_custkey, (c_custkey % 60)::INT AS n FROM customer)",
)
def sample_pages(spark, d):
    c = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 60).cast("int").alias("n"))
    return c.select("c_custkey", F.concat(F.lit("["), F.array_join(M.sample_pages(F.col("n")).cast("array<string>"), ", "), F.lit("]")).alias("pages"))


@query(
    "page_labels",
    """WITH p AS (SELECT o_custkey AS job, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS idx, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT job, idx::INT AS idx, CASE WHEN idx >= 7 THEN (idx - 6)::VARCHAR WHEN idx < 3 OR n <= 4 THEN '' ELSE ['iv', 'v', 'vi', 'vii'][idx - 2] END AS label FROM p""",
)
def page_labels(spark, d):
    from pyspark.sql import Window

    o = table(spark, d, "orders")
    idx = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    roman = F.when(idx == 4, X.to_roman(F.lit(5))).otherwise("")
    p = o.select(F.col("o_custkey").alias("job"), idx.cast("int").alias("idx"), F.lit(None).cast("string").alias("printed_page"), roman.alias("roman"), F.lit(8).alias("body_start"))
    return S.page_labels(p)


@query(
    "dim_decode",
    """SELECT c_custkey, n_name, r_name, CASE c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'MACHINERY' THEN 'engineering' ELSE c_mktsegment END AS segment
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
def dim_decode(spark, d):
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))
    x = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select("c_custkey", "n_name", "r_name", F.col("c_mktsegment").alias("segment"))
    return M.decode_codes(x, {"segment": {"BUILDING": "construction", "MACHINERY": "engineering"}})


_FRONT = """WITH p AS (SELECT doc_id // 8 AS job, doc_id % 8 + 1 AS page, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g') AS body FROM documents),
q AS (SELECT *, lower(text) AS l, lower(body) AS b FROM p),
e AS (SELECT job, page, upper(body) IN ('CONTENTS', 'TABLE OF CONTENTS', 'INHALT') OR contains(b, 'table of contents') AS opens,
  contains(b, 'contents') OR len(list_filter(string_split(body, chr(10)), lambda x: regexp_matches(regexp_replace(x, '\\s+$', ''), '([1-9]|[1-9]0|[1-3]00)$'))) >= 3 AS runs_on,
  (page <= 4 AND length(text) <= 400 AND NOT regexp_matches(l, 'contents|isbn|copyright|all rights reserved|also available at') AND (contains(l, 'ouen') OR contains(l, 'eaux')))
    OR regexp_matches(b, 'isbn|all rights reserved|first edition|first published|printed in') OR (page <= 3 AND length(body) < 300) AS other FROM q),
f AS (SELECT *, coalesce(last_value(CASE WHEN opens THEN true WHEN NOT runs_on THEN false END IGNORE NULLS) OVER (PARTITION BY job ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS within FROM e)
SELECT job, (coalesce(max(page) FILTER (opens OR CASE WHEN within THEN runs_on ELSE other END), 0) + 1)::INT AS body_start FROM f GROUP BY job"""


@query("body_start", _FRONT)
def body_start(spark, d):
    t = table(spark, d, "documents").select(F.expr("doc_id div 8").alias("job"), (F.col("doc_id") % 8 + 1).alias("page"), F.lit(0).alias("idx"), "text")
    meta = t.select("job").distinct().select("job", F.lit("Ouen The Eaux (sketches)").alias("title"), F.lit(None).cast("string").alias("author"))
    return front_matter.body_start(t, meta)
