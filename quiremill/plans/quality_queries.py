"""Gate and report queries: ``events`` stands for OCR words, a user for a page, a value for a confidence."""

from pyspark.sql import functions as F

from quiremill.operators import jobs as J
from quiremill.operators import quality as Q
from quiremill.operators.alignment import correct_words
from quiremill.plans.registry import query

_WORDS = "SELECT user_id AS page, event_id AS idx, value AS conf, event_type AS text FROM events WHERE value >= 0"


def table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def words(spark, d):
    e = table(spark, d, "events")
    return e.where(F.col("value") >= 0).select(F.col("user_id").alias("page"), F.col("event_id").alias("idx"), F.col("value").alias("conf"), F.col("event_type").alias("text"))


@query(
    "quality_gate",
    """SELECT user_id AS page, count(value) AS word_count, round(avg(value), 3) AS mean_confidence, min(value) AS min_confidence,
  max(value) AS max_confidence, round(avg(value), 3) >= 40 AS passed,
  CASE WHEN round(avg(value), 3) >= 40 THEN 'pass' ELSE 'fallback' END AS decision,
  list_extract(list_sort(list(value)), 1) AS lowest, list_extract(list_sort(list(value)), 5) AS fifth_lowest
FROM events WHERE value >= 0 GROUP BY user_id""",
)
def quality_gate(spark, d):
    g = Q.quality_gate(words(spark, d), 40.0)
    return g.select("page", "word_count", "mean_confidence", "min_confidence", "max_confidence", "passed", "decision", F.get("low_samples", F.lit(0)).alias("lowest"), F.get("low_samples", F.lit(4)).alias("fifth_lowest"))


@query(
    "gate_with_empty_pages",
    """SELECT p.page, coalesce(g.n, 0) AS word_count, coalesce(g.m, 0.0) AS mean_confidence,
  CASE WHEN g.n > 0 AND g.m >= 40 THEN 'pass' ELSE 'fallback' END AS decision, CASE WHEN g.n IS NULL THEN 'no words recognised' END AS note
FROM (SELECT DISTINCT c_custkey AS page FROM customer) p LEFT JOIN (
  SELECT user_id, count(value) AS n, round(avg(value), 3) AS m FROM events WHERE value >= 0 GROUP BY user_id) g ON g.user_id = p.page""",
)
def gate_with_empty_pages(spark, d):
    pages = table(spark, d, "customer").select(F.col("c_custkey").alias("page"))
    return Q.quality_gate(words(spark, d), 40.0, pages=pages).select("page", "word_count", "mean_confidence", "decision", "note")


@query("low_confidence_words", f"SELECT * FROM ({_WORDS}) WHERE conf <= 12.5")
def low_confidence_words(spark, d):
    return Q.low_confidence_words(words(spark, d), 12.5)


@query("valid_words", "SELECT event_id AS idx, value AS conf FROM events WHERE value >= 0 AND trim(event_type) <> ''")
def valid_words(spark, d):
    return Q.valid_words(table(spark, d, "events").select(F.col("event_id").alias("idx"), F.col("value").alias("conf"), F.col("event_type").alias("text"))).select("idx", "conf")


@query(
    "gate_counters",
    f"""SELECT text AS stage, count(*) AS pages, count(*) FILTER (m >= 40) AS passed_pages, count(*) FILTER (NOT m >= 40) AS fallback_pages
FROM (SELECT text, page, round(avg(conf), 3) AS m FROM ({_WORDS}) GROUP BY text, page) GROUP BY text""",
)
def gate_counters(spark, d):
    g = words(spark, d).groupBy(F.col("text").alias("stage"), "page").agg(F.round(F.avg("conf"), 3).alias("m"))
    return Q.gate_counters(g.withColumn("passed", F.col("m") >= 40), ["stage"])


@query(
    "quality_tiers",
    f"""WITH p AS (SELECT page, page % 10 AS job, round(avg(conf), 3) AS m FROM ({_WORDS}) GROUP BY page),
r AS (SELECT job, count(*) AS pages, count(*) FILTER (m < 40) AS fallback_pages, round(avg(m), 2) AS mean_confidence,
  round(min(m), 2) AS min_confidence, round(max(m), 2) AS max_confidence FROM p GROUP BY job)
SELECT *, (pages - fallback_pages) / pages AS pass_ratio, fallback_pages * 0.004 AS cost,
  CASE WHEN fallback_pages / pages >= 0.8 OR mean_confidence >= 95 THEN 'A'
       WHEN mean_confidence >= 85 OR fallback_pages / pages >= 0.3 THEN 'B' ELSE 'C' END AS tier FROM r""",
)
def quality_tiers(spark, d):
    g = Q.quality_gate(words(spark, d), 40.0)
    return J.job_report(g.withColumn("job", F.col("page") % 10), ["job"])


@query(
    "word_corrections",
    f"""WITH c AS (SELECT CASE p_size % 3 WHEN 0 THEN 'id' WHEN 1 THEN 'index' ELSE 'replace' END AS scope,
  CASE p_size % 3 WHEN 2 THEN CASE p_size % 2 WHEN 0 THEN 'click' ELSE 'view' END ELSE p_partkey::VARCHAR END AS key, max(p_brand) AS v FROM part GROUP BY 1, 2),
w AS ({_WORDS})
SELECT page, idx, conf, coalesce(a.v, b.v, r.v, w.text) AS text, coalesce(a.v, b.v, r.v) IS NOT NULL AS corrected
FROM w LEFT JOIN c a ON a.scope = 'id' AND a.key = w.idx::VARCHAR LEFT JOIN c b ON b.scope = 'index' AND b.key = w.idx::VARCHAR
LEFT JOIN c r ON r.scope = 'replace' AND r.key = w.text""",
)
def word_corrections(spark, d):
    k = F.col("p_size") % 3
    fixes = table(spark, d, "part").select(
        F.when(k == 0, "id").when(k == 1, "index").otherwise("replace").alias("scope"),
        F.when(k == 2, F.when(F.col("p_size") % 2 == 0, "click").otherwise("view")).otherwise(F.col("p_partkey").cast("string")).alias("key"),
        F.col("p_brand").alias("value"),
    )
    w = words(spark, d).withColumn("id", F.col("idx").cast("string"))
    return correct_words(w, fixes).select("page", "idx", "conf", "text", "corrected")


@query(
    "stage_progress",
    """WITH e(ord, stage, least, per, fixed, most) AS (VALUES (1, 'ingress', 1.0, 0.25, 0.0, NULL), (2, 'preprocess', 1.0, 0.8, 0.0, NULL),
  (3, 'local_ocr', 1.5, 1.0, 0.0, NULL), (4, 'cloud_fallback', 1.5, 1.8, 0.0, NULL), (5, 'sandwich', 2.0, 0.4, 3.0, 15.0),
  (6, 'typeset', 2.0, 0.2, 2.0, 10.0), (7, 'correction', 2.0, 0.3, 3.0, 12.0), (8, 'report', 1.0, 0.1, 1.5, 8.0)),
j AS (SELECT user_id AS job, count(*) AS pages, count(*) FILTER (event_type = 'view') AS v FROM events GROUP BY user_id)
SELECT job, pages, ord, stage, round(least(greatest(least, per * pages + fixed), coalesce(most, 1e300))::DOUBLE, 6) AS estimate_s,
  CASE WHEN stage = 'ingress' THEN pages WHEN stage = 'preprocess' THEN v ELSE 0 END AS done,
  round(least(100.0, 100.0 * (CASE WHEN stage = 'ingress' THEN pages WHEN stage = 'preprocess' THEN v ELSE 0 END) / pages)::DOUBLE, 6) AS percent,
  CASE WHEN stage = 'ingress' OR stage = 'preprocess' AND v >= pages THEN 'completed' WHEN stage = 'preprocess' AND v > 0 THEN 'running' ELSE 'pending' END AS status
FROM j, e""",
)
def stage_progress(spark, d):
    e = table(spark, d, "events").groupBy(F.col("user_id").alias("job")).agg(F.count("*").alias("pages"), F.count_if(F.col("event_type") == "view").alias("v"))
    s = J.stage_progress(e.select("job", "pages", F.create_map(F.lit("ingress"), F.col("pages"), F.lit("preprocess"), F.col("v")).alias("done")))
    return s.withColumns({"estimate_s": F.round("estimate_s", 6), "percent": F.round("percent", 6)})


@query(
    "access_matrix",
    """SELECT o_orderkey AS job, c_custkey AS user, c.c_mktsegment = 'BUILDING' OR (o_custkey % 3 <> 0 AND o_custkey = c_custkey) OR o_custkey % 3 = 0 AS may_view,
  c.c_mktsegment = 'BUILDING' OR (o_custkey % 3 <> 0 AND o_custkey = c_custkey) OR (o_custkey % 3 = 0 AND c_acctbal > 0) AS may_trigger
FROM (SELECT *, unnest([o_custkey, o_custkey + 1]) AS asks FROM orders) JOIN customer c ON c.c_custkey = asks""",
)
def access_matrix(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    x = o.withColumn("asks", F.explode(F.array("o_custkey", F.col("o_custkey") + 1))).join(c, F.col("c_custkey") == F.col("asks"))
    user = F.col("c_custkey").cast("string")
    who = F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey").cast("string"))
    args = (F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") > 0, user, user, who)
    return x.select(F.col("o_orderkey").alias("job"), F.col("c_custkey").alias("user"), J.may("view", *args).alias("may_view"), J.may("trigger", *args).alias("may_trigger"))


@query(
    "cache_anti_join",
    "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def cache_anti_join(spark, d):
    results = table(spark, d, "labels").select("doc_id", F.lit(1).alias("size"))
    return J.unfinished(table(spark, d, "documents").select("doc_id", "source"), results, ["doc_id"])


@query(
    "job_catalogue",
    """SELECT coalesce(i.job, o.job) AS job, coalesce(i.n, 0) AS input_pages, coalesce(o.n, 0) AS artifacts, coalesce(o.b, 0) AS bytes,
  round(coalesce(r.f, 0) * 0.004, 6) AS cost, r.job IS NOT NULL AS has_report
FROM (SELECT source AS job, count(*) AS n FROM documents WHERE lang <> 'en' GROUP BY 1) i
FULL JOIN (SELECT source AS job, count(*) AS n, sum(n_chars) AS b FROM documents WHERE lang = 'en' GROUP BY 1) o ON o.job = i.job
LEFT JOIN (SELECT source AS job, count(*) AS f FROM documents WHERE n_chars > 5000 GROUP BY 1) r ON r.job = coalesce(i.job, o.job)""",
)
def job_catalogue(spark, d):
    t = table(spark, d, "documents").select(F.col("source").alias("job"), "lang", F.col("n_chars").alias("size"), F.lit(None).cast("timestamp").alias("modified"))
    r = t.where("size > 5000").groupBy("job").agg(F.count("*").alias("fallback_pages"))
    return J.job_catalogue(t.where("lang <> 'en'"), t.where("lang = 'en'"), r).drop("modified").withColumn("cost", F.round("cost", 6))


@query(
    "recent_jobs",
    "SELECT o_orderkey AS job, o_orderdate AS modified FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 6",
)
def recent_jobs(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("job"), F.col("o_orderdate").alias("modified")).orderBy(F.desc("modified"), "job").limit(6)
