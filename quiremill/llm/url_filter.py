"""URL filters with redirect equivalence.

Rules name a host and the start of a path; they fit the host and its subdomains, the longest rule
wins.  A url without a rule of its own takes the verdict of its aliases: urls joined by redirects
(HTTP or meta refresh) and by canonical links form connected components; a component with an
allowed url is allowed, else one with a blocked url is blocked; all others are allowed.

Rules are a short list in the plan (their number is checked), so matching is one projection in the
scan.  Edges are few and small: two keys each.  Only they and the urls' keys are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.llm.common import ascii_lower, others, quoted, table
from quiremill.llm.components import components

MAX_RULES = 500

#: (host, start of path, verdict)
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def host(url: Column) -> Column:
    """What stands between the first ``://`` and the next of ``/ ? #``, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node(url: Column) -> Column:
    """The identity of a url in the graph: host, path and query, whatever the scheme and fragment."""
    query = F.regexp_extract(url, r"^(?s).*?://[^?#]*(\?[^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host(url), F.when(path(url) == "", "/").otherwise(path(url)), query))


def match(h: Column, p: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none; of equal lengths the first listed."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; more than {MAX_RULES} don't belong in a plan")
    rule = verdict = F.lit(None).cast("string")
    for at, start, what in reversed(sorted(rules, key=lambda r: -len(r[0] + r[1]))):
        fits = ((h == at) | h.endswith("." + at)) & p.startswith(start)
        rule, verdict = F.when(fits, at + start).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst) urls from canonical links and meta refreshes in the pages, made absolute."""
    tag = lambda kind: rf"(?is)<{kind}\b[^>]*>"
    links = F.filter(F.regexp_extract_all(html_col, F.lit(tag("link")), F.lit(0)), lambda x: x.rlike(r"(?is)\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"))
    hrefs = F.transform(links, lambda x: F.regexp_extract(x, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1))
    metas = F.filter(F.regexp_extract_all(html_col, F.lit(tag("meta")), F.lit(0)), lambda x: x.rlike(r"(?is)http-equiv\s*=\s*[\"']?refresh"))
    urls = F.transform(metas, lambda x: F.regexp_extract(x, r"(?is)url\s*=\s*[\"']?([^\"'\s>]+)", 1))
    u = F.col(url_col)
    scheme, root = F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1), F.regexp_extract(u, r"^(?s)(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(u, r"^(?s)(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    d = F.col("dst")
    full = F.when(d.contains("://"), d).when(d.startswith("//"), F.concat(scheme, F.lit(":"), d)).when(d.startswith("/"), F.concat(root, d)).otherwise(F.concat(F.rtrim(folder, F.lit("/")), F.lit("/"), d))
    few = F.col(html_col).contains("canonical") | F.lower(html_col).rlike("http-equiv|canonical")
    found = pages.where(u.contains("://") & few).select(u, F.explode(F.concat(hrefs, urls)).alias("dst")).where("dst <> ''")
    return found.select(u.alias("src"), full.alias("dst"))


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", html_col: str | None = "html", redirects: DataFrame | None = None) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``component`` (null without links).

    Columns of these names are replaced, further ones kept.  ``redirects``: (src, dst) urls of HTTP
    redirects, if known.  Null urls and urls without ``://`` have an empty host and path, no rule
    and no links; null html has no links.  Repeated rows are judged alike.  A component's name is
    the node (host, path and query) that sorts first.
    """
    new = ("host", "path", "rule", "verdict", "component")
    keep = others(pages, *new)
    edges = None
    if html_col:
        edges = link_edges(pages, url_col, html_col)
    if redirects is not None:
        r = redirects.select("src", "dst")
        edges = r if edges is None else edges.union(r)
    u = F.col(url_col)
    src = pages.select(F.struct(F.lit(1).alias("_"), *map(quoted, keep)).alias("row"), u.alias("u"))
    rule, verdict = match(host(F.col("u")), path(F.col("u")), rules)
    src = src.select("row", host(F.col("u")).alias("h"), path(F.col("u")).alias("p"), node(F.col("u")).alias("n"), rule.alias("r"), verdict.alias("v"))
    if edges is None:
        src = src.select("*", F.lit(None).cast("string").alias("component"), F.lit(None).cast("string").alias("w"))
    else:
        links = edges.select(node(F.col("src")).alias("src"), node(F.col("dst")).alias("dst"))
        comp = components(links, "src", "dst")
        # a node is its url without the scheme, so the rules can judge it too
        as_url = F.concat(F.lit("//://"), F.col("node"))
        judged = comp.select("node", "component", match(host(as_url), path(as_url), rules)[1].alias("v"))
        verdicts = judged.groupBy("component").agg(F.when(F.max(F.col("v") == "allow"), "allow").when(F.max(F.col("v") == "block"), "block").alias("w"))
        src = src.join(comp.join(verdicts, "component"), src.n == comp.node, "left")
    return src.select(*[F.col("row").getField(c).alias(c) for c in keep], F.col("h").alias("host"), F.col("p").alias("path"), F.col("r").alias("rule"), F.coalesce("v", "w", F.lit("allow")).alias("verdict"), "component")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH RECURSIVE rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
tag AS (
  SELECT url, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(html, '(?is)<link\b[^>]*>'), lambda x: regexp_matches(x, '(?is)\brel\s*=\s*["'']?[^"''>]*\bcanonical\b')), lambda x: regexp_extract(x, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
    list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\b[^>]*>'), lambda x: regexp_matches(x, '(?is)http-equiv\s*=\s*["'']?refresh')), lambda x: regexp_extract(x, '(?is)url\s*=\s*["'']?([^"''\s>]+)', 1)))) AS dst
  FROM pages WHERE contains(url, '://') AND html IS NOT NULL
), link AS (
  SELECT url AS src, CASE WHEN contains(dst, '://') THEN dst
    WHEN starts_with(dst, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) || ':' || dst
    WHEN starts_with(dst, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || dst
    ELSE rtrim(regexp_extract(url, '(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)', 1), '/') || '/' || dst END AS dst
  FROM tag WHERE dst <> ''
), url AS (
  SELECT DISTINCT u, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(u, '(?s)^.*?://[^?#]*(\?[^#]*)', 1) AS query
  FROM (SELECT url AS u FROM pages UNION SELECT src FROM link UNION SELECT dst FROM link)
), node AS (
  SELECT u, host, path, CASE WHEN contains(u, '://') THEN host || CASE WHEN path = '' THEN '/' ELSE path END || query END AS n FROM url
), edge AS (
  SELECT DISTINCT a.n AS x, b.n AS y FROM link JOIN node a ON a.u = link.src JOIN node b ON b.u = link.dst WHERE a.n <> b.n
), both_ways AS (SELECT x, y FROM edge UNION SELECT y, x FROM edge),
reach(x, y) AS (SELECT DISTINCT x, x FROM both_ways UNION SELECT reach.x, both_ways.y FROM reach JOIN both_ways ON both_ways.x = reach.y),
judged AS (
  SELECT node.u, node.n, node.host, node.path, arg_max(rules.h || rules.p, length(rules.h || rules.p)) AS rule, arg_max(rules.v, length(rules.h || rules.p)) AS v
  FROM node LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL
), alias AS (
  SELECT reach.x, CASE WHEN bool_or(judged.v = 'allow') THEN 'allow' WHEN bool_or(judged.v = 'block') THEN 'block' END AS w
  FROM reach JOIN judged ON judged.n = reach.y GROUP BY reach.x
)
SELECT pages.page_id, coalesce(j.host, '') AS host, coalesce(j.path, '') AS path, j.rule, coalesce(j.v, alias.w, 'allow') AS verdict
FROM pages LEFT JOIN judged j ON j.u = pages.url LEFT JOIN alias ON alias.x = j.n
"""
