"""Text queries over ``documents`` and ``pages``."""

from pyspark.sql import functions as F

from quiremill.functions import text as X
from quiremill.operators import cleaning as C
from quiremill.plans.quality_queries import table
from quiremill.plans.registry import query
from quiremill.sources import documents as D

_LINES = """(SELECT doc_id, i - 1 AS idx, ls[i] AS text FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)))"""


def lines(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("idx", "text"))


@query(
    "repetition_filter",
    f"""SELECT doc_id, idx, text FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, text ORDER BY idx) AS n FROM {_LINES}) WHERE n <= 3""",
)
def repetition_filter(spark, d):
    return C.repetition_filter(lines(spark, d), ["doc_id"])


@query(
    "boilerplate_filter",
    f"""SELECT doc_id, count(*) AS lines FROM {_LINES} WHERE NOT regexp_matches(lower(text), 'copyright|licen[sc]e|©|all\\s+rights') GROUP BY doc_id""",
)
def boilerplate_filter(spark, d):
    rules = ["copyright", "licen[sc]e", "©", r"all\s+rights"]
    return lines(spark, d).where(~X.is_boilerplate(F.col("text"), rules)).groupBy("doc_id").agg(F.count("*").alias("lines"))


@query(
    "security_scan",
    f"""WITH r(rule, pattern, severity) AS (VALUES ('email', '[a-z0-9._]+@[a-z0-9-]+[.][a-z.]+', 'low'), ('private-ip', '(192[.]168|10[.][0-9]{{1,3}})[.][0-9]{{1,3}}[.][0-9]{{1,3}}', 'medium'),
  ('key', '(?i)(api[_-]?key|token|secret|password)\\s*[=:]\\s*\\S+', 'high'), ('key-block', '-----BEGIN [A-Z ]*PRIVATE KEY-----', 'high'))
SELECT doc_id AS file, idx + 1 AS line, rule, severity, regexp_extract(text, pattern) AS matched FROM {_LINES}, r
WHERE regexp_matches(text, pattern) AND NOT regexp_matches(text, 'allow-listed')""",
)
def security_scan(spark, d):
    rules = spark.createDataFrame(
        [("email", "[a-z0-9._]+@[a-z0-9-]+[.][a-z.]+", "low"), ("private-ip", r"(192[.]168|10[.][0-9]{1,3})[.][0-9]{1,3}[.][0-9]{1,3}", "medium"), ("key", r"(?i)(api[_-]?key|token|secret|password)\s*[=:]\s*\S+", "high"), ("key-block", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "high")],
        "rule string, pattern string, severity string",
    )
    files = table(spark, d, "documents").select(F.col("doc_id").alias("file"), "text")
    return C.security_scan(files, rules, allow="allow-listed")


@query(
    "script_ratio",
    """SELECT doc_id, round(length(regexp_replace(text, '[^\\x{00C0}-\\x{024F}]', '', 'g')) / length(text), 9) AS ratio,
  trim(regexp_replace(text, '[\\x{0590}-\\x{05FF}\\x{0C00}-\\x{0C7F}]+', '', 'g')) = trim(text) AS no_rogue FROM documents""",
)
def script_ratio(spark, d):
    t = table(spark, d, "documents")
    ratio = F.length(F.regexp_replace("text", r"[^À-ɏ]", "")) / F.length("text")
    return t.select("doc_id", F.round(ratio, 9).alias("ratio"), (F.trim(F.regexp_replace("text", X.ROGUE_SCRIPTS, "")) == F.trim("text")).alias("no_rogue"))


@query(
    "source_priority",
    """SELECT doc_id, source, lang, bucket, text_chars FROM (SELECT doc_id, source, lang, n_chars // 500 AS bucket, length(text) AS text_chars,
  row_number() OVER (PARTITION BY lang, n_chars // 500 ORDER BY substr(source, 4)::INT, doc_id) AS n FROM documents) WHERE n = 1""",
)
def source_priority(spark, d):
    t = table(spark, d, "documents").select("doc_id", "source", "lang", F.floor(F.col("n_chars") / 500).alias("bucket"), F.length("text").alias("text_chars"))
    t = t.withColumn("prio", F.struct(F.substring("source", 4, 9).cast("int").alias("p"), "doc_id"))
    return D.best_source(t, ["lang", "bucket"]).drop("prio")


@query("whitespace_collapse", "SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS h FROM documents")
def whitespace_collapse(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(X.collapse(F.col("text"))).alias("h"))


@query(
    "dehyphenate",
    "SELECT doc_id, md5(regexp_replace(replace(text, '. ', '-' || chr(10)), '([A-Za-z\\x{00C0}-\\x{024F}\\x{1E00}-\\x{1EFF}]+)-\\n\\s*([A-Za-z\\x{00C0}-\\x{024F}\\x{1E00}-\\x{1EFF}]+)', '\\1\\2', 'g')) AS h FROM documents",
)
def dehyphenate(spark, d):
    broken = F.replace(F.col("text"), F.lit(". "), F.lit("-\n"))
    return table(spark, d, "documents").select("doc_id", F.md5(X.dehyphenate(broken)).alias("h"))


@query(
    "list_lines",
    f"""SELECT doc_id, count(*) AS items FROM {_LINES} WHERE regexp_matches(text, '^(\\d+[.)]|[a-zA-Z][.)]|[-*•])\\s+') GROUP BY doc_id""",
)
def list_lines(spark, d):
    return lines(spark, d).where(X.is_list_item(F.col("text"))).groupBy("doc_id").agg(F.count("*").alias("items"))


@query(
    "token_keys",
    "SELECT p_partkey, lower(regexp_replace(p_name, '[^a-zA-Z0-9]', '', 'g')) AS name_key, lower(regexp_replace(p_type, '[^a-zA-Z0-9]', '', 'g')) AS type_key FROM part",
)
def token_keys(spark, d):
    return table(spark, d, "part").select("p_partkey", X.token_key(F.col("p_name")).alias("name_key"), X.token_key(F.col("p_type")).alias("type_key"))


@query(
    "digit_scripts",
    """SELECT o_orderkey, translate(o_orderkey::VARCHAR, '0123456789', '०१२३४५६७८९') AS deva, o_orderkey AS back FROM orders""",
)
def digit_scripts(spark, d):
    x = table(spark, d, "orders").select("o_orderkey", X.to_devanagari_digits(F.col("o_orderkey").cast("string")).alias("deva"))
    return x.withColumn("back", X.multiscript_number(F.concat(F.lit("[ "), "deva", F.lit(" ]"))))


_ROMAN_SQL = """array_to_string([repeat('m', n // 1000)] || [(['', 'c', 'cc', 'ccc', 'cd', 'd', 'dc', 'dcc', 'dccc', 'cm'])[n // 100 % 10 + 1]] ||
  [(['', 'x', 'xx', 'xxx', 'xl', 'l', 'lx', 'lxx', 'lxxx', 'xc'])[n // 10 % 10 + 1]] || [(['', 'i', 'ii', 'iii', 'iv', 'v', 'vi', 'vii', 'viii', 'ix'])[n % 10 + 1]], '')"""


@query("roman_numerals", f"SELECT n, {_ROMAN_SQL} AS roman, n AS value FROM (SELECT DISTINCT (p_partkey % 3999 + 1)::INT AS n FROM part)")
def roman_numerals(spark, d):
    x = table(spark, d, "part").select((F.col("p_partkey") % 3999 + 1).cast("int").alias("n")).distinct()
    return x.withColumn("roman", X.to_roman(F.col("n"))).withColumn("value", X.from_roman(F.col("roman")))


@query(
    "format_sizes",
    """SELECT doc_id, CASE WHEN n_chars < 1024 THEN n_chars || ' B' WHEN n_chars < 1048576 THEN printf('%.1f KB', n_chars / 1024.0)
  ELSE regexp_replace(printf('%.2f', n_chars / 1048576.0), '0$', '') || ' MB' END AS size FROM documents""",
)
def format_sizes(spark, d):
    return table(spark, d, "documents").select("doc_id", X.format_size(F.col("n_chars")).alias("size"))


@query(
    "url_templates",
    "SELECT page_id, 'https://iiif.example/' || page_id || '/p' || lpad(page_id::VARCHAR, greatest(4, length(page_id::VARCHAR))::INT, '0') || '.jpg' AS url FROM pages",
)
def url_templates(spark, d):
    return table(spark, d, "pages").select("page_id", X.expand_url(F.lit("https://iiif.example/{page}/p{p:04d}.jpg"), F.col("page_id")).alias("url"))


@query(
    "typst_escape",
    r"""SELECT item_id, md5(regexp_replace(text || ' #1 $2 *_`<@>[~]\', '([\\#$*_`<>@\[\]~])', '\\\1', 'g')) AS h FROM benchmark""",
)
def typst_escape(spark, d):
    return table(spark, d, "benchmark").select("item_id", F.md5(X.escape_typst(F.concat("text", F.lit(" #1 $2 *_`<@>[~]\\")))).alias("h"))


@query(
    "html_blocks",
    r"""WITH t AS (SELECT page_id, regexp_extract_all(html, '(?is)<(h[1-6])(?:\s[^>]*)?>(.*?)</h', 1) AS ty, regexp_extract_all(html, '(?is)<(h[1-6])(?:\s[^>]*)?>(.*?)</h', 2) AS tx FROM pages)
SELECT page_id, lower(ty[i]) AS type, trim(regexp_replace(regexp_replace(tx[i], '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM (SELECT *, unnest(range(1, len(ty) + 1)) AS i FROM t)""",
)
def html_headings(spark, d):
    return D.html_blocks(table(spark, d, "pages"), "page_id", "html").where(F.col("type").startswith("h")).select("page_id", "type", "text")


@query(
    "html_block_counts",
    r"""WITH t AS (SELECT page_id, regexp_extract_all(html, '(?is)<(h[1-6]|p|li)(\s[^>]*)?>', 1) AS kinds, regexp_split_to_array(html, '(?is)<(?:h[1-6]|p|li)(?:\s[^>]*)?>')[2:] AS parts FROM pages),
e AS (SELECT page_id, lower(unnest(kinds)) AS type, unnest(parts) AS part FROM t),
b AS (SELECT page_id, type, trim(regexp_replace(regexp_replace(regexp_split_to_array(part, '(?i)</?(?:h[1-6]|p|li)\b')[1], '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM e)
SELECT page_id, type, count(*) AS n, sum(length(text))::BIGINT AS chars FROM b WHERE text <> '' GROUP BY page_id, type""",
)
def html_block_counts(spark, d):
    return D.html_blocks(table(spark, d, "pages"), "page_id", "html").groupBy("page_id", "type").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


def _markdown_sql(text: str) -> str:
    for pattern, to in X.MARKDOWN:
        text = f"regexp_replace({text}, '{pattern.replace('(?dm)', '(?m)')}', '{to.replace('$', chr(92))}', 'g')"
    return text


@query("markdown_strip", f"SELECT conv_id, turn, md5({_markdown_sql("'# ' || role || chr(10) || '**' || text || '**'")}) AS h FROM conversations")
def markdown_strip(spark, d):
    t = table(spark, d, "conversations")
    return t.select("conv_id", "turn", F.md5(X.clean_markdown(F.concat(F.lit("# "), "role", F.lit("\n**"), "text", F.lit("**")))).alias("h"))


@query(
    "folio_filter",
    f"""WITH b AS (SELECT doc_id, idx, trim(text) AS text, count(*) OVER (PARTITION BY doc_id) AS n FROM (
  SELECT doc_id, idx, CASE WHEN (doc_id + idx) % 3 = 0 THEN '- ' || (doc_id % 900 + idx) || ' -' ELSE text END AS text FROM {_LINES})),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, text ORDER BY idx) AS r FROM b WHERE text <> ''),
f AS (SELECT *, regexp_matches(text, '^[-–—\\[(]?\\s*\\d{{1,4}}\\s*[-–—\\])]?$') AND (idx <= 1 OR idx >= greatest(0, n - 2)) AS folio FROM k WHERE r <= 3)
SELECT doc_id, count(*) FILTER (NOT folio) AS kept, arg_min(regexp_extract(text, '\\d{{1,4}}'), idx) FILTER (folio) AS printed_page FROM f GROUP BY doc_id
HAVING count(*) FILTER (NOT folio) > 0""",
)
def folio_filter(spark, d):
    t = F.when((F.col("doc_id") + F.col("idx")) % 3 == 0, F.concat(F.lit("- "), (F.col("doc_id") % 900 + F.col("idx")).cast("string"), F.lit(" -"))).otherwise(F.col("text"))
    b = lines(spark, d).select(F.lit("all").alias("job"), F.col("doc_id").alias("page"), "idx", F.lit("p").alias("type"), t.alias("text"))
    c = C.clean_page_artifacts(b)
    return c.groupBy(F.col("page").alias("doc_id")).agg(F.count("*").alias("kept"), F.max("printed_page").alias("printed_page"))


@query("transliteration")
def transliteration(spark, d):
    from quiremill.functions.similarity import to_devanagari, to_iast

    x = table(spark, d, "benchmark").select("item_id", F.translate(F.lower("text"), "äöüßéèêçñáíóúàùœæîôû'’.,;", "aouseeecnaiouauooiou ").alias("latin"))
    x = x.withColumn("deva", to_devanagari(F.regexp_replace("latin", "[^ khgncjtdpbmyrlvsaiueo]", "")))
    return x.withColumn("iast", to_iast(F.col("deva")))
