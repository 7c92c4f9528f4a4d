"""Readers of what stands beside the pages: configurations, IIIF manifests, canonical texts, contents."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiremill.functions import text as X

CONFIG_SCHEMA = (
    "title string, author string, editor string, publisher string, lang string, year string, iiif_manifest string, iiif_template string, "
    "canonical_reference string, threshold double, limit int, use_mistral boolean, use_unpaper boolean, skip_preprocess boolean, heuristics map<string,string>"
)


def job_config(files: DataFrame) -> DataFrame:
    """(job, config...) from (job, prio, json): the first file that parses; ``_raw`` keeps the text."""
    c = files.select("job", "prio", F.col("json").alias("_raw"), F.from_json("json", CONFIG_SCHEMA, {"mode": "PERMISSIVE"}).alias("c"))
    ok = c.where(F.try_parse_json("_raw").isNotNull())
    first = ok.withColumn("_n", F.row_number().over(Window.partitionBy("job").orderBy("prio"))).where("_n = 1")
    return first.select("job", "c.*", "_raw")


#: A string of a JSON text, with the colon behind it if it is a key.
_STRING = r'"(?:[^"\\]|\\.)*"(?:\s*:)?'


def iiif_text(label: Column) -> Column:
    """A IIIF label (variant): a string, a language map, a list of these, or a value object; its first text that isn't empty."""
    plain = F.regexp_replace(F.to_json(label), r'"@language"\s*:\s*"[^"]*",?', "")
    found = F.filter(F.regexp_extract_all(plain, F.lit(_STRING), F.lit(0)), lambda x: ~x.endswith(":") & (x != '""'))
    return F.coalesce(F.get(F.from_json(F.concat(F.lit("["), F.get(found, F.lit(0)), F.lit("]")), "array<string>"), F.lit(0)), F.lit(""))


def _at(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def _first(v: Column, path: str) -> Column:
    """What stands at a path, or its first element if that is a list."""
    return F.coalesce(_at(v, f"{path}[0]", "variant"), _at(v, path, "variant"))


def iiif_pages(manifests: DataFrame) -> DataFrame:
    """Canvases of IIIF manifests (job, json) of version 2 or 3, numbered from 1; what isn't JSON has none."""
    m = manifests.select("job", F.try_parse_json("json").alias("v"))
    three = _at(F.col("v"), "$.items", "array<variant>")
    two = _at(F.col("v"), "$.sequences[0].canvases", "array<variant>")
    is_three = _at(F.col("v"), "$.items", "variant").isNotNull()
    c = m.select("job", is_three.alias("three"), F.posexplode(F.when(is_three, three).otherwise(two)).alias("i", "c"))
    none = F.array().cast("array<variant>")
    notes = F.flatten(F.transform(F.coalesce(_at(F.col("c"), "$.items", "array<variant>"), none), lambda p: F.coalesce(_at(p, "$.items", "array<variant>"), none)))
    c = c.withColumn("body", F.when(F.col("three"), _first(F.get(notes, F.lit(0)), "$.body")).otherwise(_at(F.col("c"), "$.images[0].resource", "variant")))
    c = c.withColumn("service", _first(F.col("body"), "$.service"))
    own = lambda v: _at(v, "$.id")
    old = lambda v: _at(v, '$["@id"]')
    base = F.when(F.col("three"), F.coalesce(own(F.col("service")), old(F.col("service")))).otherwise(old(F.col("service")))
    size = F.when(F.col("three"), "max").otherwise("full")
    url = F.when(base.isNotNull(), F.concat(F.rtrim(base, F.lit("/")), F.lit("/full/"), size, F.lit("/0/default.jpg"))).otherwise(F.when(F.col("three"), own(F.col("body"))).otherwise(old(F.col("body"))))
    n = (F.col("i") + 1).cast("int")
    return c.select(
        "job", n.alias("page_num"), iiif_text(_at(F.col("c"), "$.label", "variant")).alias("label"), F.coalesce(own(F.col("c")), old(F.col("c"))).alias("canvas_id"),
        _at(F.col("c"), "$.width", "int").alias("width"), _at(F.col("c"), "$.height", "int").alias("height"), url.alias("image_url"), F.format_string("page_%04d.jpg", n).alias("filename"),
    )


def iiif_metadata(manifests: DataFrame) -> DataFrame:
    """(job, title, attribution, year) of manifests; the year is the first of 1500 to 2099 in their text."""
    label = F.coalesce(F.get_json_object("json", "$.label.none[0]"), F.get_json_object("json", "$.label.en[0]"), F.get_json_object("json", "$.label[0].@value"), F.get_json_object("json", "$.label"))
    year = F.regexp_extract("json", r"(?<!\d)(1[5-9]\d\d|20\d\d)(?!\d)", 1)
    return manifests.select("job", label.alias("title"), F.coalesce(F.get_json_object("json", "$.attribution"), F.get_json_object("json", "$.requiredStatement.value.en[0]")).alias("attribution"), F.nullif(year, F.lit("")).alias("year"))


def page_urls(pages: DataFrame, urls: DataFrame, template: str | None = None) -> DataFrame:
    """Adds ``iiif_url``: by page number, zero-filled or not, else from the template."""
    u = urls.select("job", F.regexp_replace("page_key", "^0+(?=.)", "").alias("_k"), F.col("image_url").alias("iiif_url")).dropDuplicates(["job", "_k"])
    out = pages.withColumn("_k", F.col("page_num").cast("string")).join(u, ["job", "_k"], "left").drop("_k")
    if template:
        out = out.withColumn("iiif_url", F.coalesce("iiif_url", X.expand_url(F.lit(template), F.col("page_num"))))
    return out


def canonical_entries(texts: DataFrame) -> DataFrame:
    """(job, ord, ref, keys, text, payload) from the four shapes of canonical JSON (job, json): list, {sutras}, {entries}, map.

    Entries keep the order of the JSON text; ``payload`` is the entry as JSON.  A text that isn't JSON is an error.
    """
    j = F.col("json")
    inner = F.from_json(j, "sutras array<string>, entries array<string>")
    listed = F.when(F.ltrim(j).startswith("["), F.from_json(j, "array<string>")).when(F.size(inner["sutras"]) > 0, inner["sutras"]).otherwise(inner["entries"])
    named = F.from_json(j, "map<string,string>")
    as_list = F.transform(listed, lambda e: F.struct(F.lit(None).cast("string").alias("name"), e.alias("e")))
    as_map = F.transform(F.map_entries(named), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("e")))
    valid = F.when(F.try_parse_json(j).isNotNull(), F.coalesce(as_list, as_map)).otherwise(F.raise_error(F.concat(F.lit("no JSON in the canonical text of "), F.col("job").cast("string"))))
    x = texts.where("json is not null").select("job", F.posexplode(valid).alias("ord", "x")).select("job", "ord", "x.name", "x.e")
    plain = F.col("name").isNotNull() & ~F.ltrim("e").startswith("{")
    at = lambda k: F.when(~plain, F.get_json_object("e", f"$.{k}"))
    keys = F.array_distinct(F.array_compact(F.array(F.coalesce(at("ref"), F.col("name")), *[at(k) for k in ("id", "sutra", "code", "dhatu")])))
    filled = lambda k: F.nullif(at(k), F.lit(""))
    text = F.when(plain, F.col("e")).otherwise(F.coalesce(filled("devanagari"), filled("dhatu"), filled("text"), F.lit("")))
    x = x.select("job", "ord", keys.alias("keys"), text.alias("text"), F.when(plain, F.to_json(F.struct(F.col("name").alias("ref"), F.col("e").alias("text")))).otherwise(F.col("e")).alias("payload"))
    return x.select("job", "ord", F.coalesce(F.get("keys", F.lit(0)), F.col("ord").cast("string")).alias("ref"), "keys", "text", "payload")


def canonical_keys(entries: DataFrame) -> DataFrame:
    """(job, key, ord): the last entry that has a key."""
    return entries.select("job", F.explode("keys").alias("key"), "ord").groupBy("job", "key").agg(F.max("ord").alias("ord"))


def decode_codes(rows: DataFrame, maps: dict[str, dict[str, str]]) -> DataFrame:
    """Code columns replaced by the names that small dictionaries give; unknown codes stay."""
    for column, names in maps.items():
        table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
        rows = rows.withColumn(column, F.coalesce(F.element_at(table, F.col(column)), F.col(column)))
    return rows


_TRAIL = re.compile(r"^(?P<title>.*?)(?:\s*\.{2,}\s*|\s+)(?P<page>\d{1,5})$")


def parse_toc(text: str) -> list[tuple[int, str, int]]:
    """(level, title, page) of a table of contents as JSON, or as lines.

    A line ends in its page, after `` | ``, dots or blanks; its level is the number of ``#``, or
    one more than half its indent.  Lines of metadata (``# key: value``) and without page are no
    entries.
    """
    try:
        return [(int(a), str(b), int(c)) for a, b, c in json.loads(re.sub(r",(\s*[\]}])", r"\1", text))]
    except (ValueError, TypeError):
        pass
    out = []
    for line in text.splitlines():
        if not line.strip() or re.match(r"^#\s*\w+\s*:", line):
            continue
        marks = re.match(r"^(#+)\s+", line)
        level = len(marks[1]) if marks else (len(line) - len(line.lstrip(" "))) // 2 + 1
        body = line[marks.end() :].strip() if marks else line.strip()
        head, bar, tail = body.rpartition("|")
        if bar and tail.strip().isdigit():
            out.append((level, head.strip(), int(tail)))
        elif m := _TRAIL.match(body):
            out.append((level, m["title"].rstrip(" ."), int(m["page"])))
    return out


def read_toc(texts: DataFrame) -> DataFrame:
    """(job, ord, level, title, page) from contents (job, text)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(job, i, *e) for job, text in frame.itertuples(index=False) for i, e in enumerate(parse_toc(text or ""), 1)]
            yield pd.DataFrame(rows, columns=["job", "ord", "level", "title", "page"])

    return texts.select("job", "text").mapInPandas(run, "job string, ord int, level int, title string, page int")


def select_pages(pages: DataFrame, spec: str | None = None, limit: int = 0, page: str = "page_num") -> DataFrame:
    """Pages of a list like ``1-50,73``, and the first ``limit`` of each job."""
    if spec:
        ok = F.lit(False)
        for part in spec.split(","):
            lo, _, hi = part.strip().partition("-")
            ok = ok | F.col(page).between(int(lo), int(hi or lo))
        pages = pages.where(ok)
    if limit > 0:
        pages = pages.withColumn("_n", F.row_number().over(Window.partitionBy("job").orderBy(page))).where(F.col("_n") <= limit).drop("_n")
    return pages


def sample_pages(n_pages):
    """Indices of sample pages: first, second, middle, the 25th or last, last."""
    n = n_pages
    return F.array_sort(F.array_distinct(F.filter(F.array(F.lit(0), F.lit(1), F.floor(n / 2).cast("int"), F.least(n - 1, F.lit(24)).cast("int"), (n - 1).cast("int")), lambda i: (i >= 0) & (i < n))))
