"""Source divergence audit: which sources of a language write differently, and by which terms.

Two passes over the texts.  The first finds exact document frequencies: a task counts the
distinct terms of its documents by language and gives one row per language and term, which are
summed.  The terms of enough documents are the vocabulary of their language.  The second pass counts
occurrences with an Aho-Corasick automaton per language (``pyahocorasick``) over the kept terms, each
padded with a delimiter on both sides; in a text whose separators are all turned into that delimiter,
the automaton finds whole terms only.  Again a task gives one row per group and term: sparse postings.

The vocabulary is broadcast in parts of at most ``part_terms`` terms and ``part_bytes`` bytes, counted
before; more parts are more passes, never another result.

Distances of pairs come from the postings by tiles: sources of a language are dealt over tiles,
its terms over blocks, and a group of two tiles and a block is one small dense matrix.  Terms that
no source of the tiles has don't enter; they all differ by the same amount, which is multiplied out
at the end.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quiremill.llm.common import ASCII_LOWER, ASCII_UPPER, forget, split_hint, staged, table
from quiremill.llm.texthash import column_bytes, release

#: Bytes of terms stay, A-Z as a-z; all other ASCII bytes become the delimiter.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_PIECE = 4 << 20
_ENTRIES = 400_000
_BUILT: dict = {}


def pieces(text: bytes, size: int = _PIECE) -> Iterator[bytes]:
    """``text`` with plain bytes only, cut at delimiters into pieces of about ``size`` bytes."""
    plain = text.translate(_PLAIN)
    lo = 0
    while len(plain) - lo > size:
        cut = plain.find(b" ", lo + size)
        if cut < 0:
            break
        yield plain[lo:cut]
        lo = cut
    yield plain[lo:] if lo else plain


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[str, str, bytes]]:
    data, off = column_bytes(batch.column("text"))
    for i, (lang, source) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())):
        yield lang, source, data[off[i] : off[i + 1]].tobytes()


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, terms in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms), pa.string()), pa.array(list(terms), pa.binary()).cast(pa.string()), pa.array(list(terms.values()), pa.int64())], ["lang", "term", "n"])
        seen.clear()

    for batch in batches:
        for lang, _, text in _rows(batch):
            distinct: set[bytes] = set()
            for piece in pieces(text):
                distinct.update(piece.split())
            if distinct:
                seen.setdefault(lang, Counter()).update(distinct)
            if sum(map(len, seen.values())) > _ENTRIES:
                yield from flush()
    yield from flush()
    release()


def _automata(key: str, terms: dict[str, list[bytes]]) -> dict[str, ahocorasick.Automaton]:
    """An automaton per language; a worker keeps those of the last vocabulary."""
    if key not in _BUILT:
        _BUILT.clear()
        built = {}
        for lang, own in terms.items():
            a = built[lang] = ahocorasick.Automaton()
            for i, t in enumerate(own):
                a.add_word(f" {t.decode('latin-1')} ", i)
            a.make_automaton()
        _BUILT[key] = built
    return _BUILT[key]


def _occurrences(vocabulary, key: str):
    """Rows (lang, source, term, n): occurrences in the batches of a task; a row without a term for every group."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = vocabulary.value
        automata = _automata(key, terms)
        found: dict[tuple[str, str], Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), n in found.items():
                own = [terms[lang][i] for i in n]
                text = pa.concat_arrays([pa.array(own, pa.binary()).cast(pa.string()), pa.nulls(1, pa.string())])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(text), pa.string()), pa.array([source] * len(text), pa.string()), text, pa.array([*n.values(), 0], pa.int64())], ["lang", "source", "term", "n"])
            found.clear()

        entries = 0
        for batch in batches:
            for lang, source, text in _rows(batch):
                n = found.setdefault((lang, source), Counter())
                if automaton := automata.get(lang):
                    had = len(n)
                    for piece in pieces(text):
                        n.update(map(itemgetter(1), automaton.iter(f" {piece.decode('latin-1')} ")))
                    entries += len(n) - had
                if entries > _ENTRIES:
                    yield from flush()
                    entries = 0
        yield from flush()
        release()

    return count


def _postings(src: DataFrame, kept: DataFrame, part_terms: int, part_bytes: int) -> DataFrame:
    """Staged rows (lang, source, term, n): kept terms that occur in a group, and a null term for every group."""
    spark = src.sparkSession
    many, size = kept.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    parts = max(1, -(-many // part_terms), -(-size // part_bytes))
    out = []
    for part in range(parts):
        own: dict[str, list[bytes]] = {}
        for r in kept.where(F.pmod(F.xxhash64("lang", "term"), F.lit(parts)) == part).collect():
            own.setdefault(r.lang, []).append(r.term.encode())
        vocabulary = spark.sparkContext.broadcast(own)
        rows = src.mapInArrow(_occurrences(vocabulary, uuid.uuid4().hex), "lang string, source string, term string, n long")
        out.append(staged(rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")), "postings"))
        vocabulary.destroy()
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    if parts > 1:
        whole = staged(whole.groupBy("lang", "source", "term").agg(F.max("n").alias("n")), "postings")
        forget(spark, *out)
    return whole


def _share(count: str, total: str, terms: str, prior: int, scale: int) -> Column:
    """1 + floor(scale * (count + prior) / (total + prior * terms)), exact; null where nothing is counted over no terms."""
    d = "decimal(19,0)"
    over = f"nullif(cast({total} as {d}) + cast({prior} * {terms} as {d}), 0)"
    return F.expr(f"1 + cast({scale} as decimal(10,0)) * cast({count} + {prior} as {d}) div {over}")


_TILE = "lang string, a string, b string, s long, m long, d long"


def _tile(key: tuple, rows: pa.Table) -> pa.Table:
    """Sums of differences over the terms of a block, for the pairs of sources of two tiles (a before b)."""
    i, j = key[1].as_py(), key[2].as_py()
    mark = np.asarray(rows.column("term").is_null())
    names, tile, p = np.array(rows.column("source").to_pylist(), object), rows.column("t").to_numpy(), rows.column("p").to_numpy()
    of = {(t, s): k for k, (t, s) in enumerate(zip(tile[mark], names[mark]))}
    order, tiles, base = list(of), tile[mark], p[mark]
    terms = rows.column("term").combine_chunks().dictionary_encode()
    codes = terms.indices.to_numpy(zero_copy_only=False)[~mark].astype(int) if not mark.all() else np.empty(0, int)
    dense = np.repeat(base[:, None], len(terms.dictionary), 1)
    if len(codes):
        at = np.fromiter((of[x] for x in zip(tile[~mark], names[~mark])), int, len(codes))
        dense[at, codes] = p[~mark]
    a, b, s, d = [], [], [], []
    for x in np.flatnonzero(tiles == i):
        other = np.flatnonzero(tiles == j)
        other = other[other > x] if i == j else other
        if not len(other):
            continue
        s.extend(np.abs(dense[other] - dense[x]).sum(1).tolist())
        d.extend(np.abs(base[other] - base[x]).tolist())
        a.extend([order[x][1]] * len(other))
        b.extend(order[y][1] for y in other)
    lang = pa.array([key[0].as_py()] * len(a), pa.string())
    return pa.Table.from_arrays([lang, pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(s, pa.int64()), pa.array([dense.shape[1]] * len(a), pa.int64()), pa.array(d, pa.int64())], ["lang", "a", "b", "s", "m", "d"])


def source_divergence(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 30, prior: int = 5, scale: int = 10**9,
    top: int = 50, part_terms: int = 400_000, part_bytes: int = 8 << 20, tile_sources: int = 256, block_terms: int = 512,
) -> DataFrame:
    """(lang, source, part, item, value, rank): distances of each source to the other ones of its language, and its own terms.

    Terms are runs of letters A-Z and of characters beyond ASCII, A-Z lower-cased.  A null text, language or
    source is read as the empty string; texts without terms count as documents and make their group
    occur.  Every row is a document of its own, so repeated rows count again.  A language without kept
    terms has distances of 0 and no term rows; a source alone in its language has no pairs.  Ties go
    by the UTF-8 bytes of the item.  An empty table gives an empty result; further columns aren't read.
    Texts of any length are counted in pieces.
    """
    spark = docs.sparkSession
    read = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    src = split_hint(docs.select(*read))
    df = src.mapInArrow(_document_frequencies, "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    kept = staged(df.where(F.col("n") >= least_docs).select("lang", "term"), "kept")
    postings = _postings(src, kept, part_terms, part_bytes)

    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    groups = postings.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(sizes, "lang", "left")
    groups = groups.select("lang", "source", "total", F.coalesce("v", F.lit(0).cast("long")).alias("v"))
    groups = staged(groups.withColumn("p0", F.coalesce(_share("0", "total", "v", prior, scale), F.lit(0).cast("long"))), "groups")
    counted = postings.where("term is not null")
    shares = counted.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total", "v", prior, scale))

    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    whole = counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    both = shares.join(whole, ["lang", "term"]).join(langs, "lang")
    both = both.withColumn("value", F.col("p") - _share("lang_n", "lang_total", "v", prior, scale)).where("value > 0")
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    own = both.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value").withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)

    per_lang = groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
    per_lang = per_lang.withColumn("tiles", F.ceil(F.col("n_sources") / tile_sources)).withColumnRenamed("lang", "tl")
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).alias("t")
    blocks = F.greatest(F.ceil(F.col("v") / block_terms), F.lit(1))
    point = shares.select("lang", "source", "term", "p", F.pmod(F.xxhash64("term"), blocks).alias("k"))
    mark = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("k"))
    dealt = point.unionByName(mark).join(per_lang, F.col("lang") == F.col("tl")).select("lang", "source", "term", "p", "k", tile, F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("u"))
    dealt = dealt.select("lang", F.least("t", "u").alias("i"), F.greatest("t", "u").alias("j"), "k", "source", "term", "t", "p")
    sums = dealt.groupBy("lang", "i", "j", "k").applyInArrow(_tile, _TILE)
    pairs = sums.groupBy("lang", "a", "b").agg(F.sum("s").alias("s"), F.sum("m").alias("m"), F.max("d").alias("d")).join(sizes, "lang", "left")
    value = (F.col("s") + (F.coalesce("v", F.lit(0)) - F.col("m")) * F.col("d")).cast("long")
    ways = F.inline(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = pairs.select("lang", value.alias("value"), ways).select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(by))
    return pairs.unionByName(own)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), kept AS (
  SELECT lang, t FROM (SELECT lang, unnest(list_distinct(w)) AS t FROM d) GROUP BY lang, t HAVING count(*) >= 30
), size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
occ AS (
  SELECT lang, source, t, count(*) AS c FROM (SELECT lang, source, unnest(w) AS t FROM d) JOIN kept USING (lang, t) GROUP BY lang, source, t
), g AS (
  SELECT a.lang, a.source, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang, source FROM d) a
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM occ GROUP BY lang, source) b ON a.lang = b.lang AND a.source = b.source
), p AS (
  SELECT g.lang, g.source, kept.t, coalesce(occ.c, 0) AS c, 1 + (1000000000 * (coalesce(occ.c, 0) + 5)) // (g.n + 5 * size.v) AS p
  FROM g JOIN size ON size.lang = g.lang JOIN kept ON kept.lang = g.lang
  LEFT JOIN occ ON occ.lang = g.lang AND occ.source = g.source AND occ.t = kept.t
), q AS (
  SELECT o.lang, o.t, 1 + (1000000000 * (o.c + 5)) // (l.n + 5 * size.v) AS q
  FROM (SELECT lang, t, sum(c) AS c FROM occ GROUP BY lang, t) o
  JOIN (SELECT lang, sum(c) AS n FROM occ GROUP BY lang) l ON l.lang = o.lang JOIN size ON size.lang = o.lang
), f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON b.lang = a.lang AND b.t = a.t AND b.source <> a.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), term AS (
  SELECT p.lang, p.source, 'term' AS part, p.t AS item, p.p - q.q AS value FROM p JOIN q ON q.lang = p.lang AND q.t = p.t WHERE p.c > 0 AND p.p > q.q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
