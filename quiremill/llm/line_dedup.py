"""Line dedup: overlapping windows of three lines, found again anywhere in the corpus.

Lines that hold more than blanks are numbered within their document; each run of three such lines
is hashed to 128 bits.  The first occurrence of a window, by (doc_id, place), covers nothing; every later
one marks its lines as covered, and the union of covered lines is cut from the text.  A line is
only cut if an equal line stays earlier in the corpus: cuts always point to an earlier window.
Windows overlap, so a line of a first occurrence is cut too where a later window covers it: of
five equal lines in a row one stays.

Only window hashes and places are shuffled by window; texts are shuffled once, by document.  The
first place of a window is a partial aggregate, so a window in a third of all documents costs a
row per task; the join that finds its later occurrences can be split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.llm.common import hash128, others, quoted, table

_BLANKS = " \t\r"


def _key(line: Column) -> Column:
    return F.trim(line, F.lit(_BLANKS))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once a row.

    Through a generator, below which nothing is pushed or merged: the optimizer would else put
    their expressions into filters, and into lambdas, where they would run again for every line.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _windows(docs: DataFrame, window: int) -> DataFrame:
    keys = F.filter(F.transform(F.split("text", "\n"), _key), lambda k: k != "")
    base = _once(docs.where("text is not null").select("d", "t", "text"), k=keys).where(F.size("k") >= window)

    def of(i: Column) -> Column:
        a, b = hash128(*[F.get("k", i + j) for j in range(window)])
        return F.struct(a.alias("a"), b.alias("b"))

    starts = F.sequence(F.lit(0), F.size("k") - window)
    return base.select("d", "t", F.posexplode(F.transform(starts, of)).alias("i", "w")).select("d", "t", "i", "w.a", "w.b")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 3) -> DataFrame:
    """``docs`` with later occurrences of repeated windows cut from ``text_col``.

    Adds ``n_lines`` (lines before), ``n_removed`` (lines cut); replaces any such columns.  Lines
    are what newlines separate; leading and trailing blanks, tabs and carriage returns don't count
    in comparisons; blank lines are never cut and don't part a window.  Documents with fewer than
    ``window`` such lines stay as they are; null texts stay null with 0 lines; an empty text has
    one line.  Rows equal in id and text are one document and get equal results; a null id comes
    before all others; equal ids with different texts are ordered by a hash of the text.  Empty
    tables give empty results; further columns are kept.
    """
    rest = others(docs, id_col, text_col, "n_lines", "n_removed")
    src = docs.select(F.col(id_col).alias("d"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"), F.struct(F.lit(1).alias("_"), *map(quoted, rest)).alias("rest"))
    wins = _windows(src, window)
    place = F.struct("d", "t", "i")
    again = wins.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("a", "b", "first")
    later = wins.join(again, ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    cover = later.groupBy(F.col("d").alias("cd"), F.col("t").alias("ct")).agg(F.collect_set("i").alias("at"))
    both = src.join(cover, src.d.eqNullSafe(cover.cd) & (src.t == cover.ct), "left")
    lines = _once(both, ls=F.split("text", "\n"))
    # places of lines that hold something: a window's place counts these
    lines = _once(lines, full=F.expr("filter(sequence(0, size(ls) - 1), j -> trim(BOTH ' \t\r' FROM ls[j]) <> '')"))
    cut = F.array_distinct(F.flatten(F.transform("at", lambda i: F.slice("full", i + 1, window))))
    lines = _once(lines, stay=F.when(F.col("at").isNotNull(), F.array_except(F.expr("sequence(0, size(ls) - 1)"), cut)))
    text = F.when(F.col("at").isNull(), F.col("text")).otherwise(F.array_join(F.transform("stay", lambda j: F.get("ls", j)), "\n"))
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size("ls"))
    out = {id_col: F.col("d"), text_col: text, **{c: F.col("rest").getField(c) for c in rest}}
    order = [c for c in docs.columns if c in out]
    row = F.struct(
        *[out[c].alias(c) for c in order],
        count.cast("long").alias("n_lines"),
        F.when(F.col("at").isNull(), 0).otherwise(F.size("ls") - F.size("stay")).cast("long").alias("n_removed"),
    )
    return lines.select(F.inline(F.array(row)))  # as in _once: a later filter stays above


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


SQL = r"""
WITH l AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents
), nb AS (
  SELECT doc_id, j, k, row_number() OVER (PARTITION BY doc_id ORDER BY j) AS i FROM (
    SELECT doc_id, j, trim(ls[j], ' ' || chr(9) || chr(13)) AS k
    FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS j FROM l)
  ) WHERE k <> ''
), w AS (
  SELECT doc_id, i, k || chr(10) || lead(k, 1) OVER p || chr(10) || lead(k, 2) OVER p AS w
  FROM nb WINDOW p AS (PARTITION BY doc_id ORDER BY i)
), r AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM w WHERE w IS NOT NULL
), cut AS (
  SELECT DISTINCT r.doc_id, nb.j FROM r JOIN nb ON nb.doc_id = r.doc_id AND nb.i BETWEEN r.i AND r.i + 2 WHERE r.n > 1
), stay AS (
  SELECT a.doc_id, string_agg(a.ls[a.j], chr(10) ORDER BY a.j) AS text, count(*) AS n
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS j FROM l) a
  LEFT JOIN cut ON cut.doc_id = a.doc_id AND cut.j = a.j WHERE cut.j IS NULL GROUP BY a.doc_id
)
SELECT l.doc_id, coalesce(len(ls), 0) AS n_lines, CASE WHEN l.text IS NULL THEN 0 ELSE len(ls) - coalesce(stay.n, 0) END AS n_removed,
  CASE WHEN l.text IS NOT NULL THEN md5(coalesce(stay.text, '')) END AS text_md5
FROM l LEFT JOIN stay ON stay.doc_id = l.doc_id
"""
