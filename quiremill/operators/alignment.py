"""Alignment of OCR text with reference texts.

Exact matches are joins; what depends on a cursor that moves with each match is a prefix scan over
pages (``cursor``).
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiremill.functions import text as X
from quiremill.functions.similarity import corrected, ratio
from quiremill.operators import cursor as C
from quiremill.staging import settled

REFERENCE = r"(\d+)\.(\d+)\.(\d+)"


def reference_key(heading: Column, body: Column) -> Column:
    """The a.b.c that the heading, or the body's first 120 characters, name, without leading zeros."""
    source = F.when(heading.rlike(REFERENCE), heading).otherwise(F.substring(body, 1, 120))
    part = lambda i: F.regexp_extract(source, REFERENCE, i).try_cast("int").cast("string")
    return F.when(source.rlike(REFERENCE), F.concat_ws(".", part(1), part(2), part(3)))


def explicit_references(entries: DataFrame, keys: DataFrame) -> DataFrame:
    """Adds ``ref`` and ``ord`` of entries whose heading, or the body's first 120 characters, name a known a.b.c."""
    e = entries.withColumn("key", reference_key(F.col("heading"), F.col("body")))
    known = keys.select(F.col("job").alias("_job"), F.col("key").alias("_key"), F.col("ord").alias("ord"))
    e = e.join(known, F.expr("job = _job and key = _key"), "left").drop("_job", "_key")
    return e.withColumn("ref", F.when(F.col("ord").isNotNull(), F.col("key"))).drop("key")


def _near_heading(threshold: float):
    """Rows (by, page, idx, at): for the lines of tiles the places whose text is similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = lambda x: (x or "").strip().lower()
        for batch in batches:
            rows: dict[str, list] = {"job": [], "page": [], "idx": [], "at": []}
            for r in batch.to_pylist():
                texts = [plain(t["text"]) for t in r["targets"]]
                bags = C.letters(texts)
                lines = [plain(x["heading"]) for x in r["lines"]]
                for x, line, *bag in zip(r["lines"], lines, *C.letters(lines)):
                    at = [r["targets"][i]["ord"] for i in np.flatnonzero(C.at_most(tuple(bag), bags) + 1e-12 >= threshold) if texts[i] and ratio(line, texts[i]) >= threshold]
                    if at:
                        for k, v in (("job", r["job"]), ("page", x["page"]), ("idx", x["idx"]), ("at", at)):
                            rows[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows["job"], batch.schema.field("job").type), pa.array(rows["page"], pa.int64()), pa.array(rows["idx"], pa.int64()), pa.array(rows["at"], pa.list_(pa.int64()))], list(rows))

    return run


def _parted(rows: DataFrame, targets: DataFrame, by: list[str], small: int):
    """Rows and targets of keys with at most ``small`` of either, and those of larger keys, None if there are none."""
    n = rows.groupBy(*by).agg(F.count("*").alias("_n")).unionByName(targets.groupBy(*by).agg(F.count("*").alias("_n")))
    large = settled(n.where(F.col("_n") > small).select(*[F.col(c).alias(f"_{c}") for c in by]).distinct())
    if large.isEmpty():
        return rows, targets, None, None
    part = lambda df, how: df.join(large, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], how)
    return *(part(df, "left_anti") for df in (rows, targets)), *(part(df, "left_semi") for df in (rows, targets))


def align_canonical(entries: DataFrame, canonical: DataFrame, keys: DataFrame, threshold: float = 0.5, small: int = 20_000) -> DataFrame:
    """(job, page, ref, ord, heading, body) of entries that match, in reading order.

    An explicit reference counts first; else the entry at the cursor, if similar enough.  A match
    puts the cursor behind itself.  ``canonical`` (job, ord, ref, text) has places from 0 without gaps.  An entry
    without a page isn't matched; a job without canonical texts has explicit matches only.

    A job of at most ``small`` entries and texts is one task's loop; in larger ones cursors come from
    a prefix scan over pages, see ``cursor``, and no task holds a job.  The result is the same.
    """
    e = explicit_references(entries, keys).withColumns({"heading": X.clean_lines(F.col("heading")), "body": X.clean_lines(F.col("body"))})
    e = e.withColumns({"page": F.col("page").cast("long"), "idx": F.col("idx").cast("long")}).where("page is not null")
    c = canonical.select("job", F.col("ord").cast("long").alias("ord"), F.col("ref").alias("cref"), "text")
    steps = e.select("job", "page", "idx", F.col("ord").cast("long").alias("ord"), "heading")
    few, texts, many, more = _parted(steps, c, ["job"], small)
    hit = few.groupBy("job").cogroup(texts.withColumnRenamed("job", "_job").groupBy("_job")).applyInPandas(_loop(threshold), f"job {e.schema['job'].dataType.simpleString()}, page long, idx long, hit long")
    if many is not None:
        hit = hit.unionByName(_scanned(many, more, threshold))
    out = e.drop("ord").join(hit, ["job", "page", "idx"]).join(c.select("job", F.col("ord").alias("hit"), "cref"), ["job", "hit"], "left")
    return out.select("job", "page", "entry", F.coalesce("ref", "cref").alias("ref"), F.col("hit").cast("int").alias("ord"), "heading", "body")


def _loop(threshold: float):
    """The greedy loop over the steps of a job, with its texts."""

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        texts, cursor, out = dict(zip(right["ord"], right["text"])), 0, []
        for r in left.sort_values(["page", "idx"]).itertuples():
            at = int(r.ord) if pd.notna(r.ord) else cursor if texts.get(cursor) and ratio(r.heading, texts[cursor]) >= threshold else None
            if at is not None:
                cursor = at + 1
                out.append((*key, r.page, r.idx, at))
        return pd.DataFrame(out, columns=["job", "page", "idx", "hit"])

    return run


def _scanned(steps: DataFrame, canonical: DataFrame, threshold: float) -> DataFrame:
    """What ``_loop`` finds, from a scan over pages."""
    kind = steps.schema["job"].dataType.simpleString()
    loose = steps.where("ord is null and heading <> ''").select("job", "page", "idx", "heading")
    tiles = C.tiles(loose, canonical.where("text <> ''"), ["job"], ["page", "idx", "heading"], ["ord", "text"])
    near = tiles.mapInArrow(_near_heading(threshold), f"job {kind}, page long, idx long, at array<long>")
    near = near.groupBy("job", "page", "idx").agg(F.flatten(F.collect_list("at")).alias("at"))
    explicit = steps.where("ord is not null").select("job", "page", "idx", "ord", F.lit(None).cast("array<long>").alias("at"))
    steps = settled(explicit.unionByName(near.withColumn("ord", F.lit(None).cast("long"))))
    moves = settled(C.page_moves(steps, ["job"], lambda r: C.Move(int(r.ord) + 1) if pd.notna(r.ord) else C.moved_on(r.at)))

    def hits(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        cursor, out = int(rows["start"].iloc[0]), []
        for r in rows.itertuples():
            at = int(r.ord) if pd.notna(r.ord) else cursor if cursor in r.at else None
            if at is not None:
                cursor = at + 1
                out.append((*key, r.idx, at))
        return pd.DataFrame(out, columns=["job", "page", "idx", "hit"])

    begun = C.starts(moves, ["job"]).withColumnRenamed("node", "page")
    return steps.join(begun, ["job", "page"]).groupBy("job", "page").applyInPandas(hits, f"job {kind}, page long, idx long, hit long")


def coverage(matched: DataFrame, canonical: DataFrame) -> DataFrame:
    """(job, total, matched, coverage): distinct references found, in per cent to two places; 0 without references."""
    # one aggregate over both sides: they may come from the same table, which a join would confuse
    none = F.lit(None).cast("string")
    both = canonical.select("job", F.lit(1).alias("one"), none.alias("ref")).union(matched.select("job", F.lit(0), F.col("ref").cast("string")))
    x = both.groupBy("job").agg(F.sum("one").alias("total"), F.count_distinct("ref").alias("matched")).withColumn("matched", F.coalesce("matched", F.lit(0)))
    return x.withColumn("coverage", F.when(F.col("total") == 0, 0.0).otherwise(F.round(100.0 * F.col("matched") / F.col("total"), 2)))


_DEVA = re.compile("[ऀ-ॿ]")


def root_score(line: str, root: str, meaning: str, keep) -> float:
    """Of a line to a root and its meaning: both together, a good meaning, or a good root weighed with the meaning."""
    a = keep(line)
    sim = lambda x: ratio(a, keep(x))
    m, r = sim(meaning), sim(root)
    return max(sim(f"{root} {meaning}"), m if m > 0.65 else 0.0, 0.4 * r + 0.6 * m if r > 0.7 else 0.0)


def _keep_deva(x: str) -> str:
    return "".join(c for c in x if "ऀ" <= c <= "ॿ" and c not in "।॥०१२३४५६७८९")


def _keep_latin(x: str) -> str:
    return re.sub("[^a-z]", "", x.lower())


def _near_roots(least: float):
    """Rows (job, class, page, idx, at, score): for the lines of tiles the roots that score ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in ("job", "class", "page", "idx", "at", "score")}
            for r in batch.to_pylist():
                pool = _Pool(r["targets"])
                for x in r["lines"]:
                    score, most = pool.bounds(x["text"], 0, len(r["targets"]))
                    found = [(r["targets"][i]["ord"], s) for i in np.flatnonzero(most + 1e-12 >= least) if (s := score(i, least)) >= least]
                    if found:
                        for k, v in (("job", r["job"]), ("class", r["class"]), ("page", x["page"]), ("idx", x["idx"]), ("at", [f[0] for f in found]), ("score", [f[1] for f in found])):
                            rows[k].append(v)
            kinds = [batch.schema.field("job").type, batch.schema.field("class").type, pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], list(rows))

    return run


def places(rows: DataFrame, by: list[str], order: str, name: str, width: int = 4096) -> DataFrame:
    """Adds the place from 0 of each row of a key by ``order`` (whole numbers), counted by ranges so that no task sorts a whole key."""
    x = rows.withColumn("__range", F.floor(F.col(order) / width))
    n = x.groupBy(*by, "__range").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n = n.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("__range").alias("range__"), before.alias("__before"))
    x = x.withColumn("__place", F.row_number().over(Window.partitionBy(*by, "__range").orderBy(order)) - 1)
    x = x.join(n, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] + [F.col("__range").eqNullSafe(F.col("range__"))])
    return x.withColumn(name, F.col("__before") + F.col("__place")).drop("__range", "range__", "__place", "__before", *[f"_{c}" for c in by])


class _Pool:
    """Roots (dicts) to compare a line with; bounds of the scores come from letters alone."""

    def __init__(self, pool: list[dict]):
        self.scripts = []
        for keep, root, meaning in ((_keep_latin, "iast_root", "iast_meaning"), (_keep_deva, "root", "meaning")):
            parts = [(t[root] or "", t[meaning] or "") for t in pool]
            texts = ([f"{a} {b}" for a, b in parts], [b for _, b in parts], [a for a, _ in parts])
            self.scripts.append((keep, parts, [C.letters([keep(y).lower() for y in col]) for col in texts]))

    def bounds(self, line: str, lo: int, hi: int):
        """A function that scores place ``lo + i``, and bounds from above of the scores of places from ``lo`` to ``hi``."""
        keep, parts, bags = self.scripts[bool(_DEVA.search(line))]
        bag = tuple(v[0] for v in C.letters([keep(line).lower()]))
        full, m, a = (C.at_most(bag, (n[lo:hi], size[lo:hi])) for n, size in bags)
        own = keep(line)

        def score(i: int, floor: float) -> float:
            """``root_score``, or something below ``floor`` if that is; parts whose bound is below it aren't compared."""
            root, meaning = parts[lo + i]
            s = ratio(own, keep(f"{root} {meaning}")) if full[i] + 1e-12 >= floor else 0.0
            both = a[i] > 0.7 - 1e-12 and 0.4 * a[i] + 0.6 * m[i] + 1e-12 >= max(floor, s)
            if both or (m[i] > 0.65 - 1e-12 and m[i] + 1e-12 >= max(floor, s)):
                of_m = ratio(own, keep(meaning))
                s = max(s, of_m if of_m > 0.65 else 0.0)
                if both and (of_r := ratio(own, keep(root))) > 0.7:
                    s = max(s, 0.4 * of_r + 0.6 * of_m)
            return s

        return score, np.maximum(np.maximum(full, m), 0.4 * a + 0.6 * m)


def _root_loop(back: int, ahead: int, least: float):
    """The greedy loop over the lines of a class, with its roots."""

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        roots = right.sort_values("ord").to_dict("records")
        pool = _Pool(roots)
        taken, out, cursor = set(), [], 0
        for x in left.sort_values(["page", "idx"]).itertuples():
            lo = max(0, cursor - back)
            score, most = pool.bounds(x.text, lo, min(len(roots), cursor + ahead))
            best, at = 0.0, -1
            for i in np.argsort(-most, kind="stable"):
                if most[i] + 1e-12 < max(best, least):
                    break  # no other can score as much
                s = score(i, max(best, least))
                if s > best or (s == best and best > 0 and i < at):
                    best, at = s, int(i)
            if best >= least and best > 0 and lo + at not in taken:
                taken.add(lo + at)
                out.append((*key, x.page, x.idx, lo + at, best))
                cursor = max(cursor, lo + at + 1)
        return pd.DataFrame(out, columns=["job", "class", "page", "idx", "ord", "score"])

    return run


def align_windowed(lines: DataFrame, roots: DataFrame, back: int = 5, ahead: int = 40, least: float = 0.5, small: int = 20_000) -> DataFrame:
    """Greedy match (job, id, page, line, score) of lines (job, page, idx, class, text) to the roots of their class.

    The best root from ``back`` before to ``ahead`` behind the cursor, if scored ``least`` or more
    and not taken; the cursor goes behind it unless it would move back.  A class has its own cursor, as
    classes rise along a job (``structure.running_class``).  Ids of roots are unique in a job; lines without a page aren't matched.

    A class of at most ``small`` lines and roots is one task's loop; larger ones are scanned by pages, see ``cursor``,
    and no task holds a class.  The result is the same.
    """
    by = ["job", "class"]
    r = places(roots.select("job", "ord", "class", "id", "root", "meaning", "iast_root", "iast_meaning"), by, "ord", "place").drop("ord").withColumnRenamed("place", "ord")
    rows = lines.where((F.length("text") >= 3) & ~F.col("text").rlike(r"^[IVXLCDMivxlcdm0-9. ]+$") & F.col("page").isNotNull())
    rows = rows.select("job", F.col("page").cast("long").alias("page"), F.col("idx").cast("long").alias("idx"), "class", "text")
    key = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in by)
    few, pool, many, more = _parted(rows, r, by, small)
    first = few.groupBy(*by).cogroup(pool.withColumnsRenamed({c: f"_{c}" for c in by}).groupBy(*[f"_{c}" for c in by])).applyInPandas(_root_loop(back, ahead, least), f"{key}, page long, idx long, ord long, score double")
    if many is not None:
        first = first.unionByName(_scanned_roots(many, more, back, ahead, least))
    return first.join(rows, [*by, "page", "idx"]).join(r.select(*by, "ord", "id"), [*by, "ord"]).select("job", "id", "page", F.col("text").alias("line"), "score")


def _scanned_roots(rows: DataFrame, r: DataFrame, back: int, ahead: int, least: float) -> DataFrame:
    """What ``_root_loop`` finds, from a scan over pages.

    A taken root has the cursor behind it already, so whether it's taken doesn't change where the cursor goes:
    of the lines that find one root the first has it.
    """
    by = ["job", "class"]
    key = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in by)
    tiles = C.tiles(rows, r, by, ["page", "idx", "text"], ["ord", "root", "meaning", "iast_root", "iast_meaning"])
    near = tiles.mapInArrow(_near_roots(least), f"{key}, page long, idx long, at array<long>, score array<double>")
    near = settled(near.groupBy(*by, "page", "idx").agg(F.flatten(F.collect_list("at")).alias("at"), F.flatten(F.collect_list("score")).alias("score")))
    moves = settled(C.page_moves(near, by, lambda x: C.behind_best(x.at, x.score, back, ahead)))

    def hits(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        cursor, out = int(rows["start"].iloc[0]), []
        for x in rows.itertuples():
            seen = [(-s, a) for a, s in zip(x.at, x.score) if cursor - back <= a < cursor + ahead]
            if seen:
                s, a = min(seen)
                cursor = max(cursor, a + 1)
                out.append((*key, x.idx, a, -s))
        return pd.DataFrame(out, columns=["job", "class", "page", "idx", "ord", "score"])

    begun = C.starts(moves, by).withColumnRenamed("node", "page")
    hit = near.join(begun, [*by, "page"]).groupBy(*by, "page").applyInPandas(hits, f"{key}, page long, idx long, ord long, score double")
    first = hit.groupBy(*by, "ord").agg(F.min(F.struct("page", "idx", "score")).alias("f"))
    return first.select(*by, "f.page", "f.idx", "ord", "f.score")


def fill_unmatched(roots: DataFrame, matched: DataFrame, first_page: int = 27) -> DataFrame:
    """All roots in order: those without match get the last known page, confidence 1 and ``interpolated``."""
    x = roots.join(matched.select("job", "id", F.col("page").alias("_page"), F.col("line").alias("ocr_line"), F.col("score").alias("_score")), ["job", "id"], "left")
    w = Window.partitionBy("job").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    page = F.coalesce(F.last("_page", ignorenulls=True).over(w), F.lit(first_page))
    none = F.col("_score").isNull()
    return x.withColumns({"page": page, "interpolated": none, "match_confidence": F.when(none, 1.0).otherwise(F.round("_score", 3)), "ocr_line": F.coalesce("ocr_line", F.lit(""))}).drop("_page", "_score")


_EDGES = re.compile(r"^\W+|\W+$")
_REPEAT = re.compile(r"(\S)\1\1")


def _noise(w: str) -> bool:
    mixed = len(w) <= 4 and _DEVA.search(w) and any(c in "0123456789" for c in w)
    return not w or bool(_REPEAT.search(w)) or ".." in w or not any(c.isalpha() for c in w) or bool(mixed)


_RULE = re.compile(r"[.\-_+=,;:~*^]+")
_LEADER = re.compile(r"([^.\s]+?)\.{2,}(.*)")
_FOLIO = re.compile(r"(?i)[0-9ivxlcdm]+")
#: A token less similar than this to every word of the page is nothing of the page.
_ALIEN = 0.6


class _Words:
    """The words of a page's better text, and how tokens compare with them."""

    def __init__(self, text: str, least: float):
        self.words, self.least = text.split(), least
        self.lower = [w.lower() for w in self.words]

    @staticmethod
    def likeness(a: str, b: str) -> float:
        return difflib.SequenceMatcher(None, a.lower(), b.lower()).ratio()

    def nearest(self, token: str) -> tuple[float, str]:
        """The largest likeness to a word, and the first word that has it."""
        ratios = [self.likeness(token, w) for w in self.lower]
        top = max(ratios, default=0.0)
        return top, self.words[ratios.index(top)] if ratios else ""

    def strays(self, tokens: list[str]) -> dict[str, str]:
        """Deletions of the tokens that are nothing of the page."""
        return {t: "" for t in tokens if self.nearest(t)[0] < _ALIEN}

    def by_itself(self, token: str) -> dict[str, str]:
        """What a token shows without its neighbours: a dotted leader is its word and folio, noise is deleted."""
        if leader := _LEADER.fullmatch(token):
            ratio, word = self.nearest(leader[1])
            parts = [word if ratio >= _ALIEN else "", leader[2] if _FOLIO.fullmatch(leader[2]) else ""]
            return {token: " ".join(filter(None, parts))}
        return self.strays([token]) if _noise(token) else {}

    def one_for_one(self, old: list[str], new: list[str]) -> dict[str, str]:
        """A word read wrongly; the token without its punctuation is corrected too."""
        pairs = {(_EDGES.sub("", old[0]), _EDGES.sub("", new[0])), (old[0], new[0])}
        a, b = _EDGES.sub("", old[0]), _EDGES.sub("", new[0])
        if min(len(a), len(b)) <= 2:  # too short to be similar: only another case
            return {old[0]: new[0]} if a != b and a.lower() == b.lower() else {}
        alike = self.likeness(a, b) if a != b else self.likeness(old[0], new[0])
        return {x: y for x, y in pairs if x != y} if alike >= self.least else {}

    def more_for_fewer(self, old: list[str], new: list[str]) -> dict[str, str]:
        """Extra tokens: each word takes the token most like it, and strays among the others go."""
        table = np.array([[self.likeness(_EDGES.sub("", t), _EDGES.sub("", w)) for t in old] for w in new])
        table[table < max(self.least, 1e-9)] = -1
        out, left = {}, set(range(len(old)))
        for ratios, w in zip(table, new, strict=True):
            ratios[[i for i in range(len(old)) if i not in left]] = -1
            if not _RULE.fullmatch(w) and ratios.max() > 0:
                left.remove(int(ratios.argmax()))
                out[old[int(ratios.argmax())]] = w
        return out | self.strays([old[i] for i in sorted(left)])

    def one_for_more(self, old: list[str], new: list[str]) -> dict[str, str]:
        """Words run together."""
        a, phrase = _EDGES.sub("", old[0]), " ".join(new)
        return {a: phrase} if a.lower() == _EDGES.sub("", phrase).replace(" ", "").lower() else {}


def align_tokens(tokens: list[str], text: str, least: float = 0.5) -> dict[str, str]:
    """Corrections of a page's OCR tokens by its better text; an empty string deletes a token.

    Dotted leaders and noise are settled token by token.  The stretches in which both sequences
    differ are settled by a rule for their shape; later rules replace earlier corrections.
    """
    page = _Words(text, least)
    out: dict[str, str] = {}
    for t in tokens:
        out |= page.by_itself(t)
    for tag, i1, i2, j1, j2 in difflib.SequenceMatcher(None, [t.lower() for t in tokens], page.lower).get_opcodes():
        old, new = tokens[i1:i2], page.words[j1:j2]
        match tag, len(old), len(new):
            case "delete", _, _:
                out |= page.strays(old)
            case "replace", 1, 1:
                out |= page.one_for_one(old, new)
            case "replace", n, m if n > m:
                out |= page.more_for_fewer(old, new)
            case "replace", 1, _:
                out |= page.one_for_more(old, new)
    return out


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def token_corrections(tokens: pd.Series, text: pd.Series) -> pd.Series:
    return pd.Series([align_tokens(list(t), x or "") if t is not None else {} for t, x in zip(tokens, text, strict=True)])


def correct_words(words: DataFrame, corrections: DataFrame) -> DataFrame:
    """Words with corrections (scope id, index or replace; key; value): by id, else index, else text.

    The first that changes the word counts; of several values of a key the one of largest ``written``,
    if there is such a column, else the one that sorts last.
    """
    last = F.max(F.struct("written", "value"))["value"] if "written" in corrections.columns else F.max("value")
    c = corrections.groupBy("scope", "key").agg(last.alias("value"))
    out = words
    for scope, key in (("id", F.col("id")), ("index", F.col("idx").cast("string")), ("replace", F.col("text"))):
        side = c.where(F.col("scope") == scope).select(F.col("key").alias(f"_k_{scope}"), F.col("value").alias(f"_v_{scope}"))
        out = out.join(side, key == F.col(f"_k_{scope}"), "left")
    pick = F.coalesce(*[F.when(F.col(f"_v_{s}") != F.col("text"), F.col(f"_v_{s}")) for s in ("id", "index", "replace")])
    return out.select(*[F.col(x) for x in words.columns if x != "text"], F.coalesce(pick, F.col("text")).alias("text"), pick.isNotNull().alias("corrected"))


def apply_corrections(tokens: DataFrame, mapping: str = "mapping", text: str = "text") -> DataFrame:
    """Tokens with their page's mapping applied: ``text`` and ``hits``."""
    return tokens.withColumn("_c", corrected(F.col(text), F.col(mapping))).withColumns({text: F.col("_c.text"), "hits": F.col("_c.hits")}).drop("_c")


def zip_lines(pages: DataFrame, columns: list[str]) -> DataFrame:
    """Line arrays side by side: (job, page, line, columns...), shorter ones filled with empty lines."""
    z = pages.select("job", "page", F.posexplode(F.arrays_zip(*columns)).alias("line", "z"))
    return z.select("job", "page", "line", *[F.coalesce(F.col(f"z.{c}"), F.lit("")).alias(c) for c in columns])
