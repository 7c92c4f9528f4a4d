"""Sequential matching with a moving cursor, as a parallel prefix scan.

A greedy aligner goes through its lines with a cursor into a list, and each match moves the cursor.  What a
line does is a function from cursor to cursor, equal to the identity but at the few places near a text
that it's similar to.  Functions of lines compose to functions of pages, those of pages to functions of
groups of pages, by levels, until one group holds the job; then the cursor at the beginning, 0,
goes down the levels and tells each page where it starts.  With its start every page is
matched by itself.

A function is ``const`` (whatever the cursor was), or the identity but at ``xs``, where it is ``ys``.  No task holds a
job: the similarities are computed by tiles of pages and of the list, functions by page, levels by ``FAN`` nodes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiremill.staging import settled

FAN = 64
_NONE = np.empty(0, np.int64)


@dataclass
class Move:
    """A function from cursor to cursor."""

    const: int | None = None
    xs: np.ndarray = field(default_factory=lambda: _NONE)
    ys: np.ndarray = field(default_factory=lambda: _NONE)

    def __call__(self, c: int) -> int:
        return int(self.many(np.array([c]))[0])

    def many(self, c: np.ndarray) -> np.ndarray:
        if self.const is not None:
            return np.full(len(c), self.const, np.int64)
        if not len(self.xs):
            return c
        at = np.minimum(np.searchsorted(self.xs, c), len(self.xs) - 1)
        return np.where(self.xs[at] == c, self.ys[at], c)

    def then(self, after: Move) -> Move:
        if after.const is not None or (after.const is None and self.const is not None):
            return Move(after.const if after.const is not None else after(self.const))
        if not len(after.xs):
            return self
        xs = np.union1d(self.xs, after.xs)
        ys = after.many(self.many(xs))
        return Move(None, xs[ys != xs], ys[ys != xs])


def moved_on(at: np.ndarray) -> Move:
    """One place on where the cursor stands at one of the places ``at``."""
    xs = np.unique(np.asarray(at, np.int64))
    return Move(None, xs, xs + 1)


def best_in_window(at: np.ndarray, score: np.ndarray, back: int, ahead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every cursor with one of the places ``at`` in its window [cursor - back, cursor + ahead): cursors, the best place, its score.

    Of equal scores the first place counts.
    """
    order = np.lexsort((at, -score))
    cursors, places, scores, seen = [], [], [], _NONE
    for i in order:  # from the best on: a cursor takes the first that it sees
        own = np.setdiff1d(np.arange(max(at[i] - ahead + 1, 0), at[i] + back + 1), seen, assume_unique=True)
        if len(own):
            cursors.append(own)
            places.append(np.full(len(own), at[i]))
            scores.append(np.full(len(own), score[i]))
            seen = np.union1d(seen, own)
    if not cursors:
        return _NONE, _NONE, np.empty(0)
    c, p, s = map(np.concatenate, (cursors, places, scores))
    order = np.argsort(c)
    return c[order], p[order], s[order]


def behind_best(at: np.ndarray, score: np.ndarray, back: int, ahead: int) -> Move:
    """Behind the best place of the window, but never back."""
    c, p, _ = best_in_window(at, score, back, ahead)
    y = np.maximum(c, p + 1)
    return Move(None, c[y != c], y[y != c])


def _composed(rows: pd.DataFrame) -> Move:
    out = Move()
    for r in rows.sort_values("node").itertuples():
        out = out.then(_move(r))
    return out


def _move(r) -> Move:
    return Move(None if pd.isna(r.const) else int(r.const), np.asarray(r.xs, np.int64), np.asarray(r.ys, np.int64))


def starts(moves: DataFrame, by: list[str], fan: int = FAN) -> DataFrame:
    """(by, node, start): the cursor before each node of ``moves`` (by, node, const, xs, ys), 0 before the first.

    ``node`` is a whole number that orders the nodes of a key of ``by``; gaps are nodes that do nothing.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in moves.select(*by).schema)
    least, most = moves.agg(F.min("node"), F.max("node")).first()
    levels, low, high = [moves], least, most
    while least is not None and low != high:
        low, high = low // fan, high // fan

        def up(key, rows: pd.DataFrame) -> pd.DataFrame:
            m = _composed(rows)
            return pd.DataFrame([(*key, m.const, m.xs, m.ys)], columns=[*by, "node", "const", "xs", "ys"]).astype({"const": "Int64"})

        parent = levels[-1].withColumn("parent", F.floor(F.col("node") / fan))
        levels.append(settled(parent.groupBy(*by, "parent").applyInPandas(up, f"{schema}, node long, const long, xs array<long>, ys array<long>")))
    out = levels[-1].select(*by, "node", F.lit(0).cast("long").alias("start"))
    for level in levels[-2::-1]:

        def down(key, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("node")
            c, begun = int(rows["start"].iloc[0]), []
            for r in rows.itertuples():
                begun.append(c)
                c = _move(r)(c)
            return pd.DataFrame({**dict(zip(by, key)), "node": rows["node"], "start": begun})[[*by, "node", "start"]]

        parent = level.withColumn("parent", F.floor(F.col("node") / fan))
        joined = parent.join(out.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("node").alias("parent_"), "start"), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] + [F.col("parent") == F.col("parent_")])
        out = joined.select(*by, "parent", "node", "const", "xs", "ys", "start").groupBy(*by, "parent").applyInPandas(down, f"{schema}, node long, start long")
    return out


def page_moves(steps: DataFrame, by: list[str], line: Callable) -> DataFrame:
    """(by, node, const, xs, ys) of pages; ``line`` makes a Move of a row of ``steps`` (by, page, idx, ...), taken in order of idx."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in steps.select(*by).schema)

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        out = Move()
        for r in rows.sort_values("idx").itertuples():
            out = out.then(line(r))
        return pd.DataFrame([(*key, out.const, out.xs, out.ys)], columns=[*by, "node", "const", "xs", "ys"]).astype({"const": "Int64"})

    return steps.groupBy(*by, "page").applyInPandas(run, f"{schema}, node long, const long, xs array<long>, ys array<long>")


def tiles(lines: DataFrame, targets: DataFrame, by: list[str], line_cols: list[str], target_cols: list[str], pages: int = 16, places: int = 512, spread: int = 16) -> DataFrame:
    """(by, lines, targets): the lines of ``pages`` pages with ``places`` texts of the list, every pair of tiles of a key once.

    The list is copied ``spread`` times, so that the pages of one large key are dealt over as many partitions.
    """
    a = lines.groupBy(*by, F.floor(F.col("page") / pages).alias("_tile")).agg(F.collect_list(F.struct(*line_cols)).alias("lines"))
    a = a.withColumn("_salt", F.pmod(F.xxhash64("_tile"), F.lit(spread)))
    b = targets.groupBy(*by, F.floor(F.col("ord") / places).alias("_part")).agg(F.collect_list(F.struct(*target_cols)).alias("targets"))
    b = b.select(*[F.col(c).alias(f"_{c}") for c in by], "targets", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))).alias("salt_"))
    return a.join(b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] + [F.col("_salt") == F.col("salt_")]).select(*by, "lines", "targets")


def letters(texts: list[str], bins: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """How many characters of each text fall into each bin, and the lengths."""
    out = np.zeros((len(texts), bins), np.int32)
    for i, t in enumerate(texts):
        if t:
            out[i] = np.bincount(np.frombuffer(t.encode("utf-32-le"), np.uint32) % bins, minlength=bins)
    return out, out.sum(1)


def at_most(one: tuple[np.ndarray, int], many: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A bound from above of the Ratcliff-Obershelp ratio of a text to others: no match uses a character twice."""
    common = np.minimum(one[0], many[0]).sum(1)
    return np.where((one[1] > 0) & (many[1] > 0), 2.0 * common / np.maximum(one[1] + many[1], 1), 0.0)
