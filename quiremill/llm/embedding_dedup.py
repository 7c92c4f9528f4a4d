"""Embedding near-dedup with randomised-rotation binary codes.

Each normalised vector ``o`` is rotated by random orthogonal matrices; the signs of the rotated
components are its code.  The rotations are two halves, A and B.  For each half the code decodes to
a vector, the signs turned back and summed, whose product with ``o`` is stored with the code as its
correction; divided by it, the decoded vector is ``o`` plus an error that stands at right angles to
``o`` in a random direction.  The product of one vector's half A with another's half B is therefore
an unbiased estimate of their cosine, from bits and corrections alone.  With ``a`` and ``b`` the
lengths of the two errors and ``s`` the sine at the threshold, a pair at the threshold or above has
an estimate less than ``eps * sqrt((a^2 s^2 + b^2 (s + a)^2) / (d - 1))`` below it, except with a
probability that falls as exp(-eps^2 / 2).  A pair whose estimate lies deeper isn't computed again;
every other pair is, in double precision, so no link is below the threshold.

Pairs are sought among vectors that share the label, the length and a band of code bits (``bands``
bands of ``band_bits`` bits): two vectors at the threshold differ in a bit with probability
angle / pi, so with the defaults a link at cosine 0.98 is missed with probability 4e-6, closer links
with less.  A pair counts in the first band it shares, so nothing is counted twice.

Equal vectors are one vertex with a number of copies.  A key with many vertices is dealt over blocks,
each pair of blocks being one group.  First only codes travel to the groups; the estimates tell which
vertices of a group have a pair to compute again, and only their vectors follow.  No pair is a row
unless it links in a small group; larger ones give link counts per vertex and a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.llm.common import forget, least_names, named_vertices, staged, table
from quiremill.llm.components import components

BLOCK = 256
#: Groups of at most so many rows are solved together.
SMALL = 32
#: Pairs computed one by one at a time; where more than a sixteenth of all are open, a product of matrices.
PAIRS = 1 << 15


def rotations(d: int, count: int, seed: int = 20) -> np.ndarray:
    """``count`` random orthogonal d x d matrices."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        q, r = np.linalg.qr(rng.standard_normal((d, d)))
        out.append(q * np.sign(np.diag(r)))
    return np.array(out)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest component first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Codes:
    """Codes of vectors of length ``d``."""

    def __init__(self, d: int, bands: int, band_bits: int, seed: int):
        count = max(2, -(-bands * band_bits // d))
        self.d, self.bands, self.band_bits = d, bands, band_bits
        self.stack = rotations(d, count, seed).reshape(-1, d)
        self.half = count // 2 * d
        self.back = self.stack.astype(np.float32)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Packed bits and the two corrections of vectors of length one."""
        bits = x @ self.stack.T > 0
        a, b = self._turned_back(bits)
        return np.packbits(bits, axis=1), np.stack((np.einsum("ij,ij->i", a, x), np.einsum("ij,ij->i", b, x)), 1)

    def _turned_back(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sign = np.where(bits, np.float32(1), np.float32(-1))
        turned = sign[:, : self.half] @ self.back[: self.half], sign[:, self.half :] @ self.back[self.half :]
        return turned[0].astype(np.float64), turned[1].astype(np.float64)

    def bits(self, packed: np.ndarray) -> np.ndarray:
        return np.unpackbits(packed, axis=1, count=len(self.stack)).astype(bool)

    def decode(self, packed: np.ndarray, corrections: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Both halves' decoded vectors and the lengths of their errors."""
        a, b = self._turned_back(self.bits(packed))
        a, b = a / corrections[:, :1], b / corrections[:, 1:]
        error = lambda v: np.sqrt(np.maximum(np.einsum("ij,ij->i", v, v) - 1, 0))
        return a, b, error(a), error(b)

    def keys(self, packed: np.ndarray) -> np.ndarray:
        """The bands of each code as numbers, [row, band]."""
        bits = self.bits(packed)[:, : self.bands * self.band_bits]
        return bits.reshape(len(packed), self.bands, self.band_bits) @ (1 << np.arange(self.band_bits, dtype=np.int64))

    def slack(self, a: np.ndarray, b: np.ndarray, threshold: float, eps: float) -> np.ndarray:
        """How far below the threshold an estimate from halves with these error lengths can be."""
        s = np.sqrt(max(0.0, 1 - threshold**2))
        return eps * np.sqrt((a**2 * s**2 + b**2 * (s + a) ** 2) / max(1, self.d - 1)) + 1e-5


_codes: dict[tuple, Codes] = {}


def codes_of(d: int, bands: int, band_bits: int, seed: int) -> Codes:
    key = (d, bands, band_bits, seed)
    if key not in _codes:
        if len(_codes) > 8:
            _codes.clear()
        _codes[key] = Codes(*key)
    return _codes[key]


def _numbers(col: pa.Array) -> np.ndarray:
    """The numbers of a column of lists, one list after another."""
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def _packed(col: pa.Array) -> np.ndarray:
    """A column of byte strings of one length as a matrix."""
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0] : off[-1]].reshape(len(col), -1)


def _by_length(size: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for d in np.unique(size).tolist():
        yield d, np.flatnonzero(size == d)


def _encode(bands: int, band_bits: int, seed: int):
    """From (u, size, x), (u, code, corrections)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                size = part.column(1).to_numpy()
                for d, at in _by_length(size):
                    some = part.take(pa.array(at))
                    packed, corrections = codes_of(d, bands, band_bits, seed).encode(unit(_numbers(some.column(2)).reshape(-1, d)))
                    yield pa.RecordBatch.from_arrays([some.column(0), pa.array([r.tobytes() for r in packed], pa.binary()), pa.array(list(corrections), pa.list_(pa.float64()))], ["u", "code", "corrections"])

    return run


def _bands(bands: int, band_bits: int, seed: int):
    """From (size, code, u, of), a row (u, of, band, key) for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                for d, at in _by_length(part.column(0).to_numpy()):
                    some = part.take(pa.array(at))
                    key = codes_of(d, bands, band_bits, seed).keys(_packed(some.column(1)))
                    i = pa.array(np.repeat(np.arange(len(at)), bands))
                    yield pa.RecordBatch.from_arrays([some.column(2).take(i), some.column(3).take(i), pa.array(np.tile(np.arange(bands, dtype=np.int32), len(at))), pa.array(key.reshape(-1))], ["u", "of", "band", "key"])

    return run


def _forest(link: np.ndarray) -> np.ndarray:
    """The least reachable row of each row of a symmetric link matrix."""
    label = np.arange(len(link))
    while True:
        least = np.where(link, label, len(link)).min(1)
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


class _Decoded:
    """The codes of the rows of many groups, decoded; rows of a group stand together.

    A group is one block of vertices, or two blocks (``side``) that are compared with each other.
    """

    def __init__(self, codes: Codes, packed: np.ndarray, corrections: np.ndarray, g: np.ndarray, band: np.ndarray, side: np.ndarray, threshold: float, eps: float):
        self.codes, self.band, self.threshold, self.eps = codes, band, threshold, eps
        self.a, self.b, self.ea, self.eb = codes.decode(packed, corrections)
        self.key = codes.keys(packed)
        self.g, self.start = g, np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
        self.size = np.diff(np.append(self.start, len(g)))
        two = np.logical_or.reduceat(side, self.start) & ~np.logical_and.reduceat(side, self.start)
        self.side, self.two = side, np.repeat(two, self.size)

    def _slack(self, p, q) -> np.ndarray:
        slack = lambda x, y: self.codes.slack(self.ea[x], self.eb[y], self.threshold, self.eps)
        return (slack(p, q) + slack(q, p)) / 2

    def small(self) -> tuple[np.ndarray, np.ndarray]:
        """The open pairs of all groups of at most ``SMALL`` rows."""
        few = np.repeat(self.size <= SMALL, self.size)
        ps, qs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for k in range(1, int(self.size[self.size <= SMALL].max(initial=1))):
            p = np.flatnonzero((self.g[k:] == self.g[:-k]) & few[k:])
            p = p[~self.two[p] | (self.side[p] != self.side[p + k])]
            # a pair that shares an earlier band is that band's
            p = p[(self.key[p] == self.key[p + k]).argmax(1) == self.band[p]]
            q = p + k
            estimate = (np.einsum("ij,ij->i", self.a[p], self.b[q]) + np.einsum("ij,ij->i", self.a[q], self.b[p])) / 2
            may = estimate + self._slack(p, q) >= self.threshold
            ps.append(p[may])
            qs.append(q[may])
        return np.concatenate(ps), np.concatenate(qs)

    def large(self) -> Iterator[tuple[slice, np.ndarray]]:
        """The rows of each larger group and a symmetric matrix of its open pairs."""
        for lo, many in zip(self.start[self.size > SMALL].tolist(), self.size[self.size > SMALL].tolist(), strict=True):
            s = slice(lo, lo + many)
            rows = np.arange(lo, lo + many)
            estimate = self.a[s] @ self.b[s].T
            may = (estimate + estimate.T) / 2 + self._slack(rows[:, None], rows[None, :]) >= self.threshold
            if self.two[lo]:
                may &= self.side[s][:, None] != self.side[s][None, :]
            for k in range(self.band[lo]):
                may &= self.key[s, k][:, None] != self.key[s, k][None, :]
            np.fill_diagonal(may, False)
            yield s, may | may.T


def linked(x: np.ndarray, open_: np.ndarray, threshold: float) -> np.ndarray:
    """Of a symmetric matrix of open pairs of rows of length one, those that link, computed in double precision."""
    link = np.zeros(open_.shape, bool)
    if 16 * np.count_nonzero(open_) > open_.size:
        return open_ & (x @ x.T >= threshold)
    i, j = np.nonzero(np.triu(open_))
    for lo in range(0, len(i), PAIRS):
        p, q = i[lo : lo + PAIRS], j[lo : lo + PAIRS]
        hit = np.einsum("ij,ij->i", x[p], x[q]) >= threshold
        link[p[hit], q[hit]] = True
    return link | link.T


def _whole_groups(batches: Iterator[pa.RecordBatch], least: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``g`` in batches of whole groups."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        t = pa.Table.from_batches(held)
        g = t.column("g").to_numpy()
        other = np.flatnonzero(g != g[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield from _one_batch(t.slice(0, cut))
            held = t.slice(cut).combine_chunks().to_batches()
            rows = len(g) - cut
    if rows:
        yield from _one_batch(pa.Table.from_batches(held))


def _one_batch(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """The table as one batch for each length of vectors."""
    batch = t.combine_chunks().to_batches()[0]
    sizes = list(_by_length(batch.column("size").to_numpy()))
    for _, at in sizes:
        yield batch if len(sizes) == 1 else batch.take(pa.array(at))


def _decoded(t: pa.RecordBatch, bands: int, band_bits: int, seed: int, threshold: float, eps: float) -> _Decoded:
    col = lambda k: t.column(t.schema.get_field_index(k))
    codes = codes_of(col("size")[0].as_py(), bands, band_bits, seed)
    return _Decoded(codes, _packed(col("code")), _numbers(col("corrections")).reshape(-1, 2), col("g").to_numpy(), col("band").to_numpy(), col("side").to_numpy(zero_copy_only=False), threshold, eps)


def _open_rows(*how):
    """Over codes sorted by group: the vertices of each group that have an open pair, (g, u, band, side, open)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches):
            got = _decoded(t, *how)
            p, q = got.small()
            many = np.bincount(p, minlength=t.num_rows) + np.bincount(q, minlength=t.num_rows)
            for s, may in got.large():
                many[s] = np.count_nonzero(may, axis=1)
            at = np.flatnonzero(many)
            if len(at):
                rows = t.select(["g", "u", "band", "side"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(many[at].astype(np.int64))], ["g", "u", "band", "side", "open"])

    return run


def _group_links(*how):
    """Over codes and vectors sorted by group: link counts (v null) and spanning links (n null)."""
    threshold = how[-2]
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("n", pa.int64())])

    def emit(u, v, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()) if v is not None else pa.nulls(len(u), pa.int64()), pa.array(n, pa.int64()) if n is not None else pa.nulls(len(u), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches):
            got = _decoded(t, *how)
            u, m = t.column("u").to_numpy(), t.column("m").to_numpy()
            x = unit(_numbers(t.column("x")).reshape(t.num_rows, -1))
            p, q = got.small()
            hit = np.concatenate([np.einsum("ij,ij->i", x[p[lo : lo + PAIRS]], x[q[lo : lo + PAIRS]]) for lo in range(0, len(p), PAIRS)] or [np.empty(0)]) >= threshold
            p, q = p[hit], q[hit]
            if len(p):
                yield emit(u[p], u[q], None)
                yield emit(np.concatenate((u[p], u[q])), None, np.concatenate((m[q], m[p])))
            for s, may in got.large():
                link = linked(x[s], may, threshold)
                n_each = link @ m[s]
                some = np.flatnonzero(n_each)
                if len(some):
                    root = _forest(link)
                    yield emit(u[s][some], None, n_each[some])
                    off = some[root[some] != some]
                    yield emit(u[s][off], u[s][root[off]], None)

    return run


def embedding_links(vectors: DataFrame, d: int | None = None, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = 0.98, bands: int = 40, band_bits: int = 20, eps: float = 6.0, seed: int = 20) -> DataFrame:
    """One row per id: ``n_links``, ``component_id``, ``kept``.

    Two vectors link when their labels are equal and not null, they have one length (``d``, if given)
    and their cosine is at least ``threshold``.  Vectors that are null, empty, zero or with null or
    non-finite components link with nothing, nor does a null id.  Repeated rows of an id count
    once; an id with several vectors has the links of all and joins their components.  Ids are
    integers; further columns are left out.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x"), F.col(label_col).alias("label"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    ok = F.col("label").isNotNull() & F.col("id").isNotNull() & finite & F.exists("x", lambda v: v != 0)
    if d is not None:
        ok = ok & (F.size("x") == d)
    # -0.0 and 0.0 are one value; the key is the vector itself, by two hashes of it
    plain = F.transform("x", lambda v: v + F.lit(0.0))
    good = rows.where(F.coalesce(ok, F.lit(False))).select("id", "label", plain.alias("x"))
    # labels and lengths by hash from here on: ``of``
    keyed = good.select("id", "x", F.xxhash64("label", F.size("x")).alias("of"), F.xxhash64("label", "x").alias("h"), F.xxhash64(F.lit("second"), "label", "x").alias("h2"))
    ids = staged(keyed.groupBy("id", "of", "h", "h2").agg(F.any_value("x").alias("x")), "vectors")
    sets = staged(ids.groupBy("of", "h", "h2").agg(F.min("id").alias("d"), F.count("*").alias("m"), F.any_value("x").alias("x")), "vertices")
    reps, shared = named_vertices(sets, ["of", "h", "h2"])

    how = (bands, band_bits, seed)
    codes = reps.select("u", F.size("x").alias("size"), "x").mapInArrow(_encode(*how), "u long, code binary, corrections array<double>")
    codes = staged(codes.join(reps.select("u", "of", F.size("x").alias("size")), "u"), "codes")
    band = staged(codes.select("size", "code", "u", "of").mapInArrow(_bands(*how), "u long, of long, band int, key long"), "bands")
    many = band.groupBy("of", "band", "key").agg(F.count("*").alias("n")).where("n > 1")
    hit = band.join(many, ["of", "band", "key"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    # block pairs: a row of block b goes to the pairs (b, c) and (c, b), each pair being a group
    pairs = hit.withColumn("b", F.pmod(F.xxhash64("u"), F.col("blocks")).cast("int")).withColumn("c", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.xxhash64("of", "band", "key", F.least("b", "c"), F.greatest("b", "c"))
    dealt = pairs.select("u", "band", group.alias("g"), (F.col("b") > F.col("c")).alias("side"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def grouped(rows: DataFrame, *more: str) -> DataFrame:
        full = rows.join(codes.select("u", "size", "code", "corrections"), "u").select("g", "u", "band", "side", "size", "code", "corrections", *more)
        return full.repartition(n, "g").sortWithinPartitions("g")

    decide = (*how, threshold, eps)
    open_ = staged(grouped(dealt).mapInArrow(_open_rows(*decide), "g long, u long, band int, side boolean, open long"), "open")
    found = grouped(open_.join(reps.select("u", "m", "x"), "u"), "m", "x")
    found = staged(found.mapInArrow(_group_links(*decide), "u long, v long, n long"), "links")
    forget(spark, band, codes, open_)
    counts = found.where("n is not null").groupBy("u").agg(F.sum("n").alias("n"))
    edges = found.where("v is not null").select("u", "v")
    # an id with several vectors joins them
    own = ids.select("id", "of", "h", "h2").join(reps.select("of", "h", "h2", "u"), ["of", "h", "h2"]).select("id", "u")
    several = own.groupBy("id").agg(F.min("u").alias("v"), F.max("u").alias("hi")).where("v <> hi").select("id", "v")
    comp = components(edges.union(own.join(several, "id").select("u", "v")), "u", "v")
    if shared:
        comp = least_names(comp, reps)
    per_rep = reps.select("of", "h", "h2", "u", "d", "m").join(counts, "u", "left").join(comp.withColumnRenamed("node", "u"), "u", "left")
    per_rep = per_rep.select("of", "h", "h2", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "d").alias("component"))
    per_id = ids.select("id", "of", "h", "h2").join(per_rep, ["of", "h", "h2"]).groupBy("id").agg(F.sum("n_links").alias("n_links"), F.min("component").alias("component"))
    out = rows.select("id").distinct().join(per_id, "id", "left")
    comp_id = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"), F.coalesce(F.col("id") == comp_id, F.lit(False)).alias("kept"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"))


SQL = """
WITH e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_aggregate(embedding::DOUBLE[], 'sum') IS NOT NULL
), n AS (
  SELECT vec_id, label, x, sqrt(list_dot_product(x, x)) AS len FROM e
), link AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.len > 0 AND b.len > 0 AND list_dot_product(a.x, b.x) / (a.len * b.len) >= 0.98
), reach AS (
  WITH RECURSIVE r(u, v) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.u, link.v FROM r JOIN link ON link.u = r.v)
  SELECT u, min(v) AS component_id FROM r GROUP BY u
)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, reach.component_id, e.vec_id = reach.component_id AS kept
FROM embeddings e JOIN reach ON reach.u = e.vec_id LEFT JOIN (SELECT u, count(*) AS n FROM link GROUP BY u) c ON c.u = e.vec_id
"""
