"""N-gram Jaccard join by vertical partitioning.

A document's set holds the 64-bit hashes of its distinct word n-grams.  Each distinct set is one
vertex, named by the smallest id that has it; an id that is the smallest of several sets names one
of them, and the others get names by hash that are no id of another vertex.  All n-grams have one global order: frequent ones last, the others by hash.  A pair above
the threshold shares an n-gram among the first ``n - ceil(t * n) + 1`` of either set, so these
prefixes give the candidates.  The order is cut into fragments by ranges of the hash; for every
candidate pair the overlap is counted in each fragment by itself and summed per pair, and the sum
decides exactly: ``100 * overlap >= percent * union``.

What is frequent is counted over the whole corpus: first in the beginnings of all sets by hash, then
further on in the sets whose beginnings hold many frequent n-grams.  Of each count at most
``MAX_FREQUENT`` n-grams, the most frequent ones, are broadcast (4 MB).  Any such choice gives the same links, it only keeps passages
that many documents share out of the prefixes.

Lists of vertices that share a prefix n-gram aren't expanded into pairs.  Each list's least vertex,
its pivot, is compared with the others, which is linear.  Where a list is long, the vertices within
reach of its pivot become a cluster: groups of near copies.  A cluster's medoid, the member nearest
to the majority of its members' n-grams, is compared with them; that links what is close to a
common origin.  The members that are still in different components are compared in blocks of
bitmaps, in which no pair is a row unless it may link.  What is left are pairs of one list that
aren't of one cluster or component; all of them are compared, those of long lists in blocks too, so
no link is lost.  A cluster of many members is dealt over several tasks wherever it is joined.

Comparing begins with a bitmap of each set (512 bytes) that bounds the difference of two sets from
below; whole sets are made and shuffled only for pairs that link or nearly do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.llm.common import forget, least_names, named_vertices, split_hint, staged, table
from quiremill.llm.components import components
from quiremill.llm.texthash import U, column_bytes, mix, release, shingles, slices, words

MAX_FREQUENT = 1 << 19
FREQUENT = 4
SHORT = 8
#: Vertices within so many times the largest linking difference of a pivot are its cluster.
REACH = 6
BLOCK = 256
#: Rows of one cluster that go to one task; lists of more vertices than ``LONG`` are compared in blocks.
PART = 1024
LONG = 32
FRAGMENT_BITS = 3
BITMAP_WORDS = 64
#: A set of ids is broadcast only if it was counted and has at most so many (24 MB); else it is joined by shuffle.
MAX_IDS = 1_000_000


def _prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (percent * n + 99) // 100 + 1


def _signature(keys: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set that don't depend on its order."""
    out = []
    for salt in (0x1F3D5B79, 0x2E4C6A88):
        run = np.concatenate((np.zeros(1, U), np.cumsum(mix(keys ^ U(salt * 0x100000001)), dtype=U)))
        out.append((run[off[1:]] - run[off[:-1]]).view(np.int64))
    return out[0], out[1]


def _sets(part: pa.RecordBatch, text: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    data, off = column_bytes(part.column(part.schema.get_field_index(text)))
    h, row = words(data, off)
    return shingles(h, row, part.num_rows, k)


def _ragged(values: np.ndarray, size: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(values.view(np.int64)))


def _firsts(keys: np.ndarray, off: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The first ``size[i]`` entries of each row."""
    at = np.repeat(off[:-1] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
    return keys[at]


def _probe_size(n: np.ndarray, percent: int) -> np.ndarray:
    return np.minimum(n, _prefix_size(n, percent) * 9 // 8 + 4)


def _describe(k: int, percent: int):
    """(d, n, s1, s2, probe): size, signature and the n-grams of least hash, more than a prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                keys, off = _sets(part, "t", k)
                n = np.diff(off)
                s1, s2 = _signature(keys, off)
                size = np.where(n > 0, _probe_size(n, percent), 0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n.astype(np.int64)), pa.array(s1), pa.array(s2), _ragged(_firsts(keys, off, size), size)], ["d", "n", "s1", "s2", "probe"])
        release()

    return run


def _reorder(keys: np.ndarray, off: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with frequent n-grams moved to their end, and how many others each has."""
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
        late = frequent[at] == keys
    else:
        late = np.zeros(len(keys), bool)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    order = np.lexsort((late, row))
    return keys[order], np.bincount(row[~late], minlength=len(off) - 1)


def _prefixes(percent: int, shared):
    """From (d, n, probe): prefixes in the global order, of rows whose probe is enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            off = lists.offsets.to_numpy().astype(np.int64)
            keys, off = lists.values.to_numpy()[off[0] : off[-1]].view(U), off - off[0]
            n = batch.column(1).to_numpy()
            keys, usual = _reorder(keys, off, shared.value)
            need = _prefix_size(n, percent)
            size = np.where((usual >= need) | (np.diff(off) == n), need, 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _ragged(_firsts(keys, off, size), size)], ["u", "n", "prefix"])

    return run


def _late_prefixes(k: int, percent: int, shared, wide: bool = False):
    """From texts: prefixes of rows whose probe isn't enough; or more than that, to count frequencies in.

    The wider stretch is half as much again as a prefix takes at the probe's share of frequent n-grams.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for batch in batches:
            for part in slices(batch, "t"):
                keys, off = _sets(part, "t", k)
                n = np.diff(off)
                probe = np.where(n > 0, _probe_size(n, percent), 0)
                low = np.concatenate(([0], np.cumsum(probe)))
                _, usual = _reorder(_firsts(keys, off, probe), low, frequent)
                need = _prefix_size(n, percent)
                rows = np.flatnonzero((n > 0) & (usual < need) & (probe < n))
                if not len(rows):
                    continue
                s1, s2 = _signature(keys, off)
                keys, _ = _reorder(keys, off, frequent)
                size = np.zeros(len(n), np.int64)
                size[rows] = need[rows]
                if wide:
                    share = (usual[rows] + 1) / (probe[rows] + 1)
                    size[rows] = np.minimum(n[rows], (1.5 * need[rows] / share).astype(np.int64) + 8)
                pick = pa.array(rows)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pick), pa.array(n[rows].astype(np.int64)), pa.array(s1[rows]), pa.array(s2[rows]), _ragged(_firsts(keys, off, size), size[rows])], ["d", "n", "s1", "s2", "prefix"])
        release()

    return run


def _of_vertices(k: int, emit):
    """Over (t, u, s1, s2): ``emit(u, n, keys)`` of the texts that have the vertex's set; other texts of its id are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                keys, off = _sets(part, "t", k)
                s1, s2 = _signature(keys, off)
                at = np.flatnonzero((s1 == part.column(2).to_numpy()) & (s2 == part.column(3).to_numpy()))
                if len(at):
                    size = np.zeros(part.num_rows, np.int64)
                    size[at] = np.diff(off)[at]
                    yield emit(part.column(1).to_numpy()[at], size[at], _firsts(keys, off, size))
        release()

    return run


def _bitmaps(u: np.ndarray, n: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """(u, bits): each n-gram flips one of the bits."""
    width = 64 * BITMAP_WORDS
    off = np.concatenate(([0], np.cumsum(n)))
    parts = []
    for lo in range(0, len(u), 128):  # a few MB at a time, however short the texts are
        hi = min(len(u), lo + 128)
        row = np.repeat(np.arange(hi - lo), n[lo:hi])
        bit = (keys[off[lo] : off[hi]] % U(width)).astype(np.int64)
        odd = np.bincount(row * width + bit, minlength=(hi - lo) * width) & 1
        parts.append(np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64))
    packed = np.concatenate(parts)
    return pa.RecordBatch.from_arrays([pa.array(u), _ragged(packed, np.full(len(u), BITMAP_WORDS))], ["u", "bits"])


def _fragments(u: np.ndarray, n: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """(u, f, toks): sets cut by ranges of the hash."""
    row = np.repeat(np.arange(len(u)), n)
    group = row << FRAGMENT_BITS | (keys >> U(64 - FRAGMENT_BITS)).astype(np.int64)
    start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    g = group[start]
    return pa.RecordBatch.from_arrays([pa.array(u[g >> FRAGMENT_BITS]), pa.array((g & ((1 << FRAGMENT_BITS) - 1)).astype(np.int32)), _ragged(keys, np.diff(np.append(start, len(keys))))], ["u", "f", "toks"])


def _few(ids: DataFrame) -> DataFrame:
    """``ids`` with a broadcast hint if, counted, they are few enough."""
    return F.broadcast(ids) if ids.count() <= MAX_IDS else ids


def _differ(pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with ``differ``, at most the number of n-grams in which the sets differ."""
    left, right = bitmaps.select(F.col("u").alias("a"), F.col("bits").alias("x")), bitmaps.select(F.col("u").alias("b"), F.col("bits").alias("y"))
    differ = F.aggregate(F.zip_with("x", "y", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return pairs.join(left, "a").join(right, "b").select(*pairs.columns, differ.alias("differ"))


def _may_link(percent: int, times: int = 1):
    """A pair links only if at most ``(100 - percent) / (100 + percent)`` of its n-grams differ."""
    return (100 + percent) * F.col("differ") <= times * (100 - percent) * (F.col("na") + F.col("nb"))


def _majority(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (cl, bits): how often each bit is set in a cluster, (cl, members, counts), partial sums."""
    sums: dict[int, np.ndarray] = {}
    flush = lambda: pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([list(x) for x in sums.values()], pa.list_(pa.int32()))], ["cl", "counts"])
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            part = batch.slice(lo, 1024)
            bits = np.unpackbits(_bits_of(part.column(1)).view(np.uint8), axis=1, bitorder="little")
            cl = part.column(0).to_numpy()
            order = np.argsort(cl, kind="stable")
            start = np.flatnonzero(np.concatenate(([True], np.diff(cl[order]) != 0)))
            for c, x, n in zip(cl[order][start].tolist(), np.add.reduceat(bits[order], start, axis=0, dtype=np.int32), np.diff(np.append(start, len(cl))), strict=True):
                x = np.append(x, n).astype(np.int32)
                sums[c] = sums[c] + x if c in sums else x
            if len(sums) > 2000:
                yield flush()
                sums = {}
    if sums:
        yield flush()


def _sum(parts):
    """A cluster's partial counts as one row."""
    return parts[["cl"]].head(1).assign(counts=[np.sum(np.stack(parts["counts"].to_numpy()), axis=0)])


def _centre(parts):
    """From sums of a cluster's counts, 64 at most: the bits that most members have."""
    x = np.sum(np.stack(parts["counts"].to_numpy()), axis=0)
    bits = np.packbits((2 * x[:-1] > x[-1]).astype(np.uint8), bitorder="little").view(np.int64)
    return parts[["cl"]].head(1).assign(centre=[bits])


def _bits_of(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy().reshape(-1, BITMAP_WORDS)


def _block_pairs(percent: int):
    """Over (g, u, n, c, cl, bits, side), sorted by g: pairs that may link, of different components and not of one cluster ``cl``, if that isn't null."""

    def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
        t = t.combine_chunks()
        g, u, n, c, side = (t.column(k).to_numpy() for k in ("g", "u", "n", "c", "side"))
        loose, cl = t.column("cl").is_null().to_numpy(), t.column("cl").fill_null(0).to_numpy()
        bits = _bits_of(pa.concat_arrays(t.column("bits").chunks)).view(np.uint64)
        start = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
        for lo, hi in zip(start, np.append(start[1:], len(g)), strict=True):
            # the block against itself (all sides equal) or against the other one
            x = np.arange(lo, hi) if side[lo:hi].min() == side[lo:hi].max() else np.flatnonzero(side[lo:hi] == 0) + lo
            y = x if len(x) == hi - lo else np.flatnonzero(side[lo:hi] == 1) + lo
            for i in x.tolist():
                other = y[(c[y] != c[i]) & (loose[y] | loose[i] | (cl[y] != cl[i])) & ((u[y] > u[i]) if y is x else True)]
                most = (100 - percent) * (n[other] + n[i])
                other = other[np.abs(n[other] - n[i]) * (100 + percent) <= most]
                if not len(other):
                    continue
                differ = np.bitwise_count(bits[other] ^ bits[i]).sum(1, dtype=np.int64)
                hit = other[(100 + percent) * differ <= (100 - percent) * (n[other] + n[i])]
                if len(hit):
                    first = u[hit] > u[i]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u[hit], u[i])), pa.array(np.maximum(u[hit], u[i])), pa.array(np.where(first, n[i], n[hit])), pa.array(np.where(first, n[hit], n[i]))], ["a", "b", "na", "nb"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 4 * BLOCK:
                t = pa.Table.from_batches(held)
                g = t.column("g").to_numpy()
                other = np.flatnonzero(g != g[-1])
                cut = int(other[-1]) + 1 if len(other) else 0
                if cut:
                    yield from solve(t.slice(0, cut))
                    held = t.slice(cut).combine_chunks().to_batches()
        if held:
            yield from solve(pa.Table.from_batches(held))

    return run


def _links(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b, na, nb) those that link: the overlap of each fragment, summed per pair."""
    left = sets.select(F.col("u").alias("a"), "f", F.col("toks").alias("ta"))
    right = sets.select(F.col("u").alias("b"), "f", F.col("toks").alias("tb"))
    parts = near.join(left, "a").join(right, ["b", "f"]).select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("part"))
    both = parts.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("o"))
    return both.where(100 * F.col("o") >= percent * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b")


def _sizes_fit(percent: int, x: str, y: str):
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def jaccard_components(docs: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_shingles``, ``component_id``.

    Words are runs of characters that aren't ASCII white space, A-Z lower-cased.  A text of fewer
    than ``k`` words has its whole sequence as its only shingle; a null text or one without words
    has none, links with nothing and is its own component.  A null id is in no component.  Repeated
    rows get equal results; an id with several texts has a row for each, which links by its own text
    only: rows of one id can be in different components.  Components are named by their smallest id.
    Ids are integers of any sign; further columns don't matter.
    """
    spark = docs.sparkSession
    src = split_hint(docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t")))
    seen = staged(src.mapInArrow(_describe(k, percent), "d long, n long, s1 long, s2 long, probe array<long>"), "sets")
    valid = seen.where("n > 0 and d is not null")
    sets = staged(valid.groupBy("s1", "s2", "n").agg(F.min("d").alias("d")), "vertices")
    reps, shared = named_vertices(sets, ["s1", "s2", "n"])
    renamed = reps.where("u <> d").select("d", "s1", "s2", F.col("u").alias("name"))
    extra = valid.select("d", "s1", "s2").join(reps.select("d", "s1", "s2"), ["d", "s1", "s2"], "left_anti")
    extra = staged(extra.distinct(), "copies")
    repeated = valid.count() > reps.count() + extra.count()
    extra = _few(extra)

    def of_vertices(rows: DataFrame) -> DataFrame:
        """Of rows (d, s1, s2, ...) one for each vertex, with its name ``u``."""
        rows = rows.join(extra, ["d", "s1", "s2"], "left_anti").where("d is not null")
        if repeated:
            rows = rows.dropDuplicates(["d", "s1", "s2"])
        if not shared:
            return rows.withColumn("u", F.col("d"))
        return rows.join(renamed, ["d", "s1", "s2"], "left").withColumn("u", F.coalesce("name", "d"))

    single = of_vertices(valid)

    def most_frequent(toks: DataFrame) -> np.ndarray:
        df = toks.groupBy("tok").agg(F.count("*").alias("df")).where(F.col("df") >= FREQUENT)
        top = df.orderBy(F.desc("df"), "tok").limit(MAX_FREQUENT).select("tok").toPandas()["tok"].to_numpy()
        return np.sort(top.astype(np.int64).view(U))

    near_hand = most_frequent(single.select(F.explode("probe").alias("tok")))
    more = src.mapInArrow(_late_prefixes(k, percent, spark.sparkContext.broadcast(near_hand), wide=True), "d long, n long, s1 long, s2 long, prefix array<long>")
    more = of_vertices(more)
    frequent = spark.sparkContext.broadcast(np.union1d(near_hand, most_frequent(more.select(F.explode("prefix").alias("tok")))))

    usual = single.select("u", "n", "probe").mapInArrow(_prefixes(percent, frequent), "u long, n long, prefix array<long>")
    late = src.mapInArrow(_late_prefixes(k, percent, frequent), "d long, n long, s1 long, s2 long, prefix array<long>")
    late = of_vertices(late).select("u", "n", "prefix")
    posts = staged(usual.union(late).select("u", F.explode("prefix").alias("tok")), "prefixes")
    many = posts.groupBy("tok").agg(F.count("*").alias("len")).where("len > 1")
    sizes = reps.select("u", "n")
    lists = staged(posts.join(many, "tok").join(sizes, "u").select("tok", "u", "n", "len"), "lists")
    forget(spark, posts)

    def vertex_texts(ids: DataFrame) -> DataFrame:
        need = _few(staged(ids.distinct().join(reps.select("u", F.col("d").alias("of"), "s1", "s2"), "u"), "need"))
        return src.join(need, src.d == need.of).select("t", "u", "s1", "s2")

    bitmaps = staged(vertex_texts(lists.select("u")).mapInArrow(_of_vertices(k, _bitmaps), "u long, bits array<long>").dropDuplicates(["u"]), "bitmaps")

    def links_of(near: DataFrame) -> DataFrame:
        near = staged(near.select("a", "b", "na", "nb").distinct(), "near")
        ids = near.select(F.col("a").alias("u")).union(near.select("b"))
        sets = vertex_texts(ids).mapInArrow(_of_vertices(k, _fragments), "u long, f int, toks array<long>")
        sets = staged(sets.dropDuplicates(["u", "f"]), "fragments")
        found = staged(_links(near, sets, percent), "links")
        forget(spark, near, sets)
        return found

    # each list's pivot against the list
    p = lists.groupBy("tok").agg(F.min(F.struct("u", "n")).alias("p"))
    met = lists.join(p.select("tok", F.col("p.u").alias("a"), F.col("p.n").alias("na")), "tok").where("u <> a").where(_sizes_fit(percent, "n", "na") | (F.col("len") > SHORT))
    met = met.groupBy("a", F.col("u").alias("b"), "na", F.col("n").alias("nb")).agg(F.max(F.col("len") > SHORT).alias("long"))
    met = staged(_differ(met, bitmaps).where(_may_link(percent) | (F.col("long") & _may_link(percent, REACH))), "pivots")
    links = links_of(met.where(_may_link(percent)))

    # clusters, and their medoids against them
    far = met.where("long")
    cluster = far.select(F.col("b").alias("u"), F.col("a").alias("cl")).union(far.select("a", "a")).groupBy("u").agg(F.min("cl").alias("cl"))
    # a pivot may be in the reach of another one: their clusters are one
    for _ in range(2):
        cluster = staged(cluster, "reach")
        cluster = cluster.join(cluster.select(F.col("u").alias("cl"), F.col("cl").alias("to")), "cl", "left").select("u", F.coalesce("to", "cl").alias("cl"))
    # of a large cluster's rows some PART stand together; its own row goes to each of these parts
    cluster = staged(cluster, "reach")
    large = cluster.groupBy("cl").agg(F.count("*").alias("size")).where(F.col("size") > PART).select("cl", F.ceil(F.col("size") / PART).cast("int").alias("parts"))
    large = _few(staged(large, "large"))
    parts = F.coalesce("parts", F.lit(1))

    def everywhere(rows: DataFrame) -> DataFrame:
        return rows.join(large, "cl", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")

    cluster = cluster.join(sizes, "u").join(bitmaps, "u").join(large, "cl", "left")
    cluster = staged(cluster.select("cl", F.pmod(F.xxhash64("u"), parts).cast("int").alias("part"), "u", "n", "bits"), "clusters")
    counts = cluster.select("cl", "bits").mapInArrow(_majority, "cl long, counts array<int>")
    counts = counts.groupBy("cl", F.pmod(F.spark_partition_id(), F.lit(64))).applyInPandas(_sum, "cl long, counts array<int>")
    centre = counts.groupBy("cl").applyInPandas(_centre, "cl long, centre array<long>")
    apart = F.aggregate(F.zip_with("bits", "centre", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    medoid = cluster.join(everywhere(centre), ["cl", "part"]).groupBy("cl").agg(F.min(F.struct(apart.alias("apart"), "u", "n")).alias("m"))
    medoid = everywhere(medoid.select("cl", F.col("m.u").alias("mu"), F.col("m.n").alias("mn")))
    star = cluster.select("cl", "part", "u", "n").join(medoid, ["cl", "part"]).where("u <> mu").where(_sizes_fit(percent, "n", "mn"))
    first = F.col("u") < F.col("mu")
    star = star.select(F.least("u", "mu").alias("a"), F.greatest("u", "mu").alias("b"), F.when(first, F.col("n")).otherwise(F.col("mn")).alias("na"), F.when(first, F.col("mn")).otherwise(F.col("n")).alias("nb"))
    links = staged(links.union(links_of(_differ(star, bitmaps).where(_may_link(percent)))), "links")
    comp = components(links, "a", "b")

    def in_blocks(rows: DataFrame, *group: str) -> DataFrame:
        """Pairs that may link, within groups of rows (size, u, n, c, cl, bits): each pair of blocks is compared in one task."""
        dealt = rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("x", F.pmod(F.xxhash64("u"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        g = F.xxhash64(*group, F.least("x", "y"), F.greatest("x", "y"))
        dealt = dealt.select(g.alias("g"), "u", "n", "c", "cl", "bits", (F.col("x") > F.col("y")).cast("int").alias("side"))
        tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        return split_hint(dealt.repartition(tasks, "g").sortWithinPartitions("g")).mapInArrow(_block_pairs(percent), "a long, b long, na long, nb long")

    # within clusters, what is in different components
    named = cluster.join(comp.withColumnRenamed("node", "u"), "u", "left").withColumn("c", F.coalesce("component", "u"))
    parted = named.groupBy("cl").agg(F.count("*").alias("size"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi")
    named = named.join(everywhere(parted.select("cl", "size")), ["cl", "part"])
    found = in_blocks(named.select("size", "u", "n", "c", F.lit(None).cast("long").alias("cl"), "bits", F.col("cl").alias("of")), "of")
    links = staged(links.union(links_of(found)), "links")
    comp = components(links, "a", "b")

    # pairs of a list that aren't of one cluster or component
    own = lists.join(comp.withColumnRenamed("node", "u"), "u", "left").join(cluster.select("u", "cl"), "u", "left")
    own = own.select("tok", "u", "n", "len", F.coalesce("component", "u").alias("c"), "cl")
    mixed = own.groupBy("tok").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("cl").alias("lo2"), F.max("cl").alias("hi2"), F.bool_or(F.col("cl").isNull()).alias("loose")).where("lo <> hi and (loose or lo2 <> hi2)")
    rest = staged(own.join(mixed.select("tok"), "tok"), "mixed")
    x = rest.where(F.col("len") <= LONG).select("tok", F.col("u").alias("a"), F.col("n").alias("na"), F.col("c").alias("ca"), F.col("cl").alias("cla"))
    y = x.select("tok", F.col("a").alias("b"), F.col("na").alias("nb"), F.col("ca").alias("cb"), F.col("cla").alias("clb"))
    left = x.join(y, "tok").where("a < b and ca <> cb and coalesce(cla <> clb, true)").where(_sizes_fit(percent, "na", "nb")).select("a", "b", "na", "nb").distinct()
    left = _differ(left, bitmaps).where(_may_link(percent)).select("a", "b", "na", "nb")
    long = rest.where(F.col("len") > LONG)
    if not long.isEmpty():
        long = long.join(bitmaps, "u").select(F.col("len").alias("size"), "u", "n", "c", "cl", "bits", "tok")
        left = left.union(in_blocks(long, "tok"))
    more = links_of(left)
    if not more.isEmpty():
        comp = components(links.union(more), "a", "b")
    forget(spark, lists, bitmaps, met, cluster, large, rest, links, more)
    if shared:
        comp = least_names(comp, reps)
    vertex = seen.select("d", "n", "s1", "s2").join(reps.select("s1", "s2", "n", "u", F.col("d").alias("own")), ["s1", "s2", "n"], "left")
    out = vertex.join(comp.withColumnRenamed("node", "u"), "u", "left")
    comp_id = F.when(F.col("d").isNotNull(), F.coalesce("component", "own", "d"))
    return out.select(F.col("d").alias(id_col), F.col("n").alias("n_shingles"), comp_id.alias("component_id"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


def components_sql(k: int, percent: int, docs: str = "documents") -> str:
    """DuckDB SQL for the same result, by all pairs that share a shingle."""
    gram = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    return rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM {docs}
), g AS (
  SELECT DISTINCT doc_id, {gram} AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {k - 2})) AS i FROM w WHERE len(w) >= {k})
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND {k - 1}
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS o FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT u, v FROM o JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * o >= {percent} * (x.n + y.n - o)
), reach AS (
  WITH RECURSIVE r(u, v) AS (SELECT doc_id, doc_id FROM {docs} UNION SELECT r.u, link.v FROM r JOIN link ON link.u = r.v)
  SELECT u, min(v) AS component_id FROM r GROUP BY u
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, reach.component_id
FROM {docs} d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach ON reach.u = d.doc_id
"""


SQL = components_sql(4, 85)
