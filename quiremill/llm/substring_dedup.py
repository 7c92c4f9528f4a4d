"""Substring dedup with suffix automata: words in passages that occur again anywhere are removed.

A window is ``window`` consecutive words.  It's repeated if its words also start elsewhere, in the same document
or another one; every word under a repeated window goes.

The corpus is its own reference, so its shards are cut by content: each window has an anchor, the run
of ``gram`` words in it with the smallest hash (the first of equals), and consecutive windows with the
same anchor are one segment.  Equal windows have equal anchors, so a shard that holds all segments of an
anchor holds all occurrences of its windows.  Only anchors that occur twice matter: a first pass
counts them, and a bitmap of fixed size, broadcast, lets a second pass leave out nearly all segments whose
anchor occurs once.  Equal segments are one with a number of occurrences.

For each shard a suffix automaton is built over its segments.  Each state knows in how many places
its words end.  The segments stream through it: where the matching statistic reaches the window and the state
has two places, the window is repeated, and the union of such windows gives the maximal spans.
Spans go back to the documents by segment, and the words under them are cut out.

An anchor with many different segments (a phrase in a third of all documents, each time in other company)
would make its shard large: its segments are cut into their windows, which are dealt by their own words.
No automaton is broadcast to all documents: the reference grows with the corpus, and each of its shards
would meet each document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.llm.common import forget, free_name, split_hint, staged, table
from quiremill.llm.texthash import U, _power_tables, column_bytes, mix, release, slices, words

WINDOW, GRAM = 35, 12
_PIECE = 4 << 20
_PLACES = 1 << 19
_A, _B = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)
_BLANK = b" \t\n\r\x0b\x0c"


class SuffixAutomaton:
    """Of several word sequences; each state counts the places where its words end, by the sequences' weights."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _clone(self, p: int, w, q: int) -> int:
        c = len(self.link)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.count.append(0)
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        self.link[q] = c
        return c

    def add(self, sequence: list, weight: int = 1) -> None:
        nxt, link, length, count = self.next, self.link, self.length, self.count
        last = 0
        for w in sequence:
            q = nxt[last].get(w)
            if q is None:
                cur = len(link)
                nxt.append({})
                length.append(length[last] + 1)
                link.append(0)
                count.append(0)
                p = last
                while p >= 0 and w not in nxt[p]:
                    nxt[p][w] = cur
                    p = link[p]
                if p >= 0:
                    q = nxt[p][w]
                    link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
                last = cur
            else:
                last = q if length[q] == length[last] + 1 else self._clone(last, w, q)
            count[last] += weight

    def close(self) -> None:
        """Hand the counts of longer words on to their suffixes, after the last ``add``."""
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[s]] += self.count[s]

    def statistics(self, sequence: list, most: int) -> Iterator[tuple[int, int]]:
        """For each place: the length, at most ``most``, of the longest match that ends there, and in how many places it occurs."""
        nxt, link, length, count = self.next, self.link, self.length, self.count
        state = n = 0
        for w in sequence:
            while state and w not in nxt[state]:
                state = link[state]
                n = length[state]
            q = nxt[state].get(w)
            if q is None:
                n = 0
            else:
                state = q
                n = min(n + 1, most)
                while length[link[state]] >= n:
                    state = link[state]
            yield n, count[state]


def repeated_spans(automaton: SuffixAutomaton, sequence: list, window: int) -> list[tuple[int, int]]:
    """Maximal spans [from, to) of ``sequence`` under windows that occur twice or more in the automaton."""
    out: list[tuple[int, int]] = []
    for e, (n, count) in enumerate(automaton.statistics(sequence, window), 1):
        if n == window and count > 1:
            out[-1:] = [(out[-1][0], e)] if out and out[-1][1] >= e - window else [*out[-1:], (e - window, e)]
    return out


def _cuts(data: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Pieces of about ``size`` bytes that end before a blank."""
    lo = 0
    while len(data) - lo > size:
        at = lo + size
        while at < len(data):
            blank = np.flatnonzero(np.isin(data[at : at + size], np.frombuffer(_BLANK, np.uint8)))
            if len(blank):
                break
            at += size
        if at >= len(data):
            break
        yield lo, at + int(blank[0])
        lo = at + int(blank[0])
    yield lo, len(data)


def _hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word; a very long text in pieces."""
    if len(off) > 2 or len(data) <= 2 * _PIECE:
        return words(data, off, lower=False)
    h = np.concatenate([words(data[a:b], np.array([0, b - a]), lower=False)[0] for a, b in _cuts(data, _PIECE)])
    return h, np.zeros(len(h), np.int64)


def _runs(x: np.ndarray, k: int, join) -> np.ndarray:
    """``join`` over each run of ``k`` neighbours, by doubling; ``join(left, right, words in left)``."""
    out, done, step = None, 0, 1
    while k:
        if k & 1:
            if out is None:
                out = x
            else:
                m = len(x) - done
                out = join(out[: max(m, 0)], x[done:], done) if m > 0 else out[:0]
            done += step
        k >>= 1
        if k:
            x = join(x[:-step], x[step:], step) if len(x) > step else x[:0]
            step *= 2
    return out


def segments(h: np.ndarray, row: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """Segments of the words ``h``: first word, number of words, anchor, row."""
    found = {k: [] for k in ("at", "n", "anchor")}
    for lo in range(0, max(len(h) - window + 1, 0), _PLACES):
        hi = min(lo + _PLACES, len(h) - window + 1)
        part = h[lo : hi + window - 1]
        grams = _runs(part, gram, lambda a, b, n: mix(a * _A + b * _B + U(n)))
        places = np.arange(len(grams), dtype=U)
        packed = (grams >> U(20) << U(20)) | places  # fewer than 2**20 places: smallest hash, then first place
        anchor = (_runs(packed, window - gram + 1, lambda a, b, _: np.minimum(a, b)) & U((1 << 20) - 1)).astype(np.int64)
        whole = row[lo:hi] == row[lo + window - 1 : hi + window - 1]
        edge = np.ones(hi - lo + 1, bool)
        edge[1:-1] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1]) | (row[lo + 1 : hi] != row[lo : hi - 1])
        ends = np.flatnonzero(edge)
        first, size = ends[:-1], np.diff(ends)
        own = whole[first]
        first, size = first[own], size[own]
        found["at"].append(first + lo)
        found["n"].append(size + window - 1)
        found["anchor"].append(grams[anchor[first]])
    out = {k: np.concatenate(v) if v else np.empty(0, U if k == "anchor" else np.int64) for k, v in found.items()}
    return out | {"row": row[out["at"]]}


def _segment_hashes(h: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    up, down = _power_tables(len(h) + 1)
    run = np.zeros(len(h) + 1, U)
    np.cumsum(mix(h ^ _B) * up[: len(h)], out=run[1:])
    return mix((run[at + n] - run[at]) * down[at] + n.astype(U) * _A)


def _anchors(window: int, gram: int):
    """Rows (anchor, n): how often each anchor of a task's texts occurs, in parts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                a, n = np.unique(np.concatenate(held), return_counts=True)
                held.clear()
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(n, pa.int64())], ["anchor", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                own = segments(*_hashes(*column_bytes(part.column("text"))), window, gram)["anchor"]
                held.append(own)
                many += len(own)
                if many > 1_000_000:
                    yield from flush()
                    many = 0
        yield from flush()
        release()

    return count


def _candidates(bitmap, window: int, gram: int):
    """Rows (d, t, at, n, anchor, sh, words): segments whose anchor is in the bitmap; words once for equal ones of a batch."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        slots = U(len(bits) * 64 - 1)
        for batch in batches:
            for part in slices(batch, "text"):
                h, row = _hashes(*column_bytes(part.column("text")))
                s = segments(h, row, window, gram)
                slot = s["anchor"] & slots
                keep = np.flatnonzero(bits[(slot >> U(6)).astype(np.int64)] >> (slot & U(63)) & U(1))
                if not len(keep):
                    continue
                at, n, anchor, row_ = (s[k][keep] for k in ("at", "n", "anchor", "row"))
                sh = _segment_hashes(h, at, n)
                _, first = np.unique(sh ^ mix(anchor), return_index=True)
                size = np.zeros(len(keep), np.int64)
                size[first] = n[first]
                ends = np.concatenate(([0], np.cumsum(size)))
                inner = np.arange(ends[-1]) - np.repeat(ends[:-1], size) + np.repeat(at, size)
                null = np.packbits(size > 0, bitorder="little").tobytes()
                text = pa.Array.from_buffers(pa.binary(), len(keep), [pa.py_buffer(null), pa.py_buffer((ends * 8).astype(np.int32).tobytes()), pa.py_buffer(h[inner].tobytes())])
                # places of words count from the first word of their document
                begins = np.searchsorted(row, np.arange(part.num_rows))
                rows = pa.array(row_)
                yield pa.RecordBatch.from_arrays(
                    [part.column("d").take(rows), part.column("t").take(rows), pa.array(at - begins[row_], pa.int64()), pa.array(n, pa.int32()), pa.array(anchor.view(np.int64)), pa.array(sh.view(np.int64)), text],
                    ["d", "t", "at", "n", "anchor", "sh", "words"],
                )
        release()

    return find


def _shard(window: int):
    """Rows (k1, k2, lo, hi): spans of a shard's items under repeated windows."""

    def judge(rows: pa.Table) -> pa.Table:
        automaton = SuffixAutomaton()
        items = [np.frombuffer(x, np.int64).tolist() for x in rows.column("words").to_pylist()]
        for words_, n in zip(items, rows.column("n").to_pylist()):
            automaton.add(words_, n)
        automaton.close()
        at, lo, hi = [], [], []
        for i, words_ in enumerate(items):
            for a, b in repeated_spans(automaton, words_, window):
                at.append(i)
                lo.append(a)
                hi.append(b)
        keys = pa.array(at, pa.int64())
        return pa.Table.from_arrays([rows.column("k1").take(keys), rows.column("k2").take(keys), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], ["k1", "k2", "lo", "hi"])

    return judge


def _bitmap(repeated: DataFrame, bits: int) -> np.ndarray:
    """One bit per slot that an anchor of ``repeated`` falls on; at most ``bits`` / 64 rows come to the driver."""
    word = repeated.select(F.col("anchor").bitwiseAND(F.lit(bits - 1)).alias("slot"))
    word = word.select(F.shiftright("slot", 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bit"))
    got = word.groupBy("w").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[got.column("w").to_numpy()] = got.column("bit").to_numpy()
    return out.view(U)


def _judged(items: DataFrame, words_in: int, window: int, shard_words: int) -> DataFrame:
    """Spans (k1, k2, lo, hi) of items (k1, k2, shard_key, n, words), dealt over shards of about ``shard_words`` words."""
    shards = max(1, -(-words_in // shard_words))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("shard_key"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(_shard(window), "k1 long, k2 long, lo int, hi int")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, filter_bits: int = 1 << 27, shard_words: int = 1 << 16, most_segments: int = 4096, most_broadcast: int = 100_000) -> DataFrame:
    """(d, t, spans): id, hash of the text, and spans [lo, hi) of words under repeated windows; staged.

    ``filter_bits`` (a power of two) bounds the bitmap; a fuller one costs shuffled segments, never results.  Hashes of words have
    64 bits, and segments are told apart by 128.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must be between 1 and window")
    spark = docs.sparkSession
    src = split_hint(docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("d"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text")))
    anchors = src.select("text").mapInArrow(_anchors(window, gram), "anchor long, n long")
    repeated = anchors.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    bitmap = spark.sparkContext.broadcast(_bitmap(repeated, filter_bits))
    kind = src.schema["d"].dataType.simpleString()
    occ = staged(src.mapInArrow(_candidates(bitmap, window, gram), f"d {kind}, t long, at long, n int, anchor long, sh long, words binary"), "segments")
    bitmap.destroy()

    words_in = occ.where("words is not null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = staged(occ.select("anchor", "sh").distinct().groupBy("anchor").agg(F.count("*").alias("many")).where(F.col("many") > most_segments).select("anchor"), "hot")
    some = hot.count()
    few = F.broadcast(hot) if some <= most_broadcast else hot
    cold = occ.join(few, "anchor", "left_anti") if some else occ
    items = cold.groupBy("anchor", "sh").agg(F.count("*").alias("n"), F.first("words", True).alias("words"))
    spans = _judged(items.select(F.col("anchor").alias("k1"), F.col("sh").alias("k2"), F.col("anchor").alias("shard_key"), "n", "words"), words_in, window, shard_words)
    spans = staged(spans, "spans")
    places = cold.select("d", "t", "at", F.col("anchor").alias("k1"), F.col("sh").alias("k2"))
    found = places.join(spans, ["k1", "k2"]).select("d", "t", (F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi")).alias("hi"))
    if some:
        # each window of these segments by itself; the words of a segment are given to all its occurrences
        own = occ.join(few, "anchor", "left_semi")
        texts = own.groupBy("anchor", "sh").agg(F.first("words", True).alias("words"), F.count("*").alias("n"))
        texts = texts.select("anchor", "sh", "n", F.posexplode(F.expr(f"transform(sequence(0, octet_length(words) div 8 - {window}), i -> substring(words, 8 * i + 1, {8 * window}))")).alias("j", "w"))
        texts = staged(texts.select("anchor", "sh", "n", "j", "w", F.xxhash64("w").alias("k1"), F.xxhash64(F.lit("second"), "w").alias("k2")), "windows")
        wins = texts.groupBy("k1", "k2").agg(F.sum("n").alias("n"), F.first("w").alias("words"))
        hit = _judged(wins.select("k1", "k2", F.struct("k1", "k2").alias("shard_key"), "n", "words"), window * texts.count(), window, shard_words).select("k1", "k2")
        hit = texts.select("anchor", "sh", "j", "k1", "k2").join(hit, ["k1", "k2"], "left_semi").groupBy("anchor", "sh").agg(F.collect_list("j").alias("js"))
        more = own.select("d", "t", "at", "anchor", "sh").join(hit, ["anchor", "sh"]).select("d", "t", F.explode(F.transform("js", lambda j: F.struct((F.col("at") + j).alias("lo"), (F.col("at") + j + window).alias("hi")))).alias("s"))
        found = found.union(more.select("d", "t", "s.lo", "s.hi"))
    out = staged(found.groupBy("d", "t").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "passages")
    forget(spark, occ, hot, spans, *([texts] if some else []))
    return out


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def kept_words(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The words outside of ``spans`` (united) joined by one space; numbers of all words and of those removed."""
    out, n, k = [], 0, 0
    data = np.frombuffer(text, np.uint8)
    for a, b in _cuts(data, _PIECE):
        own = text[a:b].split()
        lo = 0
        while k < len(spans) and spans[k][0] < n + len(own):
            out.extend(own[lo : max(spans[k][0] - n, 0)])
            lo = min(spans[k][1] - n, len(own))
            if spans[k][1] > n + len(own):
                break
            k += 1
        out.extend(own[lo:])
        n += len(own)
        if len(out) > 1:
            out = [b" ".join(out)]
    return b" ".join(out), n, sum(hi - lo for lo, hi in spans)


_CUT = "id {kind}, text string, spans array<struct<lo:long,hi:long>>, n_words long, n_removed long, sha string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pair = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    for batch in batches:
        for part in slices(batch, "text"):
            data, off = column_bytes(part.column("text"))
            texts, spans, n, gone, sha = [], [], [], [], []
            nulls = part.column("text").is_null().to_pylist()
            for i, own in enumerate(part.column("spans").to_pylist()):
                merged = _united([(s["lo"], s["hi"]) for s in own or ()])
                text, many, out = kept_words(data[off[i] : off[i + 1]].tobytes(), merged)
                texts.append(None if nulls[i] else text)
                spans.append([{"lo": a, "hi": b} for a, b in merged])
                n.append(many)
                gone.append(out)
                sha.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(spans, pair), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], ["id", "text", "spans", "n_words", "n_removed", "sha"])
    release()


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, text, spans, n_words, n_removed, kept_sha256), a row per row of ``docs``; id and text under their own names.

    ``text`` is the words that stay, joined by one space; ``spans`` are the places [lo, hi) of the words removed.  Words are runs of
    bytes that aren't ASCII white space.  A null text stays null, without words; its digest is that of no words, as for an
    empty text.  A text of fewer words than the window loses none.  Repeated rows are documents of their own, so they lose all
    that a window covers; rows with equal or null ids are judged by their own texts.  An empty table gives an empty
    result; further columns aren't read.  Texts of any length are read in pieces.
    """
    found = repeated_passages(docs, id_col, text_col, **how).select(F.col("d").alias("d_"), F.col("t").alias("t_"), "spans")
    src = split_hint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("t")))
    joined = src.join(found, F.col("id").eqNullSafe(F.col("d_")) & (F.col("t") == F.col("t_")), "left").select("id", "text", "spans")
    out = joined.mapInArrow(_cut, _CUT.format(kind=src.schema["id"].dataType.simpleString()))
    return out.select(F.col("id").alias(id_col), F.col("text").alias(text_col if text_col != id_col else free_name(out, "kept")), "spans", "n_words", "n_removed", F.col("sha").alias("kept_sha256"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), win AS (
  SELECT r, i, array_to_string(list_slice(w, i, i + 34), ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
), again AS (
  SELECT r, i FROM win JOIN (SELECT s FROM win GROUP BY s HAVING count(*) > 1) USING (s)
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM again
), word AS (
  SELECT r, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS x FROM d
), stay AS (
  SELECT word.r, string_agg(x, ' ' ORDER BY word.j) AS text, count(*) AS n FROM word LEFT JOIN gone ON gone.r = word.r AND gone.j = word.j WHERE gone.r IS NULL GROUP BY word.r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN stay ON stay.r = d.r
"""
