"""SentencePiece encoding and decoding: distinct sampled segmentations of whole texts.

The lattice of a text holds every way to cut it into pieces of a given vocabulary; characters that
no piece covers become byte pieces.  A piece of rank r weighs ``(r + 10) ** -theta`` (Zipf's law:
the vocabulary's scores are ranks), and a segmentation has the product of its pieces' weights over
the sum of all segmentations' as its probability.

No piece holds white space after another character, so the lattice falls into units that begin
with white space, most of them words.  Per worker and distinct unit the backward sums give each
lattice node's distribution over its next piece; whole texts are then walked in numpy, all units
of many texts at once.

``samples`` segmentations without replacement come from A* search over Gumbel-perturbed
probabilities.  A node of the search tree is a prefix of pieces, its bound the largest perturbed
log-probability below it.  The root's is a Gumbel variable; the bound goes on to the next piece
drawn from the node's distribution, and the other pieces together get a Gumbel variable truncated
at that bound, with the log of their mass as its location.  The search pops the open node of
largest bound until it has ``samples`` leaves; the next bound ``kappa`` gives each sample its
inclusion score ``log(1 - exp(-exp(log_prob - kappa)))``, for unbiased sums over segmentations.
A node so deep that its bound can't exceed an open one isn't drawn, as 53-bit uniforms give no
Gumbel variable over 37.

All randomness is a hash of (seed, row key, sample, unit, step), so a row has the same samples in
whatever batch, partition or attempt it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.llm.common import free_name, others, quoted, split_hint, table
from quiremill.llm.texthash import U, mix, release, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Stands for a SPACE character of the text itself, which is encoded as bytes.
_STAND_IN = "\ud800"
_FALLBACK = -25.0
#: Units whose lattices a worker keeps: some 0.6 KB each.  A slice of texts can add its own to so many.
CACHE_UNITS = 40_000
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_BY_UNIT, _BY_STEP = U(0xD1342543DE82EF95), U(0xAF251AF3B0F025B5)
#: No Gumbel variable made from a 53-bit uniform is larger.
_MOST = 37.0
_models: dict[tuple, "Lattices"] = {}
_tables = {"up": np.empty(0, U), "down": np.empty(0, U), "code": np.empty(0, U)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses, at least ``n`` of them."""
    if len(_tables["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            x = np.full(max(n, 1 << 18), base & (2**64 - 1), U)
            x[0] = 1
            _tables[name] = np.multiply.accumulate(x)
        _tables["code"] = mix(np.arange(1, 0x110001, dtype=U))
    return _tables["up"], _tables["down"]


def _hashes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums from which the hash of any stretch follows, and the factors for its start."""
    up, down = _powers(len(codes) + 1)
    run = np.zeros(len(codes) + 1, U)
    np.cumsum(_tables["code"][codes] * up[: len(codes)], out=run[1:])
    return run, down


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class _Column:
    """An array that grows at its end; ``x`` is what it holds."""

    def __init__(self, dtype):
        self.room, self.x = np.empty(1024, dtype), np.empty(0, dtype)

    def add(self, more: np.ndarray) -> None:
        n = len(self.x)
        if n + len(more) > len(self.room):
            room = np.empty(max(2 * len(self.room), n + len(more)), self.room.dtype)
            room[:n] = self.x
            self.room = room
        self.room[n : n + len(more)] = more
        self.x = self.room[: n + len(more)]


class _Numbers:
    """Numbers by 64-bit hash: open addressing, at most a quarter full."""

    def __init__(self, bits: int):
        self.bits = bits
        self.key, self.no, self.used = np.zeros(1 << bits, U), np.full(1 << bits, -1, np.int32), np.zeros(1 << bits, bool)
        self.held = 0

    def put(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Add distinct hashes that aren't held yet."""
        while 4 * (self.held + len(keys)) > len(self.no):
            old, wider = self, _Numbers(self.bits + 2)
            at = np.flatnonzero(old.used)
            wider.put(old.key[at], old.no[at])
            self.__dict__ = wider.__dict__
        at, go = (keys >> U(64 - self.bits)).astype(np.int64), np.arange(len(keys))
        while len(go):
            free = go[~self.used[at[go]]]
            self.no[at[free]] = numbers[free]  # of several in one place the last one stays
            mine = free[self.no[at[free]] == numbers[free]]
            self.key[at[mine]], self.used[at[mine]] = keys[mine], True
            left = np.ones(len(keys), bool)
            left[mine] = False
            go = go[left[go]]
            at[go] = (at[go] + 1) & (len(self.no) - 1)
        self.held += len(keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of these hashes, -1 for none."""
        at = (keys >> U(64 - self.bits)).astype(np.int64)
        out = np.full(len(keys), -1, np.int64)
        go = np.flatnonzero(self.used[at])
        at = at[go]
        while len(go):
            same = self.key[at] == keys[go]
            out[go[same]] = self.no[at[same]]
            at = (at[~same] + 1) & (len(self.no) - 1)
            go = go[~same]
            some = self.used[at]
            at, go = at[some], go[some]
        return out


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start[0], start[0] + 1, ...``, ``size[0]`` of them, then those of the next."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Lattices:
    """The vocabulary, and the lattices of the units seen lately."""

    def __init__(self, path: str, theta: float):
        import sentencepiece

        self.most = CACHE_UNITS
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.byte_id = np.zeros(256, np.int64)
        spell: list[bytes] = []
        ids = []  # of the pieces that a lattice can hold
        rank = 0
        logp = np.full(size, -np.inf)
        for i, name in enumerate(names):
            if model.is_byte(i):
                self.byte_id[int(name[1:-1], 16)] = i
                spell.append(bytes([int(name[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                spell.append(b"")
            else:
                logp[i] = -theta * np.log(rank + 10.0)
                rank += 1
                ids.append(i)
                spell.append(name.replace(SPACE, " ").encode())
        self.size = size
        usual = np.isfinite(logp)
        logp[usual] -= np.log(np.exp(logp[usual]).sum())
        self.pieces = _Numbers(17)
        size = np.array([len(names[i]) for i in ids])
        end = np.cumsum(size)
        run, down = _hashes(_codes("".join(names[i] for i in ids)))
        self.pieces.put((run[end] - run[end - size]) * down[end - size], np.array(ids, np.int32))
        self.longest = int(size.max())
        self.weight = np.append(logp, _FALLBACK)  # of pieces, and of a character in bytes
        #: Units of at most so many characters have no segmentation whose weight underflows.
        self.plain = int(700 / -min(_FALLBACK, logp[usual].min()))
        self.spell = np.frombuffer(b"".join(spell), np.uint8)
        self.spell_at = np.concatenate(([0], np.cumsum([len(x) for x in spell])))
        self.clear()

    def clear(self) -> None:
        self.unit = _Numbers(16)
        self.columns = {
            "start": _Column(np.int64),  # first node of each unit
            "first": _Column(np.int32),  # first edge of each node, and one more entry at the end
            "final": _Column(bool),  # nodes at a unit's end
            "cum": _Column(np.float32),  # of each edge: sum of probabilities up to it at its node,
            "logq": _Column(np.float32),  # its own logarithm,
            "rest": _Column(np.float32),  # that of the others at its node, -inf without others,
            "next": _Column(np.int32),  # the node it leads to
            "piece": _Column(np.int32),  # and its piece
        }
        self.columns["first"].add(np.zeros(1, np.int64))
        self._share()

    def _share(self) -> None:
        for name, c in self.columns.items():
            setattr(self, name, c.x)

    def unit_ids(self, units: list[str]) -> np.ndarray:
        """Numbers of units given without the blank in front."""
        size = np.fromiter(map(len, units), np.int64, len(units)) + 1
        end = np.cumsum(size)
        return self.numbers(_codes("".join(SPACE + u for u in units)), end - size, end)

    def numbers(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of the units that stand in ``codes`` from ``start`` to ``end``; new ones get a lattice."""
        run, down = _hashes(codes)
        keys = (run[end] - run[start]) * down[start]
        out = self.unit.find(keys)
        at = np.flatnonzero(out < 0)
        if len(at):
            if self.unit.held > self.most:
                self.clear()
                at = np.arange(len(keys))
            _, new = np.unique(keys[at], return_index=True)
            self._add(codes, start[at[new]], end[at[new]], keys[at[new]])
            out[at] = self.unit.find(keys[at])
        return out

    def _add(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray) -> None:
        """Lattices of new units, those of like length together, some 30,000 characters at a time."""
        size = end - start
        order = np.argsort(size, kind="stable")
        start, size, keys = start[order], size[order], keys[order]
        run = np.cumsum(size)
        lo, plain = 0, int(np.searchsorted(size, self.plain, "right"))
        while lo < len(size):
            hi = max(lo + 1, int(np.searchsorted(run, run[lo] - size[lo] + 30_000, "right")))
            if lo < plain < hi:
                hi = plain
            self._build(codes[_ragged(start[lo:hi], size[lo:hi])], size[lo:hi], lo >= plain)
            self.unit.put(keys[lo:hi], np.arange(len(self.start) - (hi - lo), len(self.start), dtype=np.int32))
            lo = hi

    def _build(self, codes: np.ndarray, size: np.ndarray, logs: bool) -> None:
        """Edges of each node from the longest piece down; backward sums from the units' ends, as logarithms if ``logs``."""
        n, units = len(codes), len(size)
        end = np.cumsum(size)
        left = np.repeat(end, size) - np.arange(n)  # characters up to the unit's end
        run, down = _hashes(codes)
        node = np.arange(n) + np.repeat(np.arange(units), size)  # of a unit: one before each character and one at its end
        degree = np.zeros(n + units, np.int64)
        found, at = [], np.arange(n)
        for k in range(1, int(min(self.longest, left.max())) + 1):
            at = at[left[at] >= k] if k > 1 else at
            piece = self.pieces.find((run[at + k] - run[at]) * down[at])
            if k == 1:
                bare = np.flatnonzero(piece < 0)
                piece[bare] = self.size + codes[bare].astype(np.int64)  # beyond the vocabulary: a character in bytes
                hit = at
            else:
                hit = at[piece >= 0]
                piece = piece[piece >= 0]
            degree[node[hit]] += 1
            found.append((k, hit, piece))
        first = np.concatenate(([0], np.cumsum(degree)))
        edges = int(first[-1])
        src, to, p, gap, room = np.empty(edges, np.int64), np.empty(edges, np.int64), np.empty(edges, np.int64), np.empty(edges, np.int64), first[:-1].copy()
        for k, hit, piece in reversed(found):
            x = node[hit]
            e = room[x]
            room[x] = e + 1
            src[e], to[e], p[e], gap[e] = x, x + k, piece, left[hit]
        w = self.weight[np.minimum(p, self.size)]
        # nearest to the unit's end first, each node's edges side by side
        order = np.argsort(gap.astype(np.uint16) if gap.max(initial=0) < 1 << 16 else gap, kind="stable")
        x, y, v = src[order], to[order], (w if logs else np.exp(w))[order]
        heads = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
        cut = np.append(np.flatnonzero(np.concatenate(([True], np.diff(gap[order[heads]]) != 0))), len(heads))
        edge_of, beta = np.append(heads, edges), np.full(n + units, 0.0 if logs else 1.0)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            lo, hi = edge_of[a], edge_of[b]
            at = heads[a:b] - lo
            if logs:
                sums = v[lo:hi] + beta[y[lo:hi]]
                top = np.maximum.reduceat(sums, at)
                beta[x[heads[a:b]]] = top + np.log(np.add.reduceat(np.exp(sums - np.repeat(top, np.diff(np.append(at, hi - lo)))), at))
            else:
                beta[x[heads[a:b]]] = np.add.reduceat(v[lo:hi] * beta[y[lo:hi]], at)
        if logs:
            logq = w + beta[to] - beta[src]
            q = np.exp(logq)
        else:
            beta = np.log(beta)
            logq = w + beta[to] - beta[src]
            q = np.exp(logq)
        # sums of probabilities up to each edge of its node, by place at the node: no other unit has a part in them
        cum, some = q.copy(), np.flatnonzero(degree > 1)
        e = first[some]
        while len(some):
            cum[e + 1] += cum[e]
            e += 1
            go = e + 1 < first[some + 1]
            some, e = some[go], e[go]
        cum[first[1:][degree > 0] - 1] = 2.0  # whatever the rounding, the last piece ends the search
        final = np.zeros(n + units, bool)
        final[end + np.arange(units)] = True
        # the others' mass: 1 - q, or their sum where that would cancel
        rest = 1 - q
        near = np.flatnonzero((rest < 1e-9) & (degree[src] > 1))
        if len(near):
            others = q.copy()
            others[near] = 0
            whole = np.flatnonzero(degree)
            mass = np.zeros(n + units)
            mass[whole] = np.add.reduceat(others, first[whole])
            rest[near] = mass[src[near]]
        with np.errstate(divide="ignore"):
            rest = np.where(degree[src] == 1, -np.inf, np.log(np.maximum(rest, 1e-300)))
        edge_base, base = len(self.next), len(self.final)
        grown = self.columns
        grown["first"].add(edge_base + first[1:])
        grown["start"].add(base + end - size + np.arange(units))
        for name, more in (("cum", cum), ("logq", logq), ("rest", rest), ("next", base + to), ("piece", p), ("final", final)):
            grown[name].add(more)
        self._share()

    def out_ids(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vocabulary ids, characters without piece as their bytes; and how many ids each has."""
        bare = np.flatnonzero(pieces >= self.size)
        if not len(bare):
            return pieces, np.ones(len(pieces), np.int64)
        raw = [(SPACE if c == ord(_STAND_IN) else chr(c)).encode("utf-8", "replace") for c in (pieces[bare] - self.size).tolist()]
        each = np.ones(len(pieces), np.int64)
        each[bare] = [len(r) for r in raw]
        out = np.repeat(pieces, each)
        out[out >= self.size] = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        return out, each

    def decode(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 of each row of ids, without the first blank; bytes and offsets."""
        each = self.spell_at[ids + 1] - self.spell_at[ids]
        run = np.concatenate(([0], np.cumsum(each)))
        data = self.spell[np.repeat(self.spell_at[ids] - run[:-1], each) + np.arange(run[-1])]
        at = run[off]
        keep = np.ones(len(data), bool)
        keep[at[:-1][at[1:] > at[:-1]]] = False
        return data[keep], np.concatenate(([0], np.cumsum(np.maximum(np.diff(at) - 1, 0))))


def lattices(path: str = MODEL, theta: float = 1.0, cache_units: int = CACHE_UNITS) -> Lattices:
    if (path, theta) not in _models:
        _models[path, theta] = Lattices(path, theta)
    _models[path, theta].most = cache_units
    return _models[path, theta]


def _units(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the texts, each with a blank in front; where units start and end in them; each text's first unit.

    A unit is one or more blanks and what follows up to the next; a line break stays within its
    unit, as no piece holds one.
    """
    codes = _codes("".join(" " + t for t in texts)).copy()
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    at = np.cumsum(size) - size
    blank = codes == 0x20
    first = blank.copy()
    first[1:] &= ~blank[:-1]
    first[at] = True
    codes[codes == ord(SPACE)] = ord(_STAND_IN)
    codes[blank] = ord(SPACE)
    start = np.flatnonzero(first)
    return codes, start, np.append(start[1:], len(codes)), np.append(np.searchsorted(start, at), len(start))


def _uniform(seed: np.ndarray, stream: int, unit: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Uniforms in (0, 1) that are a function of their arguments."""
    return _spread(seed + unit.astype(U) * _BY_UNIT, stream, step)


def _spread(base: np.ndarray, stream: int, step: np.ndarray) -> np.ndarray:
    x = mix(base + (step.astype(U) * _BY_STEP + U(stream * 0x9FB21C651E98DF25 & (2**64 - 1))))
    return ((x >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


def _gumbel_below(loc: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables at ``loc``, conditioned on being below ``bound``."""
    with np.errstate(over="ignore"):
        return loc - np.log(np.exp(np.minimum(loc - bound, 700.0)) - np.log(u))


def _walk(lat: Lattices, at: np.ndarray, cur: np.ndarray, k: np.ndarray, base: np.ndarray, stream: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Draw pieces of units ``at``, from nodes ``cur`` and steps ``k`` to their ends: (unit, step, edge) of all."""
    us, ss, es = [at[:0]], [k[:0]], [at[:0]]
    go = ~lat.final[cur]
    at, cur, k = at[go], cur[go], k[go]
    while len(at):
        u = _spread(base[at], stream, k)
        e = lat.first[cur].astype(np.int64)
        on = np.flatnonzero(u >= lat.cum[e])
        while len(on):
            e[on] += 1
            on = on[u[on] >= lat.cum[e[on]]]
        us.append(at)
        ss.append(k)
        es.append(e)
        cur = lat.next[e]
        go = ~lat.final[cur]
        at, cur, k = at[go], cur[go], k[go] + 1
    return np.concatenate(us), np.concatenate(ss), np.concatenate(es)


class _Round:
    """One sampled segmentation of each of some texts: edges, and the bounds of what they left open.

    ``text``: the texts' numbers; ``off``: their first places; ``edge``, ``unit``, ``step``: by
    place; ``bound``: the samples' own bounds; ``free``: alternatives before these places were left
    open by the samples they come from.
    """

    def __init__(self, lat, seeds, stream, text, off, edge, unit, step, bound, free):
        self.lat, self.seeds, self.stream, self.text, self.off, self.edge, self.unit, self.step, self.bound = lat, seeds, stream, text, off, edge, unit, step, bound
        logq = lat.logq[edge].astype(np.float64)
        after = np.empty(len(edge))
        for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            np.cumsum(logq[a:b], out=after[a:b])
        self.total = after[off[1:] - 1]
        self.phi = np.empty(len(edge))
        self.phi[1:] = after[:-1]
        self.phi[off[:-1]] = 0.0
        self.open = np.full(len(edge), -np.inf)
        self.free = off[:-1] + free
        self.drawn = self.free.copy()
        self.best = np.full(len(text), -np.inf)
        self.gone: dict[int, list[int]] = {}

    def draw(self, rows: np.ndarray) -> None:
        """Bounds of the alternatives of these rows at each place that can exceed the best, 64 places and more at a time."""
        most = 32
        while len(rows):
            most *= 2
            rows = rows[self.drawn[rows] < self.off[rows + 1]]
            rows = rows[self.phi[self.drawn[rows]] + _MOST > self.best[rows]]
            if not len(rows):
                return
            size = np.minimum(self.off[rows + 1] - self.drawn[rows], most)
            at = _ragged(self.drawn[rows], size)
            u = _uniform(np.repeat(self.seeds[self.text[rows]], size), 1000 + self.stream, self.unit[at], self.step[at])
            self.open[at] = _gumbel_below(self.phi[at] + self.lat.rest[self.edge[at]], np.repeat(self.bound[rows], size), u)
            self.best[rows] = np.maximum(self.best[rows], np.maximum.reduceat(self.open[at], np.cumsum(size) - size))
            self.drawn[rows] += size

    def place(self, rows: np.ndarray) -> np.ndarray:
        """The first place of each row whose bound is the best."""
        size = self.drawn[rows] - self.free[rows]
        at, row = _ragged(self.free[rows], size), np.repeat(np.arange(len(rows)), size)
        top = self.open[at] == self.best[rows][row]
        _, first = np.unique(row[top], return_index=True)
        return at[top][first]

    def lower(self, rows: np.ndarray, place: np.ndarray, bound: np.ndarray) -> None:
        self.open[place] = bound
        size = self.drawn[rows] - self.free[rows]
        self.best[rows] = np.maximum.reduceat(self.open[_ragged(self.free[rows], size)], np.cumsum(size) - size)


def _alternatives(lat: Lattices, r: _Round, place: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """At each place an edge that none of the samples took, and the bound of those still left."""
    node = lat.first.searchsorted(r.edge[place].astype(np.int32), "right") - 1
    low = lat.first[node].astype(np.int64)
    size = lat.first[node + 1] - low
    at = np.cumsum(size) - size
    taken = [r.gone.setdefault(p, [e]) for p, e in zip(place.tolist(), r.edge[place].tolist(), strict=True)]
    many = np.array([len(x) for x in taken])
    mass = np.exp(lat.logq[_ragged(low, size)].astype(np.float64))
    mass[np.repeat(at - low, many) + np.array([e for x in taken for e in x])] = 0
    run = np.cumsum(mass)
    under = run[at] - mass[at]
    row = np.repeat(np.arange(len(place)), size)
    seed = np.repeat(r.seeds[r.text], np.diff(r.off))[place] if len(place) > len(r.text) // 8 else r.seeds[r.text[np.searchsorted(r.off, place, "right") - 1]]
    u = _uniform(seed, 2000 + k, r.unit[place], r.step[place])
    want = under + u * (run[at + size - 1] - under)
    far = np.flatnonzero((run >= want[row]) & (mass > 0))
    _, first = np.unique(row[far], return_index=True)
    pick = far[first]
    new = low + pick - at
    for x, e in zip(taken, new.tolist(), strict=True):
        x.append(e)
    mass[pick] = 0
    left = np.add.reduceat(mass, at)
    u = _uniform(seed, 3000 + k, r.unit[place], r.step[place])
    open_ = _gumbel_below(r.phi[place] + np.log(np.maximum(left, 1e-300)), bound, u)
    return new, np.where(many + 1 < size, open_, -np.inf)


def _sample(texts: list[str], keys: np.ndarray, lat: Lattices, samples: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Samples, text by text: number of their text, log-probability, log inclusion, pieces of all and each one's first."""
    codes, start, end, unit_off = _units(texts)
    wid = lat.numbers(codes, start, end)
    n, every = len(wid), np.arange(len(texts))
    text_of = np.repeat(every, np.diff(unit_off))
    unit_no = np.arange(n) - unit_off[text_of]
    row_seed = mix(keys.astype(np.int64).view(U) * U(0xA24BAED4963EE407) + U(seed))
    base = row_seed[text_of] + unit_no.astype(U) * _BY_UNIT
    node = lat.start[wid]

    def joined(text, units, first_step, walked, heads, stream, bound, free) -> _Round:
        """A round of heads (edges, units, steps, sizes), each followed by what was walked of ``units`` units from there on."""
        us, ss, es = walked
        count = np.bincount(us, minlength=n)
        run = np.concatenate(([0], np.cumsum(count)))
        edge, unit, step, size = heads
        done = unit_off[text + 1]
        off = np.concatenate(([0], np.cumsum(size + run[done] - run[done - units])))
        whole = np.empty((3, off[-1]), np.int64)
        whole[:, _ragged(off[:-1], size)] = edge, unit, step
        to = np.zeros(n, np.int64)
        at = _ragged(done - units, units)
        to[at] = np.repeat(off[:-1] + size - run[done - units], units) + run[at]
        to[done - units] -= first_step
        place = to[us] + ss
        whole[0, place], whole[1, place], whole[2, place] = es, unit_no[us], ss
        return _Round(lat, row_seed, stream, text, off, *whole, bound, free)

    none = np.empty(0, np.int64)
    zero = np.zeros(len(texts), np.int64)
    root = -np.log(-np.log(_uniform(row_seed, 999, zero, zero)))
    walked = _walk(lat, np.arange(n), node, np.zeros(n, np.int64), base, 0)
    rounds = [joined(every, np.diff(unit_off), zero, walked, (none, none, none, zero), 0, root, zero)]
    kappa, going = np.full(len(texts), -np.inf), every
    for k in range(1, samples + 1):
        best, source = np.full(len(texts), -np.inf), np.zeros(len(texts), np.int64)
        for i, r in enumerate(rounds):
            rows = np.flatnonzero(np.isin(r.text, going)) if len(going) < len(r.text) else np.arange(len(r.text))
            r.draw(rows)
            more = rows[r.best[rows] > best[r.text[rows]]]
            best[r.text[more]], source[r.text[more]] = r.best[more], i
        kappa[going] = best[going]
        going = going[best[going] > -np.inf]
        if k == samples or not len(going):
            break
        at, cur, steps, head = going * 0, going * 0, going * 0, going * 0
        parts: list = [None] * len(rounds)
        taken = going * 0
        for i, r in enumerate(rounds):
            mine = np.flatnonzero(source[going] == i)
            if not len(mine):
                continue
            rows = np.searchsorted(r.text, going[mine])
            place = r.place(rows)
            new, open_ = _alternatives(lat, r, place, best[going[mine]], k)
            r.lower(rows, place, open_)
            at[mine], cur[mine], steps[mine], head[mine], taken[mine] = unit_off[going[mine]] + r.unit[place], lat.next[new], r.step[place] + 1, place - r.off[rows] + 1, new
            parts[i] = (r, mine, r.off[rows])
        off = np.concatenate(([0], np.cumsum(head)))
        heads = np.empty((3, off[-1]), np.int64)
        for part in parts:
            if part:
                r, mine, low = part
                src, dst = _ragged(low, head[mine]), _ragged(off[:-1][mine], head[mine])
                heads[:, dst] = r.edge[src], r.unit[src], r.step[src]
        heads[0, off[1:] - 1] = taken
        units = unit_off[going + 1] - at
        live = _ragged(at, units)
        begin, step = node[live], np.zeros(len(live), np.int64)
        here = np.cumsum(units) - units
        begin[here], step[here] = cur, steps
        walked = _walk(lat, live, begin, step, base, k)
        rounds.append(joined(going, units, steps, walked, (*heads, head), k, best[going], head))
    text = np.concatenate([r.text for r in rounds])
    order = np.argsort(text, kind="stable")
    size = np.concatenate([np.diff(r.off) for r in rounds])
    off = np.concatenate(([0], np.cumsum(size[order])))
    place = np.empty(len(text), np.int64)
    place[order] = off[:-1]
    pieces = np.empty(off[-1], np.int64)
    pieces[_ragged(place, size)] = lat.piece[np.concatenate([r.edge for r in rounds])]
    phi = np.concatenate([r.total for r in rounds])
    d = phi - kappa[text]
    with np.errstate(over="ignore", divide="ignore"):
        score = np.where(d > 700, 0.0, np.where(d < -30, d, np.log(-np.expm1(-np.exp(np.clip(d, -30, 700))))))
    return text[order], phi[order], score[order], pieces, off


def sample_texts(texts: list[str], keys: np.ndarray, lat: Lattices, samples: int, seed: int) -> list[list[tuple[np.ndarray, float, float]]]:
    """For each text up to ``samples`` (pieces, log-probability, log inclusion), largest bound first."""
    text, phi, score, pieces, off = _sample(texts, keys, lat, samples, seed)
    out: list[list] = [[] for _ in texts]
    for i, t in enumerate(text.tolist()):
        out[t].append((pieces[off[i] : off[i + 1]], float(phi[i]), float(score[i])))
    return out


def _encode(samples: int, path: str, theta: float, seed: int, cache_units: int):
    """(i, text): per text a list of samples, each (ids, log_prob, log_inclusion, round_trip)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattices(path, theta, cache_units)
        for batch in batches:
            for part in slices(batch, "t", 1 << 19):
                texts = part.column(1).to_pylist()
                have = [t for t in texts if t is not None]
                null = np.array([t is None for t in texts], bool)
                keys = part.column(0).fill_null(-1).to_numpy()[~null]
                each = np.zeros(len(texts), np.int64)
                if have:
                    text, phi, score, pieces, lens = _sample(have, keys, lat, samples, seed)
                    each[~null] = np.bincount(text, minlength=len(have))
                else:
                    text, phi, score, pieces, lens = np.empty(0, np.int64), np.empty(0), np.empty(0), np.empty(0, np.int64), np.zeros(1, np.int64)
                ids, wide = lat.out_ids(pieces)
                off = np.concatenate(([0], np.cumsum(wide)))[lens]
                back, at = lat.decode(ids, off)
                raw, src = back.tobytes(), [t.encode() for t in have]
                same = [raw[a:b] == src[t] for a, b, t in zip(at[:-1].tolist(), at[1:].tolist(), text.tolist(), strict=True)]
                structs = pa.StructArray.from_arrays(
                    [pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids.astype(np.int32))), pa.array(phi), pa.array(score), pa.array(same, pa.bool_())],
                    ["ids", "log_prob", "log_inclusion", "round_trip"],
                )
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(each))).astype(np.int32)), structs, mask=pa.array(null))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "samples"])
        if cache_units <= CACHE_UNITS:
            lat.clear()
        release()

    return run


SAMPLES = "array<struct<ids: array<int>, log_prob: double, log_inclusion: double, round_trip: boolean>>"


def encode_samples(docs: DataFrame, samples: int = 2, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, theta: float = 1.0, seed: int = 11, cache_units: int = CACHE_UNITS) -> DataFrame:
    """``docs`` with ``samples``: up to so many distinct segmentations of each whole text.

    A column of that name is replaced, further ones are kept.  A text has fewer samples if it has
    fewer segmentations: an empty one has one, the blank that every text begins with.  A null text
    has null samples.  Rows with equal ids and texts get equal samples; a null id counts as -1.
    ``cache_units`` trades a worker's memory for time and changes no result; a cache of more than the
    default is kept for the worker's next task.
    ``round_trip`` says whether decoding the ids gives the text again; it always does.
    """
    keep = others(docs, "samples")
    # rows travel with the text and the key under names of their own
    rest = {c: f"c{i}" for i, c in enumerate(keep) if c != text_col}
    src = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"), *[F.col(quoted(c)).alias(name) for c, name in rest.items()])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields)
    out = split_hint(src, 1 << 18).mapInArrow(_encode(samples, model, theta, seed, cache_units), f"{ddl}, `samples` {SAMPLES}")
    return out.select(*[F.col(rest.get(c, "t")).alias(c) for c in keep], "samples")


def decode_ids(df: DataFrame, ids_col: str = "ids", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``df`` with the text of each row's ids; null ids give null, bytes that aren't UTF-8 U+FFFD."""
    keep = [c for c in df.columns if c != text_col]
    src = df.select(*keep)
    name = free_name(src, "decoded_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattices(model)
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            off = np.concatenate(([0], np.cumsum([len(r or ()) for r in rows])))
            data, at = lat.decode(np.array([x for r in rows for x in r or ()], np.int64), off)
            raw = data.tobytes()
            text = [None if r is None else raw[a:b].decode("utf-8", "replace") for r, a, b in zip(rows, at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], [*batch.schema.names, name])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields)
    out = split_hint(src).mapInArrow(run, f"{ddl}, `{name}` string")
    return out.select(*keep, F.col(name).alias(text_col))


def op10_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and sample: number of ids, scores, a hash of the ids, and the round trip."""
    out = encode_samples(table(spark, sf_dir, "documents").select("doc_id", "text"), cache_units=500_000)
    rows = out.select("doc_id", F.posexplode("samples").alias("sample", "s"))
    return rows.select("doc_id", "sample", F.size("s.ids").alias("n_ids"), "s.log_prob", "s.log_inclusion", F.xxhash64("s.ids").alias("ids_hash"), "s.round_trip")
