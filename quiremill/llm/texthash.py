"""Vectorised hashing of texts: numpy over the bytes of an Arrow column, no per-word Python."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_POWER = (0x9E3779B97F4A7C15 | 1) & (2**64 - 1)
_INVERSE = pow(_POWER, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = {"n": 0, "up": np.empty(0, U), "down": np.empty(0, U)}


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=U) * U(_POWER))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        n = max(n, 1 << 20)
        for key, base in (("up", _POWER), ("down", _INVERSE)):
            x = np.full(n, base, U)
            x[0] = 1
            _powers[key] = np.multiply.accumulate(x)
        _powers["n"] = n
    return _powers["up"], _powers["down"]


def release() -> None:
    """Give freed memory back to the system at a task's end: a worker lives on through other stages."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    if col.null_count:
        col = col.fill_null("")
    if pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
        off = np.frombuffer(col.buffers()[1], np.int64)
    else:
        col = col.cast(pa.string())
        off = np.frombuffer(col.buffers()[1], np.int32)
    off = off[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str, target: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about ``target`` bytes together; a longer text stands alone."""
    _, off = column_bytes(batch.column(batch.schema.get_field_index(text)))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + target, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def words(data: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word (a run of bytes that aren't ASCII white space) and its row.

    ``hash = mix(sum(T[byte_i] * P**i))`` over the word, from differences of one running sum.
    """
    if not len(data):
        return np.empty(0, U), np.empty(0, np.int64)
    if lower:
        data = _LOWER[data]
    ink = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[off[:-1]] = True
    first = first[:-1]
    starts = np.flatnonzero(ink & (first | ~np.concatenate(([False], ink[:-1]))))
    last = np.zeros(len(data) + 1, bool)
    last[off[1:]] = True
    ends = np.flatnonzero(ink & (last[1:] | ~np.concatenate((ink[1:], [False])))) + 1
    up, down = _power_tables(len(data) + 1)
    run = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTE[data] * up[: len(data)], out=run[1:])
    h = mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))
    return h, np.searchsorted(off, starts, "right") - 1


def prefixes(data: np.ndarray, off: np.ndarray, lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the first bytes, so many as each of ``lengths`` says, of the words that are longer; and their rows."""
    if not len(data):
        return np.empty(0, U), np.empty(0, np.int64)
    data = _LOWER[data]
    ink = ~_SPACE[data]
    first, last = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    first[off[:-1]] = last[off[1:]] = True
    starts = np.flatnonzero(ink & (first[:-1] | ~np.concatenate(([False], ink[:-1]))))
    size = np.flatnonzero(ink & (last[1:] | ~np.concatenate((ink[1:], [False])))) + 1 - starts
    up, down = _power_tables(len(data) + 1)
    run = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTE[data] * up[: len(data)], out=run[1:])
    keys, at = [], []
    for k in lengths:
        own = starts[size > k]
        keys.append(mix((run[own + k] - run[own]) * down[own] + U(k * 0xD6E8FEB86659FD95 & (2**64 - 1))))
        at.append(own)
    return np.concatenate(keys), np.searchsorted(off, np.concatenate(at), "right") - 1


def shingles(h: np.ndarray, row: np.ndarray, rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each row: sorted hashes, one row after another, and offsets.

    A row with one to k-1 words has its whole sequence as its one shingle; one without words, none.
    """
    n = np.bincount(row, minlength=rows)
    at = np.concatenate(([0], np.cumsum(n)))
    # The hash is a sum over the words by place, closed by the number of words.
    place = [U((_POWER * (2 * i + 3)) & (2**64 - 1) | 1) for i in range(k)]
    m = max(0, len(h) - k + 1)
    full = np.zeros(m, U)
    for i in range(k):
        full += mix(h[i : i + m] + place[i])* place[i]
    full = mix(full + U(k))
    inside = row[:m] == row[len(row) - m :] if m else np.empty(0, bool)
    keys, rws = full[inside], row[:m][inside]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        extra = np.zeros(len(short), U)
        for i in range(k - 1):
            has = n[short] > i
            extra[has] += mix(h[at[short[has]] + i] + place[i]) * place[i]
        keys = np.concatenate((keys, mix(extra + n[short].astype(U))))
        rws = np.concatenate((rws, short))
    order = np.lexsort((keys, rws))
    keys, rws = keys[order], rws[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rws[1:] != rws[:-1])
    keys, rws = keys[new], rws[new]
    return keys, np.concatenate(([0], np.cumsum(np.bincount(rws, minlength=rows))))
