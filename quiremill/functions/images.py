"""Page-image kernels on grey matrices in numpy, and the Arrow functions that run them by row.

An image is a row of ``data`` (uint8, row by row), ``h``, ``w`` and ``mode`` (L or RGB).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

INK = 128
#: Specks of up to so many pixels go if no larger mark is within so many pixels.
SPECKS = [(8, 25.0), (75, 12.0), (200, 25.0)]


def is_color(rgb: np.ndarray, mean: float = 6.0, var: float = 40.0) -> bool:
    """Whether the channels of an RGB image differ."""
    if rgb.ndim == 2:
        return False
    x = rgb.astype(np.float64)
    d = np.abs(x - x.mean(axis=2, keepdims=True)).max(axis=2)
    return bool(d.mean() > mean or d.var() > var)


def rotate(gray: np.ndarray, degrees: float, fill: int = 255) -> np.ndarray:
    """Rotation about the centre, bilinear; counter-clockwise as seen."""
    h, w = gray.shape
    t = np.deg2rad(degrees)
    y, x = np.mgrid[0:h, 0:w].astype(np.float64)
    cy, cx = (h - 1) / 2, (w - 1) / 2
    sx = np.cos(t) * (x - cx) - np.sin(t) * (y - cy) + cx
    sy = np.sin(t) * (x - cx) + np.cos(t) * (y - cy) + cy
    x0, y0 = np.floor(sx).astype(int), np.floor(sy).astype(int)
    fx, fy = sx - x0, sy - y0
    g = np.full((h + 2, w + 2), fill, np.float64)
    g[1:-1, 1:-1] = gray
    at = lambda yy, xx: g[np.clip(yy + 1, 0, h + 1), np.clip(xx + 1, 0, w + 1)]
    out = (1 - fy) * ((1 - fx) * at(y0, x0) + fx * at(y0, x0 + 1)) + fy * ((1 - fx) * at(y0 + 1, x0) + fx * at(y0 + 1, x0 + 1))
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def _profile_variance(ys: np.ndarray, xs: np.ndarray, degrees: float, h: int) -> float:
    """Variance of the row sums of ink if it were rotated: only ink pixels are moved."""
    row = np.rint(ys - np.tan(np.deg2rad(degrees)) * xs).astype(int)
    return float(np.bincount(row - row.min(), minlength=h).var())


def find_skew(gray: np.ndarray, reach: float = 3.0, coarse: float = 0.2, fine: float = 0.02) -> float:
    """The rotation in degrees that makes text lines level: largest variance of row sums."""
    ys, xs = np.nonzero(gray < INK)
    if len(ys) < 50:
        return 0.0
    xs = xs - gray.shape[1] / 2
    best = 0.0
    for span, step in ((reach, coarse), (coarse, fine)):
        angles = best + np.arange(-span, span + step / 2, step)
        v = np.array([_profile_variance(ys, xs, a, gray.shape[0]) for a in angles])
        best = float(np.mean(angles[v >= v.max() * (1 - 1e-6)]))  # whole pixels make plateaus: their middle
    return best


def components(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """Labels of 8-connected regions, from 1: rows as runs, joined by union-find."""
    h, w = mask.shape
    pad = np.zeros((h, w + 2), np.int8)
    pad[:, 1:-1] = mask
    d = np.diff(pad, axis=1)
    row, start = np.nonzero(d == 1)
    end = np.nonzero(d == -1)[1]
    parent = np.arange(len(row))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = np.searchsorted(row, np.arange(h + 1))
    for y in range(1, h):
        a, b = first[y - 1], first[y]
        i, j = a, b
        while i < b and j < first[y + 1]:
            if start[j] <= end[i] and start[i] <= end[j]:
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
            if end[i] < end[j]:
                i += 1
            else:
                j += 1
    roots = np.array([root(i) for i in range(len(row))], int)
    names = np.unique(roots, return_inverse=True)[1] + 1 if len(row) else np.empty(0, int)
    out = np.zeros((h, w), np.int32)
    for y, s, e, n in zip(row, start, end, names, strict=True):
        out[y, s:e] = n
    return out, int(names.max()) if len(names) else 0


def distance(mask: np.ndarray) -> np.ndarray:
    """Exact Euclidean distance of each pixel to the nearest set one (infinite if none)."""
    h, w = mask.shape
    big = float(h + w) * 2
    ys = np.arange(h)[:, None]
    at = np.where(mask, ys, -big)
    up = ys - np.maximum.accumulate(at, axis=0)
    down = np.minimum.accumulate(np.where(mask, ys, 3 * big)[::-1], axis=0)[::-1] - ys
    g2 = np.minimum(up, down) ** 2.0
    d = np.arange(w)[:, None] - np.arange(w)[None, :]
    d2 = (d * d).astype(np.float64)
    out = np.stack([(g2[y][None, :] + d2).min(axis=1) for y in range(h)])
    return np.where(mask.any(), np.sqrt(out), np.inf)


def despeckle(gray: np.ndarray) -> np.ndarray:
    """White for specks that stand far from larger marks."""
    labels, n = components(gray < INK)
    if not n:
        return gray.copy()
    size = np.bincount(labels.ravel(), minlength=n + 1)
    out = gray.copy()
    for most, far in SPECKS:
        large = np.flatnonzero(size > most)
        large = large[large > 0]
        near = distance(np.isin(labels, large))
        least = np.full(n + 1, np.inf)
        np.minimum.at(least, labels.ravel(), near.ravel())
        gone = (size <= most) & (least > far)
        gone[0] = False
        out[gone[labels]] = 255
    return out


def level(gray: np.ndarray, black: int = 60, white: int = 200) -> np.ndarray:
    """Grey levels stretched: below ``black`` 0, above ``white`` 255."""
    lut = np.clip((np.arange(256) - black) * 255.0 / (white - black), 0, 255).astype(np.uint8)
    return lut[gray]


def mask_margins(gray: np.ndarray, page: int, outer: float = 0.02, gutter: float = 0.06) -> np.ndarray:
    """White margins: wide at the gutter, which is right on even pages, narrow elsewhere."""
    h, w = gray.shape
    left, right = (outer, gutter) if page % 2 == 0 else (gutter, outer)
    out = gray.copy()
    out[:, : int(w * left)] = 255
    out[:, w - int(w * right) :] = 255
    out[: int(h * outer)] = 255
    out[h - int(h * outer) :] = 255
    return out


def box_max(gray: np.ndarray, r: int) -> np.ndarray:
    """Maximum over squares of side 2 r + 1."""
    for axis in (0, 1):
        p = np.pad(gray, [(r, r) if a == axis else (0, 0) for a in (0, 1)], mode="edge")
        gray = np.lib.stride_tricks.sliding_window_view(p, 2 * r + 1, axis=axis).max(axis=-1)
    return gray


def subtract_background(gray: np.ndarray, r: int = 12) -> np.ndarray:
    """The page relative to its local brightest tone."""
    paper = box_max(gray, r).astype(np.float64)
    return np.clip(gray * 255.0 / np.maximum(paper, 1), 0, 255).astype(np.uint8)


def restore(gray: np.ndarray, page: int) -> np.ndarray:
    """Background, levels, margins and specks in turn."""
    return despeckle(mask_margins(level(subtract_background(gray)), page))


def split_spread(gray: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A double page at the column of least ink near its middle."""
    w = gray.shape[1]
    ink = (gray < INK).sum(axis=0)
    lo, hi = int(w * 0.45), max(int(w * 0.55), int(w * 0.45) + 1)
    band = ink[lo:hi]
    best = np.flatnonzero(band == band.min())
    at = lo + int(best[len(best) // 2])
    return gray[:, :at], gray[:, at:]


def horizontal_rules(gray: np.ndarray, shortest: float = 0.15, longest: float = 0.40, top: float = 0.40, bottom: float = 0.92) -> list[tuple[int, int, int]]:
    """(y, x0, x1) of runs of ink between two shares of the width, in a band of the page; once per rule."""
    h, w = gray.shape
    out: list[tuple[int, int, int]] = []
    for y in range(int(h * top), int(h * bottom)):
        d = np.diff(np.concatenate(([0], (gray[y] < INK).astype(np.int8), [0])))
        for x0, x1 in zip(np.flatnonzero(d == 1), np.flatnonzero(d == -1), strict=True):
            if shortest * w <= x1 - x0 <= longest * w and not (out and y - out[-1][0] <= 3 and x0 < out[-1][2] and x1 > out[-1][1]):
                out.append((y, int(x0), int(x1)))
    return out


def subpixel_shift(a: np.ndarray, b: np.ndarray) -> float:
    """The shift of profile ``b`` against ``a``: peak of the correlation, refined by a parabola."""
    c = np.correlate(b - b.mean(), a - a.mean(), "full")
    i = int(np.argmax(c))
    if 0 < i < len(c) - 1:
        l, m, r = c[i - 1 : i + 2]
        return i - (len(a) - 1) + (0.5 * (l - r) / (l - 2 * m + r) if l - 2 * m + r else 0.0)
    return float(i - (len(a) - 1))


def diff_overlay(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """RGB: ink of ``a`` alone red, of ``b`` alone cyan, of both black."""
    h, w = min(a.shape[0], b.shape[0]), min(a.shape[1], b.shape[1])
    return np.stack((b[:h, :w], a[:h, :w], a[:h, :w]), axis=2)


def ink_extent(gray: np.ndarray) -> tuple[int, int, int, int] | None:
    """Box of the ink: x0, y0, x1, y1."""
    ys, xs = np.nonzero(gray < INK)
    return (int(xs.min()), int(ys.min()), int(xs.max()) + 1, int(ys.max()) + 1) if len(ys) else None


def margin_purity(gray: np.ndarray, band: float = 0.03) -> int:
    """Dark pixels in the outer bands."""
    h, w = gray.shape
    y, x = max(1, int(h * band)), max(1, int(w * band))
    dark = gray < INK
    return int(dark.sum() - dark[y : h - y, x : w - x].sum())


def _matrix(data: bytes, h: int, w: int, mode: str) -> np.ndarray:
    a = np.frombuffer(data, np.uint8)
    return a.reshape(h, w, 3) if mode == "RGB" else a.reshape(h, w)


_STATS = T.StructType([T.StructField("skew", T.DoubleType()), T.StructField("is_color", T.BooleanType()), T.StructField("rules", T.IntegerType()), T.StructField("margin_ink", T.IntegerType()), T.StructField("ink", T.ArrayType(T.IntegerType()))])


@F.pandas_udf(_STATS)
def page_stats(data: pd.Series, h: pd.Series, w: pd.Series, mode: pd.Series) -> pd.DataFrame:
    rows = []
    for d, y, x, m in zip(data, h, w, mode, strict=True):
        a = _matrix(d, y, x, m)
        g = a if a.ndim == 2 else a.mean(axis=2).astype(np.uint8)
        box = ink_extent(g)
        rows.append((find_skew(g), is_color(a), len(horizontal_rules(g)), margin_purity(g), list(box) if box else None))
    return pd.DataFrame(rows, columns=_STATS.names)


@F.pandas_udf(T.BinaryType())
def restored(data: pd.Series, h: pd.Series, w: pd.Series, page: pd.Series) -> pd.Series:
    return pd.Series([restore(_matrix(d, y, x, "L"), int(p)).tobytes() for d, y, x, p in zip(data, h, w, page, strict=True)])


def baselines(gray: np.ndarray, least: float = 0.25) -> np.ndarray:
    """Rows at which text lines end: falls of the row sums of ink below a share of their maximum."""
    rows = (gray < INK).sum(axis=1)
    if not rows.any():
        return np.empty(0, int)
    on = rows >= least * rows.max()
    return np.flatnonzero(on[:-1] & ~on[1:])


def leading(gray: np.ndarray) -> float | None:
    """Median distance of baselines; None for fewer than two lines."""
    b = baselines(gray)
    return float(np.median(np.diff(b))) if len(b) > 1 else None


def route(image: np.ndarray, page: int) -> tuple[str, np.ndarray]:
    """Colour pages as they are, grey ones restored, with the mode that they have then."""
    if is_color(image):
        return "RGB", image
    grey = image if image.ndim == 2 else image.mean(axis=2).astype(np.uint8)
    return "L", restore(grey, page)


_ROUTED = T.StructType([T.StructField("mode", T.StringType()), T.StructField("data", T.BinaryType())])


@F.pandas_udf(_ROUTED)
def routed(data: pd.Series, h: pd.Series, w: pd.Series, mode: pd.Series, page: pd.Series) -> pd.DataFrame:
    rows = [route(_matrix(d, y, x, m), int(p)) for d, y, x, m, p in zip(data, h, w, mode, page, strict=True)]
    return pd.DataFrame([(m, a.tobytes()) for m, a in rows], columns=["mode", "data"])
