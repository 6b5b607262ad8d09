"""Pixel kernels on NumPy arrays.  Images are uint8, BGR or gray."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def from_row(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """The array of an image-source row."""
    a = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return a[..., 0] if channels == 1 else a[..., :3]


def gray(image: np.ndarray) -> np.ndarray:
    """Luma of BGR, rounded."""
    if image.ndim == 2:
        return image
    b, g, r = (image[..., k].astype(np.float32) for k in range(3))
    return np.rint(0.114 * b + 0.587 * g + 0.299 * r).astype(np.uint8)


def hsv(image: np.ndarray) -> np.ndarray:
    """Hue in [0, 180), saturation and value in [0, 255]."""
    x = image.astype(np.float32)
    b, g, r = x[..., 0], x[..., 1], x[..., 2]
    top, low = x.max(axis=-1), x.min(axis=-1)
    span = np.where(top == low, 1, top - low)
    h = np.where(top == r, (g - b) / span, np.where(top == g, 2 + (b - r) / span, 4 + (r - g) / span)) * 30
    h = np.where(top == low, 0, h) % 180
    s = np.where(top == 0, 0, (top - low) / np.where(top == 0, 1, top) * 255)
    return np.stack([np.rint(h) % 180, np.rint(s), top], axis=-1).astype(np.uint8)


def otsu(values: np.ndarray) -> int:
    """The threshold with the largest variance between classes, the first on ties."""
    n = np.bincount(values.ravel(), minlength=256).astype(float)
    low = np.cumsum(n)
    mass = np.cumsum(n * np.arange(256))
    high = low[-1] - low
    ok = (low > 0) & (high > 0)
    between = np.zeros(256)
    between[ok] = low[ok] * high[ok] * (mass[ok] / low[ok] - (mass[-1] - mass[ok]) / high[ok]) ** 2
    return int(between.argmax())


def ink(image: np.ndarray, threshold: int | None = None) -> np.ndarray:
    """True where darker than or at the threshold (Otsu's by default)."""
    g = gray(image)
    return g <= (otsu(g) if threshold is None else threshold)


def run_lengths(mask: np.ndarray) -> np.ndarray:
    """For each true cell the length of its run along the last axis; 0 elsewhere."""
    padded = np.pad(mask, [(0, 0)] * (mask.ndim - 1) + [(1, 1)]).astype(np.int8)
    step = np.diff(padded, axis=-1)
    rows, starts = np.nonzero(step == 1)
    _, ends = np.nonzero(step == -1)
    out = np.zeros(mask.shape, dtype=np.int64)
    length = ends - starts
    flat = np.repeat(rows * mask.shape[-1] + starts, length)
    within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out.ravel()[flat + within] = np.repeat(length, length)
    return out


def open_lines(mask: np.ndarray, least: int, axis: int) -> np.ndarray:
    """What an opening by a line of ``least`` cells along ``axis`` leaves: its long runs."""
    return run_lengths(mask) >= least if axis == 1 else (run_lengths(np.ascontiguousarray(mask.T)) >= least).T


def dilate(mask: np.ndarray, reach: int = 1) -> np.ndarray:
    """By a square of 2 * reach + 1 cells."""
    out = mask.copy()
    for axis in (0, 1):
        grown = out.copy()
        for k in range(1, reach + 1):
            for shift in (k, -k):
                moved = np.roll(out, shift, axis)
                edge = [slice(None)] * 2
                edge[axis] = slice(0, k) if shift > 0 else slice(-k, None)
                moved[tuple(edge)] = False
                grown |= moved
        out = grown
    return out


def line_profile(mask: np.ndarray, axis: int, part: int = 8) -> np.ndarray:
    """Share of each row (axis 1) or column (axis 0) covered by long ruled runs."""
    size = mask.shape[axis]
    return open_lines(mask, max(size // part, 10), axis).sum(axis=axis) / size


def without_lines(image: np.ndarray, part: int = 6) -> np.ndarray:
    """The gray image with its ruled lines, grown by a cell, painted white."""
    g, mask = gray(image).copy(), ink(image)
    h, w = mask.shape
    lines = open_lines(mask, max(w // part, 10), 1) | open_lines(mask, max(h // part, 10), 0)
    g[dilate(lines)] = 255
    return g


def adaptive_binary(image: np.ndarray, size: int = 31, offset: float = 10) -> np.ndarray:
    """Black where darker than the Gaussian mean around less ``offset``."""
    g = gray(image).astype(np.float32)
    sigma = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    x = np.arange(size) - size // 2
    k = np.exp(-x * x / (2 * sigma * sigma))
    k /= k.sum()
    mean = g
    for axis in (0, 1):
        wide = np.pad(mean, [(size // 2, size // 2) if a == axis else (0, 0) for a in (0, 1)], mode="edge")
        mean = sum(k[i] * np.take(wide, range(i, i + g.shape[axis]), axis) for i in range(size))
    return np.where(g > mean - offset, 255, 0).astype(np.uint8)


def components(mask: np.ndarray) -> tuple[int, np.ndarray]:
    """Number and labels (from 1) of the 8-connected parts, by union of row runs."""
    label = np.zeros(mask.shape, dtype=np.int64)
    parent = [0]

    def find(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    above: list[tuple[int, int, int]] = []
    for y, row in enumerate(mask):
        step = np.diff(np.pad(row, 1).astype(np.int8))
        now = []
        for s, e in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1)):
            own = 0
            for a, b, k in above:
                if a <= e and s <= b:
                    root = find(k)
                    if own and own != root:
                        parent[max(own, root)] = own = min(own, root)
                    own = own or root
            if not own:
                own = len(parent)
                parent.append(own)
            label[y, s:e] = own
            now.append((s, e, own))
        above = now
    roots = np.array([find(k) for k in range(len(parent))])
    _, dense = np.unique(roots, return_inverse=True)
    return int(dense.max()) if len(parent) > 1 else 0, dense[label] if len(parent) > 1 else label


def rotate(image: np.ndarray, degrees: float) -> np.ndarray:
    """About the centre, counter-clockwise, bilinear, edges repeated."""
    h, w = image.shape[:2]
    t = np.deg2rad(degrees)
    y, x = np.mgrid[:h, :w].astype(np.float32)
    cx, cy = w / 2, h / 2
    sx = np.clip(np.cos(t) * (x - cx) - np.sin(t) * (y - cy) + cx, 0, w - 1)
    sy = np.clip(np.sin(t) * (x - cx) + np.cos(t) * (y - cy) + cy, 0, h - 1)
    x0, y0 = np.floor(sx).astype(int), np.floor(sy).astype(int)
    x1, y1 = np.minimum(x0 + 1, w - 1), np.minimum(y0 + 1, h - 1)
    fx, fy = sx - x0, sy - y0
    if image.ndim == 3:
        fx, fy = fx[..., None], fy[..., None]
    a = image.astype(np.float32)
    out = (a[y0, x0] * (1 - fx) + a[y0, x1] * fx) * (1 - fy) + (a[y1, x0] * (1 - fx) + a[y1, x1] * fx) * fy
    return np.rint(out).astype(np.uint8)


def skew(image: np.ndarray, limit: float = 3.0, fine: float = 0.2, longest: int = 800, marks: Callable[[np.ndarray], np.ndarray] = ink) -> float:
    """Degrees by which to rotate so that rows separate best: the sum of squared row sums of
    the marks (the ink; :func:`edges` on unevenly lit pages) over a coarse, then a fine grid of angles.  Only where each inked cell would come
    to lie is computed, not the rotated images."""
    mask = marks(image)
    step = max(1, -(-max(mask.shape) // longest))
    small = mask[::step, ::step]
    h, w = small.shape
    y, x = (c.astype(np.float64) for c in np.nonzero(small))

    def score(angle: float) -> float:
        t = np.deg2rad(angle)
        row = np.cos(t) * (y - h / 2) - np.sin(t) * (x - w / 2) + h / 2
        low = np.floor(row).astype(np.int64)
        part = row - low
        inside = (low >= 0) & (low < h)
        sums = np.bincount(low[inside], 1 - part[inside], h + 1) + np.bincount(low[inside] + 1, part[inside], h + 1)
        return float((sums * sums).sum())

    def best(angles: np.ndarray) -> float:
        return float(angles[int(np.argmax([score(a) for a in angles]))])

    coarse = best(np.arange(-limit, limit + 0.05, 0.1))
    return best(np.arange(coarse - fine, coarse + fine + 0.01, 0.02))


def edges(image: np.ndarray, low: float = 50, high: float = 150) -> np.ndarray:
    """True on the ridges of the gradient above ``low`` that hang together with one above
    ``high``: Sobel slopes, the larger of a cell and its neighbours along the slope."""
    g = np.pad(gray(image).astype(np.int64), 1, mode="edge")
    rows, cols = g[:-2] + 2 * g[1:-1] + g[2:], g[:, :-2] + 2 * g[:, 1:-1] + g[:, 2:]
    dx, dy = rows[:, 2:] - rows[:, :-2], cols[2:] - cols[:-2]
    size = np.abs(dx) + np.abs(dy)
    h, w = size.shape
    wide = np.pad(size, 1)
    at = lambda y, x: wide[1 + y : 1 + y + h, 1 + x : 1 + x + w]
    steep = np.tan(np.pi / 8)
    level, upright = np.abs(dy) <= steep * np.abs(dx), np.abs(dx) < steep * np.abs(dy)
    falling = dx * dy >= 0
    before = np.select([level, upright, falling], [at(0, -1), at(-1, 0), at(-1, -1)], at(-1, 1))
    after = np.select([level, upright, falling], [at(0, 1), at(1, 0), at(1, 1)], at(1, -1))
    ridge = (size > low) & (size > before) & (size >= after)
    n, label = components(ridge)
    strong = np.zeros(n + 1, dtype=bool)
    strong[label[ridge & (size > high)]] = True
    return strong[label] & ridge


def line_widths(mask: np.ndarray, along: np.ndarray, across: np.ndarray, axis: int, margin: int = 8) -> np.ndarray:
    """Ink across a line at its places, 0 where none is within ``margin``: the run through the
    nearest inked cell (the former on ties), at most ``margin`` further each way, so that
    touching letters do not count.  ``axis`` 1 is a level line, 0 an upright one."""
    m = mask if axis == 1 else mask.T
    along, across = np.asarray(along, int), np.asarray(across, int)
    inked = lambda c, p: np.where((c >= 0) & (c < m.shape[0]) & (p >= 0) & (p < m.shape[1]), m[np.clip(c, 0, m.shape[0] - 1), np.clip(p, 0, m.shape[1] - 1)], False)
    steps = np.array(sorted(range(-margin, margin + 1), key=lambda k: (abs(k), k)))
    found = inked(across[:, None] + steps, along[:, None]) & (across >= 0)[:, None] & (across < m.shape[0])[:, None]
    start = across + steps[found.argmax(axis=1)]
    reach = np.arange(1, margin + 1)
    out = 1 + sum(np.logical_and.accumulate(inked(start[:, None] + side * reach, along[:, None]), axis=1).sum(axis=1) for side in (-1, 1))
    return np.where(found.any(axis=1), out, 0)


def line_segments(mask: np.ndarray, least: int = 30) -> list[dict]:
    """Straight ruled stretches of ``least`` cells or more: ``x1, y1, x2, y2, width``.

    What an opening by a line leaves falls into parts; each part of an upright or level
    opening is one segment along its middle, with the slope of its cells, as wide as its area
    over its length.  Parts wider than long are no lines.
    """
    out = []
    for axis in (1, 0):
        opened = open_lines(mask, least, axis)
        opened = opened if axis == 1 else np.ascontiguousarray(opened.T)
        n, label = components(opened)
        across, along = np.nonzero(label)
        k = label[across, along]
        count = np.bincount(k, minlength=n + 1).astype(float)
        total = lambda v: np.bincount(k, v, minlength=n + 1)  # noqa: B023, E731
        low, high = np.full(n + 1, 1 << 30), np.full(n + 1, -1)
        np.minimum.at(low, k, along)
        np.maximum.at(high, k, along)
        for j in range(1, n + 1):
            length = high[j] - low[j] + 1
            if length < least or count[j] / length > length / 2:
                continue
            out.append((axis, j, low[j], high[j], count[j], length))
        if n:
            u, v = along.astype(float), across.astype(float)
            s1, s2, t0, t1 = total(u), total(u * u), total(v), total(u * v)
            with np.errstate(all="ignore"):
                slope = np.nan_to_num((count * t1 - s1 * t0) / (count * s2 - s1 * s1))
            at = np.divide(t0 - slope * s1, count, out=np.zeros_like(t0), where=count > 0)
            out = [x if not (isinstance(x, tuple) and x[0] == axis) else _segment(*x, slope, at) for x in out]
    return out


def _segment(axis: int, j: int, low: int, high: int, count: float, length: int, slope: np.ndarray, at: np.ndarray) -> dict:
    a, b = (float(at[j] + slope[j] * c) for c in (low, high))
    ends = (float(low), a, float(high), b) if axis == 1 else (a, float(low), b, float(high))
    return dict(zip(("x1", "y1", "x2", "y2"), ends)) | {"width": float(count / length)}
