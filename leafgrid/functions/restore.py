"""Finding and painting over a mark that all pages of a book bear."""

from __future__ import annotations

import numpy as np

from . import geometry as geo
from . import pixels as px

# The background's blur, what differs from it, how its pieces join, which
# of them count, how far their hulls grow, and how thin and strong the mark's lines are.
BACKGROUND_SIZE, BACKGROUND_SIGMA, DIFFERS = 201, 70.0, 25
JOIN_SIZE, JOIN_GROW, JOIN_CLOSE = 11, 3, 3
LEAST_AREA, MOST_SPAN, HULL_GROW = 0.005, 0.5, 70
LINE_SIZE, LINE_STRENGTH, PAINT_RADIUS = 15, 8, 2


def gaussian(gray: np.ndarray, size: int, sigma: float) -> np.ndarray:
    x = np.arange(size) - size // 2
    k = np.exp(-x * x / (2 * sigma * sigma)).astype(np.float32)
    k /= k.sum()
    out = gray.astype(np.float32)
    for axis in (0, 1):
        wide = np.pad(out, [(size // 2, size // 2) if a == axis else (0, 0) for a in (0, 1)], mode="reflect")
        n = gray.shape[axis]
        out = sum(k[i] * (wide[i : i + n] if axis == 0 else wide[:, i : i + n]) for i in range(size))
    return out


def _spread(a: np.ndarray, half: int) -> np.ndarray:
    """The largest within ``half`` cells along the rows, by windows that double."""
    n, width, size = 2 * half + 1, a.shape[1], 1
    wide = np.pad(a, ((0, 0), (half, half)))
    while size * 2 <= n:
        wide = np.maximum(wide[:, :-size], wide[:, size:])
        size *= 2
    return np.maximum(wide[:, :width], wide[:, n - size : n - size + width])


def dilated(a: np.ndarray, size: int) -> np.ndarray:
    """Flags or grays grown by an ellipse ``size`` cells wide."""
    r, height, out = size // 2, a.shape[0], a.copy()
    for dy in range(min(r, height - 1) + 1):
        near = _spread(a, int(round(r * np.sqrt(1 - (dy / r) ** 2))) if r else 0)
        np.maximum(out[: height - dy], near[dy:], out=out[: height - dy])
        np.maximum(out[dy:], near[: height - dy], out=out[dy:])
    return out


def eroded(a: np.ndarray, size: int) -> np.ndarray:
    return ~dilated(~a, size)


def mark_region(gray: np.ndarray) -> np.ndarray:
    """Where a mark stands on the common page: hulls of the joined pieces that differ from
    the background, those without the spread of a frame or the size of a stain."""
    h, w = gray.shape
    joined = np.abs(gray.astype(np.float32) - np.rint(gaussian(gray, BACKGROUND_SIZE, BACKGROUND_SIGMA))) > DIFFERS
    for _ in range(JOIN_GROW + JOIN_CLOSE):
        joined = dilated(joined, JOIN_SIZE)
    for _ in range(JOIN_CLOSE):
        joined = eroded(joined, JOIN_SIZE)
    n, label = px.components(joined)
    region = np.zeros((h, w), dtype=bool)
    for k in range(1, n + 1):
        y, x = np.nonzero(label == k)
        frame = np.ptp(x) + 1 > w * MOST_SPAN and np.ptp(y) + 1 > h * MOST_SPAN
        if len(y) < h * w * LEAST_AREA or frame:
            continue
        region |= geo.filled((h, w), geo.hull(np.column_stack([x, y])))
    return dilated(region, 2 * HULL_GROW + 1)


def mark_lines(common: np.ndarray) -> np.ndarray:
    """The cells of a mark's lines on a book's common page: thin strokes, darker or lighter
    than around them, within its region."""
    gray = px.gray(common)
    region = mark_region(gray)
    if not region.any():
        return region
    dark = eroded(dilated(gray, LINE_SIZE), LINE_SIZE).astype(int) - gray
    light = gray.astype(int) - dilated(eroded(gray, LINE_SIZE), LINE_SIZE)
    return region & ((dark > LINE_STRENGTH) | (light > LINE_STRENGTH))


def painted(image: np.ndarray, mask: np.ndarray, radius: int = PAINT_RADIUS) -> np.ndarray:
    """Masked cells filled from their rim inwards, each with the mean of the known cells
    within ``radius``, weighted by the inverse square of the distance.  A page masked whole
    stays as it is."""
    h, w = mask.shape
    out = image.astype(np.float32).reshape(h, w, -1)
    unknown = mask.copy()
    near = [(dy, dx) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1) if 0 < dy * dy + dx * dx <= radius * radius]
    while unknown.any():
        rim = unknown & dilated(~unknown, 3)
        y, x = np.nonzero(rim)
        if not len(y):
            break
        total, weight = np.zeros((len(y), out.shape[2]), np.float32), np.zeros(len(y), np.float32)
        for dy, dx in near:
            yy, xx = y + dy, x + dx
            inside = (yy >= 0) & (yy < h) & (xx >= 0) & (xx < w)
            yy, xx = np.clip(yy, 0, h - 1), np.clip(xx, 0, w - 1)
            each = (inside & ~unknown[yy, xx]) / np.float32(dy * dy + dx * dx)
            total += out[yy, xx] * each[:, None]
            weight += each
        out[y, x] = total / weight[:, None]
        unknown[y, x] = False
    return np.rint(out).astype(np.uint8).reshape(image.shape)
