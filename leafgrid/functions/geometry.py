"""Plane geometry of page images: resampling, projective maps, hulls."""

from __future__ import annotations

import numpy as np


def sample(image: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The image at places between its cells, bilinear, edges repeated."""
    h, w = image.shape[:2]
    x, y = np.clip(x, 0, w - 1), np.clip(y, 0, h - 1)
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
    x1, y1 = np.minimum(x0 + 1, w - 1), np.minimum(y0 + 1, h - 1)
    fx, fy = (x - x0).astype(np.float32), (y - y0).astype(np.float32)
    if image.ndim == 3:
        fx, fy = fx[..., None], fy[..., None]
    a = image.astype(np.float32)
    out = (a[y0, x0] * (1 - fx) + a[y0, x1] * fx) * (1 - fy) + (a[y1, x0] * (1 - fx) + a[y1, x1] * fx) * fy
    return np.rint(out).astype(np.uint8)


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """About cell centres, bilinear."""
    h, w = image.shape[:2]
    if (h, w) == (height, width):
        return image
    y = (np.arange(height) + 0.5) * h / height - 0.5
    x = (np.arange(width) + 0.5) * w / width - 0.5
    return sample(image, *np.meshgrid(x, y))


def _centred(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Homogeneous points about their mean at unit spread, and the map that does it."""
    mean = points.mean(axis=0)
    spread = float(np.sqrt(((points - mean) ** 2).sum(axis=1)).mean()) or 1.0
    s = np.sqrt(2) / spread
    move = np.array([[s, 0, -s * mean[0]], [0, s, -s * mean[1]], [0, 0, 1]])
    return np.column_stack([points, np.ones(len(points))]) @ move.T, move


def homography(source: np.ndarray, target: np.ndarray) -> np.ndarray | None:
    """The projective map from four or more points to their targets, by least squares;
    None where the points leave it open."""
    a, from_ = _centred(np.asarray(source, float))
    b, to = _centred(np.asarray(target, float))
    zero = np.zeros_like(a)
    system = np.concatenate([np.hstack([a, zero, -b[:, :1] * a]), np.hstack([zero, a, -b[:, 1:2] * a])])
    _, value, rows = np.linalg.svd(system)
    if len(source) < 4 or value[7] < 1e-9 * value[0]:
        return None
    out = np.linalg.inv(to) @ rows[-1].reshape(3, 3) @ from_
    return out / out[2, 2] if abs(out[2, 2]) > 1e-12 else None


def mapped(matrix: np.ndarray, points: np.ndarray) -> np.ndarray:
    out = np.column_stack([points, np.ones(len(points))]) @ matrix.T
    with np.errstate(all="ignore"):
        return out[:, :2] / out[:, 2:]


def robust_homography(source: np.ndarray, target: np.ndarray, tolerance: float = 5.0, rounds: int = 300, seed: int = 3) -> tuple[np.ndarray | None, np.ndarray]:
    """The map that most points follow within ``tolerance``, fitted anew to those, and which
    they are.  Draws of four points are seeded, so reruns agree."""
    source, target = np.asarray(source, float), np.asarray(target, float)
    best = np.zeros(len(source), dtype=bool)
    if len(source) < 4:
        return None, best
    rng = np.random.default_rng(seed)

    def followers(matrix: np.ndarray | None) -> np.ndarray:
        if matrix is None:
            return np.zeros(len(source), dtype=bool)
        return np.nan_to_num(np.linalg.norm(mapped(matrix, source) - target, axis=1), nan=np.inf) <= tolerance

    for _ in range(rounds):
        four = rng.choice(len(source), 4, replace=False)
        with np.errstate(all="ignore"):
            found = followers(homography(source[four], target[four]))
        if found.sum() > best.sum():
            best = found
            if best.all():
                break
    if best.sum() < 4:
        return None, np.zeros(len(source), dtype=bool)
    matrix = homography(source[best], target[best])
    return matrix, followers(matrix)


def warp(image: np.ndarray, matrix: np.ndarray, height: int, width: int) -> np.ndarray:
    """What ``matrix``, from the image to the result, makes of it."""
    x, y = np.meshgrid(np.arange(width, dtype=float), np.arange(height, dtype=float))
    back = mapped(np.linalg.inv(matrix), np.column_stack([x.ravel(), y.ravel()]))
    back = np.nan_to_num(back, nan=0.0, posinf=1e9, neginf=-1e9)
    return sample(image, back[:, 0].reshape(height, width), back[:, 1].reshape(height, width))


def area(corners: np.ndarray) -> float:
    """Of a polygon, its corners in order."""
    x, y = np.asarray(corners, float).T
    return float(abs(x @ np.roll(y, -1) - y @ np.roll(x, -1)) / 2)


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull in order, by two chains over the sorted points."""
    pts = np.unique(np.asarray(points, float), axis=0)
    if len(pts) < 3:
        return pts

    def chain(order: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for p in order:
            while len(out) > 1:
                (ax, ay), (bx, by) = out[-1] - out[-2], p - out[-1]
                if ax * by - ay * bx > 0:
                    break
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(chain(pts) + chain(pts[::-1]))


def filled(shape: tuple[int, int], corners: np.ndarray) -> np.ndarray:
    """True inside a convex polygon, its edges included."""
    out = np.zeros(shape, dtype=bool)
    if len(corners) == 0:
        return out
    low, high = np.floor(corners.min(axis=0)).astype(int), np.ceil(corners.max(axis=0)).astype(int)
    x0, y0 = np.maximum(low, 0)
    x1, y1 = min(high[0], shape[1] - 1), min(high[1], shape[0] - 1)
    if x1 < x0 or y1 < y0:
        return out
    x, y = np.meshgrid(np.arange(x0, x1 + 1), np.arange(y0, y1 + 1))
    sides = [(b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) for a, b in zip(corners, np.roll(corners, -1, axis=0))]
    inside = np.logical_and.reduce([s >= -1e-9 for s in sides]) | np.logical_and.reduce([s <= 1e-9 for s in sides])
    out[y0 : y1 + 1, x0 : x1 + 1] = inside
    return out
