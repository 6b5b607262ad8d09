"""Image steps of a page, run as its book's plan says.

A book's active steps (:func:`leafgrid.sources.profiles.plan_steps`) become one array on its
pages, and one Arrow-batched pass runs them in order in memory: a step maps an image to one
image, or to several with a suffix each.  Steps can be added to :data:`STEPS`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import measures as ms
from ..functions import pixels as px
from ..sources import store
from . import layout, watermark

Keys = Sequence[str]
Step = Callable[[np.ndarray], list[tuple[str, np.ndarray]]]


#: Degrees: less is left as it is, more is no skew.
LEAST_ANGLE, MOST_ANGLE = 0.1, 5.0
#: Masks of a few hundred kB that are sent to every executor.
MASKS = 100


def page_borders(image: np.ndarray, coverage: float = 0.4) -> dict[str, dict] | None:
    """The outermost ruled lines of a page (top, bottom, left, right) that cover 40 % of it;
    None unless there are four, and three stretches or more each way."""
    h, w = image.shape[:2]
    rows = pd.DataFrame(px.line_segments(px.ink(image)), columns=["x1", "y1", "x2", "y2", "width"])
    flat = (rows["x2"] - rows["x1"]).abs() > (rows["y2"] - rows["y1"]).abs()
    out = {}
    for names, own, along, across, span in ((("top", "bottom"), rows[flat], "x", "y", w), (("left", "right"), rows[~flat], "y", "x", h)):
        if len(own) < 3:
            return None
        lines = layout.fold_lines(own.rename(columns={f"{along}1": "c1", f"{along}2": "c2", f"{across}1": "p1", f"{across}2": "p2"}))
        lines = [g | {"at": g["slope"] * span / 2 + g["intercept"]} for g in lines if g["total_length"] >= coverage * span]
        if len(lines) < 2:
            return None
        lines.sort(key=lambda g: g["at"])
        out |= dict(zip(names, (lines[0], lines[-1])))
    return out


def rectified(image: np.ndarray) -> np.ndarray | None:
    """The framed part of a page, its corners mapped to a rectangle's; None where no frame is
    found, its corners lie off the page, it holds less than a fifth of it, or it is straight."""
    h, w = image.shape[:2]
    found = page_borders(image)
    if found is None:
        return None
    tilt = max(abs(g["slope"]) for g in found.values())
    if not np.tan(np.radians(LEAST_ANGLE)) <= tilt <= np.tan(np.radians(MOST_ANGLE)):
        return None

    def corner(row: dict, column: dict) -> tuple[float, float]:
        y = (row["intercept"] + row["slope"] * column["intercept"]) / (1 - row["slope"] * column["slope"])
        return column["slope"] * y + column["intercept"], y

    tl, tr, br, bl = corners = np.array([corner(found[a], found[b]) for a, b in (("top", "left"), ("top", "right"), ("bottom", "right"), ("bottom", "left"))])
    slack = 0.05 * max(h, w)
    off = (corners < -slack).any() or (corners > np.array([w, h]) + slack).any()
    if off or geo.area(corners) < 0.2 * h * w:
        return None
    size = lambda a, b, c, d: int(max(np.linalg.norm(a - b), np.linalg.norm(c - d)))
    width, height = size(tl, tr, bl, br), size(tl, bl, tr, br)
    matrix = geo.homography(corners, np.array([[0, 0], [width, 0], [width, height], [0, height]]))
    return None if matrix is None else geo.warp(image, matrix, height, width)


def deskew(image: np.ndarray) -> list[tuple[str, np.ndarray]]:
    """A frame's tilted sides mapped to a rectangle, unless that leaves the rows worse; else
    rotated so that rows separate best.  Angles below 0.1 or above 5 degrees are left."""
    angle = px.skew(image)
    framed = rectified(image)
    if framed is not None and (abs(angle) < LEAST_ANGLE or abs(px.skew(framed)) <= abs(angle)):
        return [("", framed)]
    return [("", px.rotate(image, angle) if LEAST_ANGLE <= abs(angle) <= MOST_ANGLE else image)]


def content_box(image: np.ndarray, least: float = 0.01) -> tuple[int, int, int, int]:
    """Top, bottom, left, right of the rows and columns with at least ``least`` ink, scanned
    from each side."""
    mask = px.ink(image)
    out = []
    for axis in (1, 0):
        on = np.flatnonzero(mask.mean(axis=axis) >= least)
        out += [int(on[0]), int(on[-1]) + 1] if len(on) else [0, mask.shape[1 - axis]]
    return tuple(out)


def crop(image: np.ndarray) -> list[tuple[str, np.ndarray]]:
    """Cut to its content, unless that is less than 30 % of the page or of 100 cells."""
    t, b, l, r = content_box(image)  # noqa: E741
    h, w = image.shape[:2]
    small = (b - t) * (r - l) < 0.3 * h * w or min(b - t, r - l) < 100
    return [("", image if small else image[t:b, l:r])]


def enhance_lines(image: np.ndarray) -> list[tuple[str, np.ndarray]]:
    """Ruled lines of half the page or more drawn whole, in the median gray of the ink."""
    g, mask = px.gray(image), px.ink(image)
    tone = int(np.median(g[mask])) if mask.any() else 0
    out = image.copy()
    for axis in (1, 0):
        long = px.line_profile(mask, axis, 8) >= 0.5
        band = np.broadcast_to(long[:, None] if axis == 1 else long[None, :], mask.shape)
        on = np.flatnonzero((mask & band).any(axis=0 if axis == 1 else 1))
        if long.any() and len(on):
            full = band.copy()
            other = np.ones(mask.shape[1] if axis == 1 else mask.shape[0], dtype=bool)
            other[on[0] : on[-1] + 1] = False
            if axis == 1:
                full[:, other] = False
            else:
                full[other] = False
            out[full] = np.minimum(out[full], tone)
    return [("", out)]


def split(image: np.ndarray) -> list[tuple[str, np.ndarray]]:
    """At the fold; the right half comes first."""
    c = ms.fold_center(px.gray(image))
    return [("_right", image[:, c:]), ("_left", image[:, :c])]


def crop_spine(image: np.ndarray, dark: float = 20, recovered: float = 0.6, sure: float = 0.3) -> list[tuple[str, np.ndarray]]:
    """Without the shadow of the spine at one edge: the darkest column of an edge strip must
    be darker than the strip's far side, and the cut is where 60 % of that is made up."""
    level = px.gray(image).mean(axis=0)
    n = max(len(level) // 7, 20)
    best = (0.0, 0, len(level))
    for flip in (False, True):
        v = level[::-1][:n] if flip else level[:n]
        far = float(v[-5:].mean())
        at = int(v.argmin())
        drop = far - float(v[at])
        if drop < dark or min(1.0, drop / 40) <= max(best[0], sure):
            continue
        back = np.flatnonzero(v[at:] >= v[at] + recovered * drop)
        end = at + int(back[0]) if len(back) else n
        best = (min(1.0, drop / 40), 0, len(level) - end) if flip else (min(1.0, drop / 40), end, len(level))
    return [("", image[:, best[1] : best[2]])]


def binarize(image: np.ndarray) -> list[tuple[str, np.ndarray]]:
    return [("", px.adaptive_binary(image))]


STEPS: dict[str, Step] = {"deskew": deskew, "crop": crop, "enhance_lines": enhance_lines, "split": split, "binarize": binarize, "crop_spine": crop_spine}


def run(pages: DataFrame, plan: DataFrame, keys: Keys = ("book", "path"), steps: dict[str, Step] | None = None, masks: DataFrame | None = None) -> DataFrame:
    """``keys, sub, part, width, height, channels, data, steps``: what the active steps of
    each page's book make of it.  ``keys`` begin with the book; a page of a book without a
    plan comes out as it is; planned steps that have no kernel are passed over, so ``steps``
    names those that ran.  ``masks`` (:func:`watermark.masks`) are what ``remove_watermark``
    paints over; it is the first step of every table, so it sees the page as it was read."""
    known = dict(STEPS if steps is None else steps)
    active = plan.where("active").groupBy("book").agg(F.array_sort(F.collect_list(F.struct("number", "step"))).alias("a"))
    active = active.select(F.col("book").alias("_book"), F.transform("a", lambda x: x["step"]).alias("_steps"))
    # one row per book: sent to the images, which stay where they were read
    both = pages.join(store.small(active), F.col(keys[0]) == F.col("_book"), "left")
    mark = [F.lit(None).cast(t).alias(c) for c, t in (("_mark_height", "int"), ("_mark_width", "int"), ("_mark_bits", "binary"))]
    if masks is not None:
        own = masks.select(F.col("book").alias("_marked"), *[F.col(c).alias(f"_mark_{c}") for c in ("height", "width", "bits")])
        # up to so many masks are sent to the images; beyond it the join is a shuffle
        both = both.join(store.small(own, MASKS), F.col(keys[0]) == F.col("_marked"), "left")
        mark = ["_mark_height", "_mark_width", "_mark_bits"]
    types = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "sub string, part int, width int, height int, channels int, data binary, steps array<string>"])
    narrow = both.select(*keys, "_steps", *mark, *[F.col(f"image.{c}").alias(f"_{c}") for c in ("height", "width", "nChannels", "data")])

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [*keys, "sub", "part", "width", "height", "channels", "data", "steps"]
        for frame in frames:
            for row in frame.to_dict("records"):  # one page at a time: images are large
                parts = [("", px.from_row(row["_height"], row["_width"], row["_nChannels"], row["_data"]))]
                have = dict(known)
                if row["_mark_bits"] is not None:
                    mask = int(row["_mark_height"]), int(row["_mark_width"]), row["_mark_bits"]
                    have["remove_watermark"] = lambda image, mask=mask: [("", watermark.without_mark(image, *mask))]
                ran = [s for s in (row["_steps"] if row["_steps"] is not None else []) if s in have]
                for s in ran:
                    parts = [(sub + more, made) for sub, image in parts for more, made in have[s](image)]
                out = [
                    {k: row[k] for k in keys}
                    | {"sub": sub, "part": n, "width": im.shape[1], "height": im.shape[0], "channels": 1 if im.ndim == 2 else im.shape[2], "data": np.ascontiguousarray(im).tobytes(), "steps": ran}
                    for n, (sub, im) in enumerate(parts)
                ]
                yield pd.DataFrame(out, columns=names)

    return narrow.mapInPandas(apply, schema)
