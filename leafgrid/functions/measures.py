"""What an analysis reads off one page: vectors, peaks, strips and the shares of masks.

All of it is NumPy on one decoded image; :func:`page` puts every measure of a page in one
flat record, so that an image is decoded once however many analyzers there are.
"""

from __future__ import annotations

import numpy as np

from . import pixels as px

# Smoothing kernels of the three smallest sizes; larger ones are Gaussian.
SMALL_KERNELS = {3: (0.25, 0.5, 0.25), 5: (0.0625, 0.25, 0.375, 0.25, 0.0625), 7: (0.03125, 0.109375, 0.21875, 0.28125, 0.21875, 0.109375, 0.03125)}
# Divisors of the page's height and shares of it, by which ruled lines are sought.
RULE_SCALES = ((4, 0.10), (5, 0.10), (7, 0.06), (10, 0.04))
# Shares of the width that are compared for a fold's running title, and their votes.
FOLD_STRIPS = ((0.04, 3), (0.06, 2), (0.08, 1), (0.10, 1))


def odd(n: int, least: int = 3) -> int:
    n = max(n, least)
    return n + 1 - n % 2


def blur(v: np.ndarray, size: int) -> np.ndarray:
    """Gaussian smoothing of a vector, mirrored at its ends."""
    if size in SMALL_KERNELS:
        k = np.array(SMALL_KERNELS[size])
    else:
        x = np.arange(size) - size // 2
        sigma = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
        k = np.exp(-x * x / (2 * sigma * sigma))
        k /= k.sum()
    half = size // 2
    if len(v) <= half:
        return np.asarray(v, dtype=float)
    return np.convolve(np.pad(np.asarray(v, dtype=float), half, mode="reflect"), k, mode="valid")


def spaced(places: np.ndarray, distance: float) -> list[int]:
    kept: list[int] = []
    for p in places.tolist():
        if not kept or p - kept[-1] >= distance:
            kept.append(p)
    return kept


def peaks(v: np.ndarray, least: float, distance: int) -> list[int]:
    """Inner places at or above ``least`` that are the largest of ``distance`` places before
    and ``distance - 1`` after, and at least ``distance`` apart."""
    v, d = np.asarray(v, dtype=float), max(int(distance), 1)
    if len(v) < 3:
        return []
    around = np.lib.stride_tricks.sliding_window_view(np.pad(v, (d, d - 1), constant_values=-np.inf), 2 * d).max(axis=1)
    at = np.flatnonzero((v >= least) & (v == around))
    return spaced(at[(at > 0) & (at < len(v) - 1)], d)


def runs(on: np.ndarray) -> list[tuple[int, int]]:
    step = np.diff(np.pad(np.asarray(on, dtype=np.int8), 1))
    return list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()))


def longest_run(on: np.ndarray) -> tuple[int, int]:
    """Start and length of the longest run, the first on ties; length 0 without one."""
    best = max(runs(on), key=lambda r: (r[1] - r[0], -r[0]), default=(0, 0))
    return best[0], best[1] - best[0]


def line_count(at: list[int], width: float) -> int | None:
    """How many columns lines at ``at`` part: their usual spacing (the fullest bin, then all
    within 40 % of it), and how often it fits between the outermost lines so spaced."""
    if len(at) < 3:
        return None
    gap = np.diff(np.array(at, dtype=float))
    bin_width = max(width * 0.03, 10)
    top = gap.max() + bin_width
    n = max(int(gap.max() / bin_width) + 1, 3)
    fullest = int(np.bincount(np.minimum((gap * n / top).astype(int), n - 1), minlength=n).argmax())
    usual = (fullest + 0.5) * top / n
    like = np.flatnonzero((gap >= 0.6 * usual) & (gap <= 1.4 * usual))
    if len(like) < 2:
        return None
    lines = round((at[like[-1] + 1] - at[like[0]]) / float(np.median(gap[like])))
    return lines if 3 <= lines <= 15 else None


def fold_center(gray: np.ndarray) -> int:
    """Where an open spread is cut: between the pair of dark bands of the middle third whose
    darkest columns are darkest together and which stand 2 to 15 % of the width apart;
    without such a pair, at the darkest column there."""
    h, w = gray.shape
    size = odd(w // 200)
    level = np.convolve(gray[int(h * 0.2) : max(int(h * 0.8), int(h * 0.2) + 1)].mean(axis=0), np.ones(size) / size, mode="same")
    a, b = int(w * 0.35), max(int(w * 0.65), int(w * 0.35) + 1)
    middle = level[a:b]
    bands = [(s + a, e + a) for s, e in runs(middle < np.median(middle) - 30) if e - s >= max(w // 500, 2)]
    pairs = [
        (level[x[0] : x[1]].min() + level[y[0] : y[1]].min(), i, j, (x[1] + y[0]) // 2)
        for i, x in enumerate(bands) for j, y in enumerate(bands) if j > i and int(w * 0.02) <= y[0] - x[1] <= int(w * 0.15)
    ]
    return min(pairs)[3] if pairs else a + int(middle.argmin())


def valley_cuts(v: np.ndarray, height: float, least: int = 10) -> list[tuple[int, int]]:
    """The pieces of a stretch that holds several characters of ``height``; the same rule as
    the relational kernel of this name."""
    n = len(v)
    half, apart = max(3, int(height * 0.15)), int(height * 0.5)
    at: list[int] = []
    if n / height > 1.2:
        if n > 2 * half:
            around = np.lib.stride_tricks.sliding_window_view(v, 2 * half + 1).min(axis=1)
            inner = np.asarray(v[half : n - half])
            at = spaced(np.flatnonzero((inner == around) & (inner < v.mean() * 0.35)) + half, apart)
        if not at:
            many = max(2, round(n / height))
            at = [k * n // many for k in range(1, many)]
    cuts = [0]
    for c in (*at, n):
        if c - cuts[-1] >= least:
            cuts.append(c)
        elif len(cuts) > 1:
            cuts[-1] = c
    if cuts[-1] != n:
        cuts.append(n)
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b - a >= least] or [(0, n)]


def inked_stretches(rows: np.ndarray, height: float, ink: float = 2, least: int = 10, tall: float = 1.4) -> list[tuple[int, int]]:
    """Runs of rows with more ink than ``ink``, at least ``least`` long; those taller than
    ``tall`` characters are cut."""
    out = []
    for s, e in runs(rows > ink):
        if e - s >= least:
            out += [(s + a, s + b) for a, b in valley_cuts(rows[s:e], height, least)] if e - s > tall * height else [(s, e)]
    return out


# --- measures of a page -------------------------------------------------------------


def _inner(a: np.ndarray, y: float, x: float) -> np.ndarray:
    """Without a share ``y`` of the rows and ``x`` of the columns on each side."""
    h, w = a.shape[:2]
    return a[int(h * y) : max(int(h * (1 - y)), int(h * y) + 1), int(w * x) : max(int(w * (1 - x)), int(w * x) + 1)]


def ruled_lines(gray: np.ndarray) -> tuple[int | None, bool]:
    """Columns of a page (or half) and whether ruled lines showed them; else text density."""
    roi = gray[int(len(gray) * 0.10) : max(int(len(gray) * 0.90), 1)]
    mask, (h, w) = px.ink(roi), roi.shape
    best: list[int] = []
    for part, share in RULE_SCALES:
        v = px.open_lines(mask, max(h // part, 15), 0).sum(axis=0)
        for distance in (max(w // 50, 3), max(w // 30, 3)):
            best = max(best, peaks(v, h * share, distance), key=len)
    count = line_count(best, w) if len(best) >= 4 else None
    if count is not None:
        return count, True
    dense = peaks(blur(mask.sum(axis=0), odd(w // 80)), h * 0.08, max(w // 20, 5))
    return (line_count(dense, w) if len(dense) >= 4 else None), False


def pictured(gray: np.ndarray) -> bool:
    """Much ink, or some ink without the columns of a text page."""
    mask = px.ink(gray)
    h, w = mask.shape
    roi = mask[int(h * 0.15) : int(h * 0.85), int(w * 0.1) : int(w * 0.9)]
    share = roi.mean() if roi.size else 0.0
    if share > 0.25 or share < 0.01:
        return bool(share > 0.25)
    return len(peaks(blur(roi.sum(axis=0), odd(roi.shape[1] // 80)), roi.shape[0] * 0.08, max(roi.shape[1] // 20, 5))) < 3


def _has_columns(mask: np.ndarray) -> bool:
    return len(peaks(mask.sum(axis=0), len(mask) * 0.08, max(mask.shape[1] // 20, 5))) >= 4


def colored_rules(image: np.ndarray) -> bool:
    """Three or more long upright lines of strong colour."""
    if image.ndim == 2:
        return False
    sat = px.hsv(image)[..., 1] > 80
    h, w = sat.shape
    roi = sat[int(h * 0.2) : int(h * 0.8)]
    if min(roi.shape) < 30:
        return False
    return len(peaks(px.open_lines(roi, max(len(roi) // 5, 15), 0).sum(axis=0), len(roi) * 0.08, max(w // 30, 3))) >= 3


def fold_votes(mask: np.ndarray) -> tuple[int, int]:
    """Votes that the fold's running title is at the left, and at the right: the edge strip
    whose rows differ more in ink, over several widths."""
    h, w = mask.shape
    rows = mask[int(h * 0.15) : max(int(h * 0.85), 1)]

    def varied(strip: np.ndarray) -> float:
        ink = strip.mean(axis=1)
        return float(ink.std()) if ink.mean() >= 0.005 else 0.0

    left = right = 0
    for share, weight in FOLD_STRIPS:
        n = max(int(w * share), 5)
        a, b = varied(rows[:, :n]), varied(rows[:, -n:])
        left, right = left + weight * (a > b), right + weight * (b > a)
    return left, right


def double_sides(gray: np.ndarray) -> list[bool | None]:
    """Of the left, right, top and bottom edge whether its border is two lines."""
    h, w = gray.shape
    n = int(min(h, w) * 0.15)
    if n < 15:
        return [None] * 4
    ys, xs = (np.linspace(k * 0.2, k * 0.8, 15).astype(int) for k in (h, w))
    cuts = (gray[ys, :n], gray[ys, w - n :][:, ::-1], gray[:n, xs].T, gray[h - n :, xs].T[:, ::-1])

    def double(v: np.ndarray) -> bool:
        dark = runs(v < v[int(n * 0.6) :].mean() - 30)
        if len(dark) < 2 or dark[1][0] - dark[0][1] < 2:
            return False
        return bool(v[dark[0][1] : dark[1][0]].mean() - v[dark[0][0] : dark[0][1]].min() >= 10)

    return [double(np.median(c.astype(float), axis=0)) for c in cuts]


def border_coverage(mask: np.ndarray) -> float:
    """Mean share of the four edges along which a long rule is there."""
    h, w = mask.shape
    n = max(int(min(h, w) * 0.15), 1)
    v, u = px.open_lines(mask, max(h // 6, 30), 0), px.open_lines(mask, max(w // 6, 30), 1)
    return float(np.mean([v[:, :n].any(axis=1).mean(), v[:, w - n :].any(axis=1).mean(), u[:n].any(axis=0).mean(), u[h - n :].any(axis=0).mean()]))


def spine_shadow(gray: np.ndarray, bands: int = 5) -> float:
    """How much of an edge a dark band follows from top to bottom, on the worse side."""
    h, w = gray.shape
    n, tall = max(w // 7, 20), h // bands
    if tall < 10:
        return 0.0

    def follows(strip: np.ndarray) -> float:
        centers = []
        for k in range(bands):
            level = strip[k * tall : h if k == bands - 1 else (k + 1) * tall].mean(axis=0)
            start, length = longest_run(level < np.median(level) - 25)
            centers.append(start + length // 2 if length >= max(int(n * 0.05), 2) else None)
        there = [c for c in centers if c is not None]
        straight = centers[0] is not None and centers[-1] is not None and len(there) >= 4 and max(there) - min(there) <= n * 0.20
        return len(there) / bands if straight else 0.0

    return max(follows(gray[:, :n]), follows(gray[:, w - n :]))


def photo_margin(gray: np.ndarray) -> tuple[float, str | None]:
    """How sure a uniform margin lies around the page, and its colour."""
    h, w = gray.shape
    n = max(min(h, w) // 15, 10)
    edges = [gray[:n], gray[h - n :], gray[:, :n], gray[:, w - n :]]
    level, spread = float(np.mean([e.mean() for e in edges])), float(np.mean([e.std() for e in edges]))
    middle = gray[h // 4 : 3 * h // 4, w // 4 : 3 * w // 4]
    off = level - (float(middle.mean()) if middle.size else level)
    if off > 30:
        return min(1.0, off / 60), "white"
    if off < -30 and spread < 40:
        return min(1.0, -off / 60), "black"
    return (min(0.8, abs(off) / 40), "other") if abs(off) > 15 and spread < 30 else (0.0, None)


def characters(mask: np.ndarray) -> int | None:
    """Characters of a text column: the median over up to five strips of their rows' peaks."""
    h, w = mask.shape
    c = mask[int(h * 0.1) : h - int(h * 0.1), int(w * 0.15) : w - int(w * 0.15)]
    ch, cw = c.shape
    strips = min(5, cw // 20)
    if min(ch, cw) < 50 or strips < 1:
        return None
    half, counts = max(cw // 30, 5) // 2, []
    for x in np.linspace(cw * 0.2, cw * 0.8, strips).astype(int):
        v = blur(c[:, max(0, x - half) : min(cw, x + half)].mean(axis=1) * 255, odd(ch // 80))
        counts.append(len(peaks(v, v.max() * 0.15, ch // 35)))
    counts = [n for n in counts if 10 <= n <= 35]
    return int(np.median(counts)) if counts else None


def small_notes(mask: np.ndarray) -> bool:
    """Whether two or more text columns show two humps across."""
    h, w = mask.shape
    c = mask[int(h * 0.15) : h - int(h * 0.15), int(w * 0.12) : w - int(w * 0.12)]
    ch, cw = c.shape
    if min(ch, cw) < 50:
        return False
    apart = cw // 20
    at = peaks(blur(c.sum(axis=0), odd(cw // 60)), ch * 0.1, apart)
    if len(at) < 3:
        return False

    def dual(v: np.ndarray) -> bool:
        n = len(v)
        if n < 8:
            return False
        s = blur(v, odd(n // 10))
        humps = peaks(s, s.max() * 0.3, max(n // 6, 1)) if s.max() >= 5 else []
        if len(humps) != 2 or humps[1] - humps[0] < 2:
            return False
        return bool(s[humps[0] : humps[1]].min() < 0.25 * (s[humps[0]] + s[humps[1]]) / 2)

    return sum(dual(c[:, max(0, x - apart // 2) : min(cw, x + apart // 2)].sum(axis=0)) for x in at) >= 2


def distances(mask: np.ndarray) -> np.ndarray:
    """Distance of each true cell to the nearest false one (cells beyond the edge are far), by
    two passes of a 3 x 3 chamfer, rows at a time."""
    near, slant = 0.955, 1.3693
    d = np.where(mask, np.inf, 0.0)

    def along(row: np.ndarray) -> np.ndarray:  # the same row's neighbours, both ways
        k = np.arange(len(row)) * near
        left = np.minimum.accumulate(row - k) + k
        return np.minimum(left, (np.minimum.accumulate((row + k)[::-1])[::-1]) - k)

    def sweep(rows: range) -> None:
        before = None
        for y in rows:
            if before is not None:
                p = np.pad(d[before], 1, constant_values=np.inf)
                d[y] = np.minimum(d[y], np.minimum(p[1:-1] + near, np.minimum(p[:-2], p[2:]) + slant))
            d[y] = along(d[y])
            before = y

    sweep(range(len(d)))
    sweep(range(len(d) - 1, -1, -1))
    return d


def letter_spread(gray: np.ndarray) -> tuple[float | None, float | None]:
    """Variation (deviation over mean) of the areas and of the stroke widths of the parts
    that are as large as letters; null with fewer than ten."""
    h, w = gray.shape
    roi = gray[int(h * 0.12) : h - int(h * 0.12), int(w * 0.15) : w - int(w * 0.15)]
    if min(roi.shape) < 50:
        return None, None
    n, label = px.components(px.ink(roi))
    if n + 1 < 10:
        return None, None
    ys, xs = np.nonzero(label)
    k = label[ys, xs]
    area = np.bincount(k, minlength=n + 1)
    low, high = (np.full((2, n + 1), 1 << 30), np.full((2, n + 1), -1))
    for axis, at in enumerate((ys, xs)):
        np.minimum.at(low[axis], k, at)
        np.maximum.at(high[axis], k, at)
    tall, wide = high[0] - low[0] + 1, high[1] - low[1] + 1
    short, long = np.minimum(tall, wide), np.maximum(tall, wide)
    ok = (area >= roi.size * 0.0005) & (area <= roi.size * 0.02) & (short >= max(roi.shape) * 0.01) & (long <= 5 * np.maximum(short, 1))
    letters = [j for j in np.flatnonzero(ok) if j > 0]
    strokes = []
    for j in letters:
        own = label[low[0, j] : high[0, j] + 1, low[1, j] : high[1, j] + 1] == j
        if not own.all():
            width = distances(own)[own]
            if len(width) > 5 and width.mean() > 0.5:
                strokes.append(float(width.mean()))
    cv = lambda x: float(np.std(x) / np.mean(x)) if len(x) >= 10 else None
    return cv(area[letters].astype(float)), cv(strokes)


def red_shares(image: np.ndarray, hsv: np.ndarray, gray: np.ndarray, mask: np.ndarray) -> tuple[float | None, int, int]:
    """Share of red in the inner ink (null with little of it), and of the four edge strips
    with dark cells how many are red, and how many there are."""
    hue, sat = hsv[..., 0], hsv[..., 1]
    red = (hue < 10) | (hue > 170)
    inner = _inner(gray, 0.15, 0.15)
    on = px.ink(inner)
    text = float((_inner(red & (sat > 50), 0.15, 0.15) & on).sum() / on.sum()) if on.sum() >= 100 else None
    h, w = gray.shape
    n, reds, strips = int(min(h, w) * 0.12), 0, 0
    for s in (np.s_[:, :n], np.s_[:, w - n :], np.s_[:n, :], np.s_[h - n :, :]):
        g = gray[s]
        dark = g < np.median(g) - 30 if g.size else np.zeros(0, bool)
        if dark.sum() >= 20:
            strips += 1
            reds += bool((red & (sat > 40))[s][dark].mean() > 0.3)
    return text, reds, strips


# --- frames and ruled lines ---------------------------------------------------------

# Divisors of the height and of the width by which lines of all lengths are opened.
LINE_SCALES = {0: (4, 6, 10, 15, 25), 1: (4, 8, 16)}
FRAME_SCHEMA = (
    "margin_top int, margin_bottom int, margin_left int, margin_right int, margin_color string, border_top int, border_bottom int, border_left int, border_right int, "
    "content_top int, content_bottom int, content_left int, content_right int"
)


def colored_ink(image: np.ndarray) -> np.ndarray:
    """Cells of red, blue or other strong colour, which a gray threshold does not see."""
    if image.ndim == 2:
        return np.zeros(image.shape, dtype=bool)
    h, s, v = np.moveaxis(px.hsv(image), -1, 0)
    hued = (h <= 10) | (h >= 160) | ((h >= 100) & (h <= 130))
    return (hued & (s >= 80) & (v >= 60)) | ((s > 120) & (v > 50))


def ruled_mask(image: np.ndarray) -> np.ndarray:
    """The ruled lines of a page without its letters: strokes that are long once small breaks
    are bridged, faint and coloured ones among them."""
    gray = px.gray(image)
    dark = gray <= max(px.otsu(gray), min(int(px.otsu(gray) * 1.5), 200))
    on = dark | colored_ink(image)
    out = np.zeros_like(on)
    for axis, parts in LINE_SCALES.items():
        for part in parts:
            least = max(on.shape[axis] // part, 8)
            reach = max(min(least // 10, 15), 2) // 2
            bridged = on.copy()
            for k in range(1, reach + 1):
                ahead, back = [slice(None)] * 2, [slice(None)] * 2
                ahead[axis], back[axis] = slice(k, None), slice(None, -k)
                bridged[tuple(ahead)] |= on[tuple(back)]
                bridged[tuple(back)] |= on[tuple(ahead)]
            out |= px.open_lines(bridged, least, axis) & on
    return out


def margins(gray: np.ndarray, deep: float = 0.15) -> dict:
    """Rows and columns at each edge that are even and unlike the page's middle, which a
    photograph's background is and a page's own blank is not; and their colour."""
    h, w = gray.shape
    middle = float(gray[h // 3 : max(2 * h // 3, h // 3 + 1), w // 3 : max(2 * w // 3, w // 3 + 1)].mean())
    across, along = gray[:, int(w * 0.2) : max(int(w * 0.8), 1)].astype(float), gray[int(h * 0.2) : max(int(h * 0.8), 1)].astype(float).T
    out = {}
    for side, lines, n in (("top", across, h), ("bottom", across[::-1], h), ("left", along, w), ("right", along[::-1], w)):
        some = lines[: int(n * deep)]
        ok = (some.std(axis=1) <= 20) & (np.abs(some.mean(axis=1) - middle) >= 30)
        out[f"margin_{side}"] = int(np.argmin(np.append(ok, False)))
    t, b, l, r = (out[f"margin_{s}"] for s in ("top", "bottom", "left", "right"))  # noqa: E741
    strips = [x.mean() for n, x in ((t, gray[:t]), (b, gray[h - b :]), (l, gray[:, :l]), (r, gray[:, w - r :])) if n > 5]
    level = float(np.mean(strips)) if strips else None
    return out | {"margin_color": "none" if level is None else "white" if level > 200 else "black" if level < 60 else "other"}


def frame(image: np.ndarray) -> dict:
    """Margins, the outermost border lines inside them and the content within those, named as
    in ``FRAME_SCHEMA``.  A border is the first row or column from its edge that a long line
    covers for 15 % of the page, else one much darker than the middle, else 5 % in."""
    gray = px.gray(image)
    h, w = gray.shape
    out = margins(gray)
    top, bottom, left, right = out["margin_top"], h - out["margin_bottom"], out["margin_left"], w - out["margin_right"]
    if min(bottom - top, right - left) < 50:
        top, bottom, left, right = 0, h, 0, w
    page = gray[top:bottom, left:right]
    mask = px.ink(page) | colored_ink(image[top:bottom, left:right])
    ends = {}
    for axis, base, names in ((1, top, ("top", "bottom")), (0, left, ("left", "right"))):
        n, span = page.shape[1 - axis], page.shape[axis]
        long = px.open_lines(mask, max(span // (16 if axis == 1 else 10), 15), axis).sum(axis=axis) > span * 0.15
        level = page.mean(axis=axis)
        dark = level < level[n // 4 : max(3 * n // 4, n // 4 + 1)].mean() - 40
        skip = max(int(n * 0.01), 2)
        for name, places, usual in ((names[0], np.arange(skip, n // 2), int(n * 0.05)), (names[1], np.arange(n - 1 - skip, n // 2, -1), int(n * 0.95))):
            hit = next((places[on[places]][0] for on in (long, dark) if on[places].any()), usual)
            ends[name] = base + int(hit)
    inset = max((ends["right"] - ends["left"]) // 100, 3)
    content = {"top": ends["top"] + inset, "bottom": ends["bottom"] - inset, "left": ends["left"] + inset, "right": ends["right"] - inset}
    return out | {f"border_{k}": v for k, v in ends.items()} | {f"content_{k}": v for k, v in content.items()}


SCHEMA = (
    "aspect double, symmetry double, gap double, rule double, v_cut double, h_cut double, is_table boolean, is_mixed boolean, "
    "pictured boolean, pictured_right boolean, lines int, ruled boolean, lines_right int, ruled_right boolean, colored_rules boolean, "
    "colored_right boolean, fold_left int, fold_right int, sides array<boolean>, coverage double, spine double, margin double, margin_color string, "
    "characters int, notes boolean, area_cv double, stroke_cv double, saturated double, hue_bins array<bigint>, text_red double, red_strips int, strips int"
)


def page(image: np.ndarray) -> dict:
    """Every measure of one page, named as in ``SCHEMA``."""
    gray = px.gray(image)
    mask = px.ink(gray)
    h, w = gray.shape
    right = image[:, min(int(w * 0.525), w - 1) :]
    inner = mask[int(h * 0.15) : max(int(h * 0.85), int(h * 0.15) + 1), int(w * 0.45) : max(int(w * 0.55), int(w * 0.45) + 1)]
    fold = mask[int(h * 0.1) : max(int(h * 0.9), int(h * 0.1) + 1), int(w * 0.40) : max(int(w * 0.60), int(w * 0.40) + 1)].mean(axis=0).min()
    n = max(w // 20, 5)
    a, b = gray[:, max(w // 2 - n, 0) : w // 2].astype(float), gray[:, w // 2 : w // 2 + n].astype(float)
    m = min(a.shape[1], b.shape[1])
    symmetry = 1 - float(np.abs(a[:, a.shape[1] - m :] - b[:, :m][:, ::-1]).mean()) / 255 if m else 1.0
    rows = mask[int(h * 0.30) : max(int(h * 0.70), int(h * 0.30) + 1), int(w * 0.1) : max(int(w * 0.9), int(w * 0.1) + 1)].mean(axis=1)
    empty = longest_run(rows < 0.02)[1]
    least = max(h * 0.02, 30)
    across = px.open_lines(mask, max(w // 15, 20), 1).sum(axis=1)
    table = [p for p in peaks(across, w * 0.1, max(h // 40, 5)) if h * 0.25 < p < h * 0.75]
    top, bottom = mask[int(h * 0.1) : max(h // 2, 1), int(w * 0.1) : max(int(w * 0.9), 1)], mask[h // 2 : max(int(h * 0.9), h // 2 + 1), int(w * 0.1) : max(int(w * 0.9), 1)]
    lines, ruled = ruled_lines(gray)
    lines_right, ruled_right = ruled_lines(px.gray(right))
    fold_left, fold_right = fold_votes(mask)
    margin, margin_color = photo_margin(gray)
    area_cv, stroke_cv = letter_spread(gray)
    color = {"saturated": 0.0, "hue_bins": [0] * 36, "text_red": None, "red_strips": 0, "strips": 0}
    if image.ndim == 3:
        hsv = px.hsv(image)
        on = hsv[..., 1] > 30
        text_red, reds, strips = red_shares(image, hsv, gray, mask)
        color = {"saturated": float(on.mean()), "hue_bins": np.bincount(np.minimum(hsv[..., 0][on] // 5, 35), minlength=36).tolist(), "text_red": text_red, "red_strips": reds, "strips": strips}
    return {
        "aspect": w / h, "symmetry": symmetry, "gap": float(fold), "rule": float(px.open_lines(inner, max(len(inner) // 3, 20), 0).mean()),
        "v_cut": min(1.0, (0.01 - float(fold)) * 50 + 0.7) if w / h >= 0.95 and fold < 0.01 else 0.0,
        "h_cut": min(1.0, empty / 30) if w / h <= 1.2 and empty >= least else 0.0,
        "is_table": bool(table), "is_mixed": _has_columns(top) != _has_columns(bottom), "pictured": pictured(gray), "pictured_right": pictured(px.gray(right)),
        "lines": lines, "ruled": ruled, "lines_right": lines_right, "ruled_right": ruled_right, "colored_rules": colored_rules(image), "colored_right": colored_rules(right),
        "fold_left": int(fold_left), "fold_right": int(fold_right), "sides": double_sides(gray), "coverage": border_coverage(mask), "spine": spine_shadow(gray),
        "margin": margin, "margin_color": margin_color, "characters": characters(mask), "notes": small_notes(mask), "area_cv": area_cv, "stroke_cv": stroke_cv, **color,
    }
