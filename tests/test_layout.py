"""Synthetic ruled pages: the frame and columns that were drawn are found again."""

import random

import numpy as np
import pytest
from leafgrid.operators import layout

KEYS = ["book", "page"]


def ruled(rng, page, n, extra=(), width=1000, height=1400):
    """Double frame, n columns, lines broken (< 60) and jittered."""
    xs = np.linspace(110, 890, n + 1)
    lines = [("v", x, 100, 1300) for x in xs] + [("v", 80, 70, 1330), ("v", 920, 70, 1330), ("h", 100, 110, 890), ("h", 1300, 110, 890), ("h", 70, 80, 920), ("h", 1330, 80, 920), *extra]
    rows = []
    for axis, at, a, b in lines:
        s = a
        while s < b:
            e = min(b, s + rng.randint(120, 400))
            p, q = at + rng.uniform(-1, 1), at + rng.uniform(-1, 1)
            ends = (p, float(s), q, float(e)) if axis == "v" else (float(s), p, float(e), q)
            rows.append(("b", page, *map(float, ends), rng.uniform(2, 4)))
            s = e + rng.randint(5, 40)
    rows += [("b", page, 300.0, 400.0, 330.0, 420.0, 1.0), ("b", page, 10.0, 10.0, 12.0, 11.0, 1.0)]
    rng.shuffle(rows)
    return rows, xs


@pytest.fixture(scope="module")
def found(spark):
    rng = random.Random(7)
    rows, truth = [], {}
    for page, n in enumerate([3, 8, 9, 14]):
        extra = [("v", float(np.linspace(110, 890, n + 1)[2] + 12.0 * 1.4), 300, 900)] if n == 8 else []
        got, xs = ruled(rng, page, n, extra)
        rows += got
        truth[page] = xs
    segments = spark.createDataFrame(rows, "book string, page int, x1 double, y1 double, x2 double, y2 double, width double")
    pages = spark.createDataFrame([("b", p, 1000, 1400) for p in truth] + [("b", 99, 500, 700)], "book string, page int, page_width int, page_height int")
    return segments, pages, truth


def test_columns_are_recovered(found):
    segments, pages, truth = found
    got = {}
    for r in layout.detect(segments, pages, KEYS)["columns"].collect():
        got.setdefault(r["page"], []).append((r["idx"], r["left_x"], r["right_x"], r["width"]))
    for page, xs in truth.items():
        cols = sorted(got[page])
        assert [c[0] for c in cols] == list(range(1, len(xs)))
        assert np.allclose(sorted([c[1] for c in cols] + [max(c[2] for c in cols)]), xs, atol=4)
        assert all(a[1] >= b[2] - 1e-9 for a, b in zip(cols, cols[1:]))
        assert sum(c[3] for c in cols) == pytest.approx(max(c[2] for c in cols) - min(c[1] for c in cols))
    assert got[99] == [(1, 0.0, 500.0, 500.0)]


def test_frame_has_two_layers(found):
    segments, pages, truth = found
    clusters = layout.cluster(layout.classify(segments), KEYS)
    pairs = {(r["page"], r["side"]): r for r in layout.frame_pairs(clusters, pages, KEYS).collect()}
    for page in truth:
        for side, a, b in (("left", 80, 110), ("right", 920, 890), ("top", 70, 100), ("bottom", 1330, 1300)):
            r = pairs[page, side]
            assert abs(r["outer"]["intercept"] - a) < 4 and abs(r["inner"]["intercept"] - b) < 4
    for r in clusters.collect():
        assert all(b["s"] - a["e"] > 60 for a, b in zip(r["segments"], r["segments"][1:]))


def test_stats_and_summary(found):
    segments, pages, truth = found
    stats = {r["page"]: r for r in layout.column_stats(layout.detect(segments, pages, KEYS)["columns"], KEYS, 9).collect()}
    assert all(stats[p]["num_columns"] == len(x) - 1 and stats[p]["is_uniform"] for p, x in truth.items())
    assert stats[2]["mismatch"] is None and stats[1]["mismatch"]["detected"] == 8
    total = {r["page"]: r for r in layout.summary(layout.classify(segments), KEYS).collect()}
    assert all(r["total"] == r["vertical"] + r["horizontal"] + r["other"] and r["other"] == 1 for r in total.values())


def test_fit_equals_a_residual_weighted_fit():
    rng = np.random.default_rng(2)
    line, c, p, w = layout._Line(), [], [], []
    for _ in range(8):
        x = np.sort(rng.uniform(0, 900, 2))
        y = 0.01 * x + 40 + rng.normal(size=2)
        half = max((x[1] - x[0]) / 2, 1.0)
        line.add(x, y, half)
        c += [*x]
        p += [*y]
        w += [half, half]
    line.fit()
    assert (line.slope, line.intercept) == pytest.approx(tuple(np.polyfit(c, p, 1, w=w)))
