import json
import random

import pytest
from leafgrid.operators import grid

KEYS = ["page", "col"]


def plain(col, regions, words):
    """The same by loops."""
    top, bottom, n = col
    h = (bottom - top) / n
    groups = []
    for r in sorted(regions):
        if groups and r[0] - groups[-1][-1][1] <= 3 * h:
            groups[-1].append(r)
        else:
            groups.append([r])
    read = sum(len(w[1]) for w in words)
    if groups:
        regions = max(groups, key=lambda g: ((-abs(len(g) - read) if read else 0), len(g), g[-1][1] - g[0][0]))
    regions = [(max(a, top), min(b, bottom)) for a, b in regions]
    regions = [r for r in regions if r[1] - r[0] >= 5]
    words = sorted(words, key=lambda w: ((w[2] + w[3]) / 2, w[0]))
    if words:
        heights = sorted(w[3] - w[2] for w in words)
        m = len(heights)
        reach = 1.5 * (heights[m // 2] + heights[(m - 1) // 2]) / 2
        own = {k: [] for k in range(m)}
        for a, b in regions:
            c = (a + b) / 2
            near = sorted((not w[2] <= c <= w[3], abs(c - (w[2] + w[3]) / 2), w[0], k) for k, w in enumerate(words))[0]
            if not near[0] or near[1] <= reach:
                own[near[3]].append((a, b))
        regions = [(min([w[2], *(a for a, _ in own[k])]), max([w[3], *(b for _, b in own[k])])) for k, w in enumerate(words)]
    regions = regions[:n]
    start = max(0, min(n - len(regions), int(((regions[0][0] + regions[0][1]) / 2 - top) / h))) if regions else 0
    cells = []
    for i in range(n):
        k = i - start
        if regions and 0 <= k < len(regions):
            text = words[k][1] if k < len(words) else None
            cells.append(["char", i, round(regions[k][0], 2), round(regions[k][1], 2), text])
        else:
            cells.append(["empty", i, round(top + i * h, 2), round(top + (i + 1) * h, 2), None])
    for a, b in zip(cells, cells[1:]):
        if a[3] > b[2]:
            if a[0] == "empty" and b[0] == "char":
                a[3] = b[2]
            elif b[0] == "empty":
                b[2] = a[3]
    for c in cells:
        c[3] = max(c[2], c[3])
    return cells, h


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(11)
    cols, regions, words = {}, [], []
    for page in range(3):
        for col in range(1, 7):
            n = rng.randint(4, 9)
            cols[page, col] = (100.0, 100.0 + 40 * n, n)
            kind = (page * 6 + col) % 5
            filled = [] if kind == 0 else sorted(rng.sample(range(n), rng.randint(1, n)))
            if kind == 4:
                filled = list(range(1, n))
            for k, slot in enumerate(filled):
                a = 100.0 + 40 * slot + rng.randint(1, 8)
                b = a + rng.randint(24, 34)
                if kind == 2:
                    regions += [(page, col, a, a + 11.0), (page, col, a + 13, b)]
                else:
                    regions.append((page, col, a, b))
                if kind in (2, 3):
                    words.append((page, col, k, rng.choice("日月火水"), a + 1, b - 1))
    c = spark.createDataFrame([(p, q, *v) for (p, q), v in cols.items()], "page int, col int, top double, bottom double, expected int")
    r = spark.createDataFrame(regions, "page int, col int, r_top double, r_bottom double")
    w = spark.createDataFrame(words, "page int, col int, word_id int, text string, w_top double, w_bottom double")
    return cols, regions, words, c, r, w


def test_cells_match_loops(made):
    cols, regions, words, c, r, w = made
    got = {}
    for x in grid.cells(c, r, w, KEYS).orderBy("page", "col", "pos").collect():
        got.setdefault((x["page"], x["col"]), []).append(x)
    for key, col in cols.items():
        want, h = plain(col, [x[2:] for x in regions if x[:2] == key], [x[2:] for x in words if x[:2] == key])
        own = [x for x in got[key] if x["type"] != "margin"]
        assert len(own) == col[2] and [x["index"] for x in own] == list(range(col[2]))
        assert [(x["type"], x["text"]) for x in own] == [(a[0], a[4]) for a in want]
        assert [x["y_top"] for x in own[1:]] == [a[2] for a in want[1:]] and [x["y_bottom"] for x in own[:-1]] == [a[3] for a in want[:-1]]
        edge = got[key]
        assert abs(edge[0]["y_top"] - col[0]) <= 1 and abs(edge[-1]["y_bottom"] - col[1]) <= 1
        assert all(x["y_bottom"] - x["y_top"] <= 0.5 * h for x in edge if x["type"] == "margin")


def test_regions_of_a_profile(spark):
    v = [0] * 5 + [9] * 30 + [0] * 4 + [9] * 6 + [0] * 5 + [9] * 60 + [1] * 5
    df = spark.createDataFrame([(1, 1, i, float(x)) for i, x in enumerate(v)], "page int, col int, pos int, v double")
    from pyspark.sql import functions as F

    got = [(r["r_top"], r["r_bottom"]) for r in grid.inked_regions(df, KEYS, F.lit(30.0)).orderBy("r_top").collect()]
    assert got == [(5.0, 35.0), (50.0, 80.0), (80.0, 110.0)]


def test_page_json(made):
    _, _, words, c, r, w = made
    cells = grid.cells(c, r, w, KEYS)
    docs = {x["page"]: json.loads(x["result"]) for x in grid.page_json(cells, c, KEYS, "col").collect()}
    assert sorted(docs) == [0, 1, 2] and [q["col_index"] for q in docs[0]["columns"]] == list(range(6))
    text = "".join(ch["char"] for p in docs.values() for q in p["columns"] for ch in q["characters"])
    assert len(text) == len(words) and all(ch["type"] in ("normal", "empty") for ch in docs[1]["columns"][0]["characters"])
