"""Pixel kernels against definitions, and synthetic pages through the image source."""

import json
import struct
import zlib

import numpy as np
import pytest
from leafgrid.functions import measures as ms
from leafgrid.functions import pixels as px
from leafgrid.operators import pages as pg
from leafgrid.sources import scan
from pyspark.sql import functions as F


def png(image):
    """A PNG of an RGB or gray array, by the standard library."""
    a = np.asarray(image, dtype=np.uint8)
    h, w = a.shape[:2]
    raw = b"".join(b"\0" + a[y].tobytes() for y in range(h))
    chunk = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0 if a.ndim == 2 else 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("pages") / "book1"
    d.mkdir()
    table = np.full((400, 500, 3), 255, np.uint8)
    for y in (40, 140, 240, 340):
        table[y : y + 3, 50:450] = 0
    for x in (50, 150, 300, 447):
        table[40:343, x : x + 3] = 0
    table[150:154, 60:140] = 0  # a weak line close to a strong one
    spread = np.full((200, 400, 3), 250, np.uint8)
    spread[20:180, 198:202] = 10
    colored = np.full((60, 60, 3), (230, 200, 120), np.uint8)
    for name, image in (("p_1", table), ("p_2", spread), ("p_3", colored), ("p_1_annotated", table), ("gray_4", np.full((30, 20), 200, np.uint8))):
        (d / f"{name}.png").write_bytes(png(image))
    (d / "bad_9.png").write_bytes(b"no image")
    (d / "notes.txt").write_text("x")
    return str(d)


@pytest.fixture(scope="module")
def pages(spark, folder):
    return scan.read_pages(spark, f"file://{folder}").withColumn("book", F.lit("book1"))


def test_scan(pages):
    got = {r["stem"]: (r["page_no"], r["w"]) for r in pages.select("stem", "page_no", F.col("image.width").alias("w")).collect()}
    assert got == {"p_1": (1, 500), "p_2": (2, 400), "p_3": (3, 60), "gray_4": (4, 20)}


def test_scan_limits(spark):
    files = spark.createDataFrame([(f"/b/{n}",) for n in ("x_10.PNG", "x_2.jpg", "x_3_lsd.png", "cover.tif", "x_5.gif", "x_7.bmp")], "path string")
    stems = lambda d: [r["stem"] for r in d.orderBy("path").collect()]
    assert stems(scan.select_pages(files, skip_pages=(7,))) == ["cover", "x_10", "x_2"]
    assert stems(scan.select_pages(files, limit=2)) == ["cover", "x_10"]
    assert stems(scan.select_pages(files, names=spark.createDataFrame([("x_2",)], "stem string"))) == ["x_2"]


def test_table_grid(spark, pages):
    lines = pg.table_lines(pages.where("stem = 'p_1'"), ["book", "stem"])
    got = {a: sorted(r["pos"] for r in lines.where(F.col("axis") == a).collect()) for a in "hv"}
    assert got == {"h": [41, 141, 241, 341], "v": [51, 151, 301, 448]}
    cells = pg.table_cells(lines, ["book", "stem"])
    assert cells.count() == 9
    words = spark.createDataFrame([("book1", "p_1", "b", 0.9, 100.0, 100.0), ("book1", "p_1", "a", 0.7, 100.0, 60.0), ("book1", "p_1", "no", 0.1, 100.0, 70.0)], "book string, stem string, text string, confidence double, x double, y double")
    text = {(r["row"], r["col"]): (r["text"], round(r["confidence"], 3)) for r in pg.cell_texts(cells, words, ["book", "stem"]).collect()}
    assert text[0, 0] == ("ab", 0.8) and text[2, 2] == ("", 0.0) and len(text) == 9
    assert pg.table_cells(pg.table_lines(pages.where("stem = 'p_3'"), ["book", "stem"]), ["book", "stem"]).count() == 0


def test_halves_are_cut_at_the_fold(pages):
    p = pages.where("stem = 'p_2'")
    got = pg.halves(p, ["book", "stem"]).orderBy("part").collect()
    assert [(r["sub"], r["width"], r["height"], r["center"]) for r in got] == [("right", 201, 200, 199), ("left", 199, 200, 199)]
    assert [r["width"] for r in pg.halves(p, ["book", "stem"], fixed=True).orderBy("part").collect()] == [200, 200]
    doc = json.loads(pg.cut_document(pg.halves(p, ["book", "stem"]), ["book", "stem"]).first()["cut"])
    assert doc["center"] == 199 and [x["sub"] for x in doc["parts"]] == ["right", "left"]


def test_fold_lies_between_two_border_lines():
    gray = np.full((200, 1000), 240, np.uint8)
    gray[:, 470:476] = gray[:, 530:536] = 20
    gray[:, 400:404] = 100  # a weaker line nearer to the middle third's edge
    assert ms.fold_center(gray) == (476 + 530) // 2
    gray[:, 530:536] = gray[:, 400:404] = 240
    assert 470 <= ms.fold_center(gray) <= 476
    assert 350 <= ms.fold_center(np.full((50, 1000), 200, np.uint8)) < 650


def test_segments_of_ruled_lines():
    mask = np.zeros((300, 400), bool)
    mask[50:53, 20:380] = True
    mask[20:280, 100:102] = True
    for x in range(20, 380):  # a slanted line, 1 in 60
        mask[200 + x // 60, x] = True
    mask[120:128, 200:212] = True  # a blot
    got = sorted((round(s["x1"]), round(s["y1"]), round(s["x2"]), round(s["y2"]), round(s["width"], 1)) for s in px.line_segments(mask))
    assert got[0] == (20, 51, 379, 51, 3.0) or got[1] == (20, 51, 379, 51, 3.0)
    assert (100, 20, 100, 279, 2.0) in got or (101, 20, 101, 279, 2.0) in got
    slanted = [s for s in px.line_segments(mask) if s["y1"] > 190 and s["x2"] - s["x1"] > 100]
    assert len(slanted) == 1 and abs((slanted[0]["y2"] - slanted[0]["y1"]) / (slanted[0]["x2"] - slanted[0]["x1"]) - 1 / 60) < 0.003
    assert len(got) == 3 and px.line_segments(np.zeros((40, 40), bool)) == []


def test_masks_are_the_ink(pages):
    r = pg.ink_masks(pages.where("stem = 'p_1'"), ["book", "stem"]).first()
    mask = np.unpackbits(np.frombuffer(r["bits"], np.uint8))[: r["height"] * r["width"]].reshape(r["height"], r["width"])
    assert mask[40:43, 50:450].all() and mask[5].sum() == 0 and len(r["bits"]) == 400 * 500 // 8


def test_distances_and_peaks():
    mask = np.zeros((9, 11), bool)
    mask[1:8, 1:10] = True
    d = ms.distances(mask)
    assert d[0, 0] == 0 and abs(d[1, 5] - 0.955) < 1e-9 and abs(d[4, 5] - 4 * 0.955) < 1e-9
    v = np.zeros(60)
    v[[10, 12, 30, 50]] = (5, 6, 4, 9)
    assert ms.peaks(v, 1, 5) == [12, 30, 50] and ms.peaks(v, 5, 5) == [12, 50]
    assert ms.line_count(list(range(0, 90, 10)), 300) == 8 and ms.line_count([1, 2], 300) is None
    assert ms.runs(np.array([1, 1, 0, 1], bool)) == [(0, 2), (3, 4)] and ms.longest_run(np.zeros(3, bool)) == (0, 0)


def test_table_document(spark, pages):
    keys = ["book", "stem"]
    lines = pg.table_lines(pages.where("stem = 'p_1'"), keys)
    words = spark.createDataFrame([("book1", "p_1", "b", 0.9, 100.0, 100.0)], "book string, stem string, text string, confidence double, x double, y double")
    doc = json.loads(pg.table_document(pg.cell_texts(pg.table_cells(lines, keys), words, keys), lines, keys).first()["result"])
    assert doc["table"] == {"rows": 3, "cols": 3, "h_lines": [41, 141, 241, 341], "v_lines": [51, 151, 301, 448]}
    assert [(c["row"], c["col"], c["text"], c["confidence"], c["bbox"]) for c in doc["cells"]] == [(0, 0, "b", 0.9, [51, 41, 151, 141])]


def test_run_and_component_kernels():
    rng = np.random.default_rng(1)
    mask = rng.random((14, 17)) < 0.55
    want = np.zeros(mask.shape, int)
    for y, row in enumerate(mask):
        x = 0
        while x < 17:
            e = x
            while e < 17 and row[e]:
                e += 1
            want[y, x:e] = e - x
            x = max(e, x + 1)
    assert (px.run_lengths(mask) == want).all()
    n, label = px.components(mask)
    seen, parts = set(), 0
    for y, x in zip(*np.nonzero(mask)):
        if (y, x) in seen:
            continue
        parts += 1
        stack, own = [(y, x)], set()
        while stack:
            q = stack.pop()
            if q in own or not (0 <= q[0] < 14 and 0 <= q[1] < 17) or not mask[q]:
                continue
            own.add(q)
            stack += [(q[0] + a, q[1] + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
        seen |= own
        assert len({label[q] for q in own}) == 1
    assert n == parts


def test_otsu_and_skew():
    x = np.concatenate([np.full(300, 40), np.full(700, 200)]).astype(np.uint8)
    assert 40 <= px.otsu(x) < 200
    page = np.full((200, 200), 255, np.uint8)
    page[20:180:20, 20:180] = 0
    page[21:181:20, 20:180] = 0
    assert abs(px.skew(px.rotate(page, 1.5)) + 1.5) < 0.3
    assert (px.adaptive_binary(page) == 0).sum() > 0 and px.without_lines(page).min() > 0
    h = px.hsv(np.array([[[0, 0, 255], [0, 255, 0], [255, 0, 0], [128, 128, 128]]], np.uint8))[0]
    assert h[:, 0].tolist() == [0, 60, 120, 0] and h[3, 1] == 0
