"""From page images to result documents, end to end."""

import json

import numpy as np
import pytest
from leafgrid import api
from leafgrid.functions import measures as ms
from leafgrid.operators import grid, interlinear
from leafgrid.operators import sequence as sq
from leafgrid.sources import profiles as pf
from leafgrid.sources import scan
from pyspark.sql import functions as F

from .test_pages import png

COLUMNS, CHARS = 8, 10


def ruled_page(empty=()):
    """A double frame, eight columns of ten blocks, some columns empty; 700 by 900."""
    page = np.full((900, 700, 3), 255, np.uint8)

    def box(t, b, l, r, n):  # noqa: E741
        page[t : t + n, l:r] = page[b - n : b, l:r] = 0
        page[t:b, l : l + n] = page[t:b, r - n : r] = 0

    box(30, 870, 30, 670, 5)
    box(48, 852, 48, 652, 2)
    xs = np.linspace(49, 651, COLUMNS + 1)
    for x in xs[1:-1]:
        page[48:852, int(x) : int(x) + 2] = 0
    for n in range(COLUMNS):
        if n in empty:
            continue
        left, right = int(xs[n]) + 18, int(xs[n + 1]) - 16
        for c in range(CHARS):
            t = 60 + c * 79
            for k, y in enumerate(range(t, t + 56, 8)):  # strokes, no ruled line among them
                page[y : y + 6, left : left + 26] = 0
                bar = left + 4 + 12 * (k % 2)
                page[y : y + 8, bar : bar + 5] = 0
                assert left + 26 < right
    return page, xs


@pytest.fixture(scope="module")
def shelf(tmp_path_factory):
    root = tmp_path_factory.mktemp("books")
    (root / "one").mkdir()
    for k, empty in ((1, ()), (2, (2,)), (3, ())):
        (root / "one" / f"p_{k:02}.png").write_bytes(png(ruled_page(empty)[0]))
    return f"file://{root}"


@pytest.fixture(scope="module")
def profiles(spark):
    row = '{"book":"one","lines_per_page":8,"chars_per_line":10,"skip_steps":["deskew","crop","enhance_lines","binarize"]}'
    raw = spark.createDataFrame([(row,)], "j string").select(F.from_json("j", f"book string, {pf.READ_SCHEMA}").alias("p")).select("p.*")
    return pf.normalise(raw)


@pytest.fixture(scope="module")
def made(spark, shelf, profiles, tmp_path_factory):
    return api.Engine(spark).run(f"{shelf}/one", output=f"file://{tmp_path_factory.mktemp('out')}", profiles=profiles)


def test_columns_are_those_drawn(made):
    xs = ruled_page()[1]
    cols = {}
    for r in made["columns"].collect():
        cols.setdefault(r["page_id"], []).append((r["idx"], r["left_x"], r["right_x"]))
    assert set(cols) == {"p_01", "p_02", "p_03"}
    for own in cols.values():
        own.sort()
        assert [c[0] for c in own] == list(range(1, COLUMNS + 1))
        assert np.allclose([c[1] for c in own], xs[:-1][::-1], atol=3) and np.allclose([c[2] for c in own], xs[1:][::-1], atol=3)


def test_documents(made):
    pages = {r["page_id"]: json.loads(r["result"]) for r in made["pages"].collect()}
    doc = pages["p_02"]
    assert doc["image"] == {"file": "p_02.jpg", "width": 700, "height": 900} and doc["layout"]["lines_per_page"] == 8 and doc["layout"]["chars_per_line"] == 10
    assert abs(doc["border"]["outer"]["left"] - 32) <= 3 and abs(doc["border"]["inner"]["right"] - 651) <= 3 and doc["border"]["style"] == "double"
    assert [c["col_index"] for c in doc["columns"]] == list(range(COLUMNS))
    kinds = [[ch["type"] for ch in c["characters"]] for c in doc["columns"]]
    assert kinds[COLUMNS - 1 - 2] == ["empty"] * CHARS and all(k == ["normal"] * CHARS for j, k in enumerate(kinds) if j != COLUMNS - 1 - 2)
    first = doc["columns"][0]["characters"][0]
    assert abs(first["position"]["y_top"] - 60) <= 2 and first["row_index"] == 0 and first["char"] == ""
    layout = json.loads(made["layouts"].where("page_id = 'p_01'").first()["layout"])
    assert layout["borders"]["num_columns"] == COLUMNS and layout["columns"]["is_uniform"] and len(layout["borders"]["outer_frame"]) == 4
    book = json.loads(made["books"].first()["result"])
    assert book["book"] == "one" and [p["page_id"] for p in book["pages"]] == ["p_01", "p_02", "p_03"]
    manifest = json.loads(made["manifest"].first()["manifest"])
    assert manifest["steps_executed"] == [] or {s["name"] for s in manifest["steps_skipped"]} >= {"deskew", "crop"}


def test_recognised_words_fill_cells(spark, shelf, profiles):
    engine = api.Engine(spark)
    prepared = engine.preprocess(f"{shelf}/one", "1", profiles)
    words = spark.createDataFrame([("one", "p_01", 1, k, "abcdefghij"[k], 60.0 + 79 * k, 116.0 + 79 * k) for k in range(10)], "book string, page_id string, idx int, word_id long, text string, w_top double, w_bottom double")
    doc = json.loads(engine.extract(prepared, profiles, words)["pages"].first()["result"])
    assert "".join(c["char"] for c in doc["columns"][0]["characters"]) == "abcdefghij"
    assert [c["confidence"] for c in doc["columns"][0]["characters"]] == [1.0] * 10


def test_documents_are_read_back(spark, made, tmp_path):
    folder = tmp_path / "one"
    folder.mkdir()
    (folder / "p_01_layout.json").write_text(made["layouts"].where("page_id = 'p_01'").first()["layout"])
    (folder / "other.json").write_text("{}")
    got = scan.read_documents(spark, f"file://{tmp_path}", "image_size struct<width:int,height:int>, borders struct<num_columns:int>", "_layout").collect()
    assert [(r["stem"], r["book"], r["image_size"]["width"], r["borders"]["num_columns"]) for r in got] == [("p_01", "one", 700, COLUMNS)]


@pytest.mark.parametrize("seed", range(5))
def test_valleys_cut_alike_in_both_kernels(spark, seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(50, 400))
    v = np.abs(np.sin(np.arange(n) / rng.integers(6, 20)) * 20).round() * (rng.random(n) < 0.9)
    height = float(rng.integers(20, 60))
    df = spark.createDataFrame([(1, k, float(x)) for k, x in enumerate(v)], "k int, pos int, v double")
    got = sorted((r["cut_start"], r["cut_end"]) for r in sq.valley_cuts(df, ["k"], "pos", "v", height).collect())
    assert got == ms.valley_cuts(v, height)
    assert all(e - s >= 10 for s, e in got) or got == [(0, n)]


@pytest.mark.parametrize("regions, wanted", [([(0.0, 100.0), (120.0, 150.0)], 4), ([(0.0, 30.0)], 5), ([], 3), ([(0.0, 90.0), (100.0, 190.0)], 2), ([(0.0, 300.0), (300.0, 420.0)], 9)])
def test_largest_regions_are_split_until_there_are_enough(spark, regions, wanted):
    df = spark.createDataFrame([([{"s": s, "e": e} for s, e in regions],)], "r array<struct<s:double,e:double>>")
    got = [(x["s"], x["e"]) for x in df.select(sq.split_largest(F.col("r"), F.lit(wanted), F.lit(30.0)).alias("x")).first()["x"]]
    want = list(regions)
    while len(want) < wanted and want:
        size, k = max((e - s, -j) for j, (s, e) in enumerate(want))
        if size < 36:
            break
        n = min(wanted - len(want) + 1, max(2, round(size / 30)))
        s = want[-k][0]
        want[-k : -k + 1] = [(s + j * size / n, s + (j + 1) * size / n) for j in range(n)]
    assert np.allclose(got, want) if want else got == []


def test_two_humps():
    x = np.arange(100.0)
    humps = 30 * (np.exp(-((x - 28) ** 2) / 120) + np.exp(-((x - 72) ** 2) / 120))
    assert interlinear.two_humps(humps, 300)
    assert not interlinear.two_humps(30 * np.exp(-((x - 50) ** 2) / 300), 300)
    assert not interlinear.two_humps(30 * np.exp(-((x - 28) ** 2) / 120), 300) and not interlinear.two_humps(np.zeros(100), 300)
    edged = humps.copy()
    edged[:3] = edged[-3:] = 300
    assert interlinear.two_humps(edged, 300)


def test_cells_of_double_rows(spark):
    regions = spark.createDataFrame([(1, k) for k in range(5)], "col int, pos int")
    rows = spark.createDataFrame([(1, 2, 3)], "col int, first int, last int")
    segments = interlinear.alternating(regions, rows, ["col"])
    assert [(r["kind"], r["first"], r["last"]) for r in segments.orderBy("seg").collect()] == [("normal", 0, 1), ("double", 2, 3), ("normal", 4, 4)]
    pieces = [(1, 0, None, 0, 0.0, 9.0, "a"), (1, 0, None, 1, 10.0, 19.0, None), (1, 2, None, 0, 40.0, 49.0, "z")]
    pieces += [(1, 1, 1, k, 20.0 + 5 * k, 25.0 + 5 * k, "bcd"[k]) for k in range(3)] + [(1, 1, 2, k, 20.0 + 5 * k, 25.0 + 5 * k, "ef"[k]) for k in range(2)]
    df = spark.createDataFrame(pieces, "col int, seg long, sub_col int, i int, y_top double, y_bottom double, text string")
    got = interlinear.column_cells(segments, df, ["col"]).orderBy("index", "sub_col").collect()
    assert [(r["index"], r["sub_col"], r["type"], r["text"]) for r in got] == [
        (0, None, "char", "a"), (1, None, "empty", None), (2, 1, "jiazhu", "b"), (2, 2, "jiazhu", "e"), (3, 1, "jiazhu", "c"), (3, 2, "jiazhu", "f"), (4, 1, "jiazhu", "d"), (5, None, "char", "z"),
    ]


def test_double_row_of_a_whole_column(spark):
    mask = np.zeros((300, 120), bool)
    for y in range(10, 290, 20):
        mask[y : y + 14, 25:45] = mask[y : y + 14, 70:90] = True
    masks = spark.createDataFrame([("p", 300, 120, np.packbits(mask).tobytes())], "page string, height int, width int, bits binary")
    cols = spark.createDataFrame([("p", 1, 5.0, 115.0, 0.0, 300.0, 15), ("p", 2, 0.0, 20.0, 0.0, 300.0, 15)], "page string, idx int, left_x double, right_x double, top double, bottom double, expected int")
    r = grid.column_regions(masks, cols, ["page"]).collect()
    assert [(x["idx"], x["double_row"], len(x["regions"])) for x in r] == [(1, True, 14)] and 45 <= r[0]["split_x"] <= 70


def test_drawings_cover_columns_and_cells(made):
    got = made["drawings"].where("page_id = 'p_01'").collect()
    kinds = {k: [r for r in got if r["layer"] == k] for k in ("frame", "column", "cell")}
    assert len(kinds["frame"]) == 1 and len(kinds["column"]) == COLUMNS
    numbered = [r for r in kinds["cell"] if r["label"]]
    assert len(numbered) == COLUMNS * CHARS and {r["color"] for r in numbered} == {"red"} and {r["label"] for r in numbered} == {str(k + 1) for k in range(CHARS)}


def test_frame_inside_a_photographed_margin():
    page, _ = ruled_page(range(COLUMNS))
    photo = np.full((1000, 800, 3), 20, np.uint8)
    photo[50:950, 50:750] = page
    got = ms.frame(photo)
    assert got["margin_color"] == "black" and all(abs(got[f"margin_{s}"] - 50) <= 1 for s in ("top", "bottom", "left", "right"))
    assert abs(got["border_top"] - 80) <= 5 and abs(got["border_left"] - 80) <= 5 and abs(got["border_right"] - 720) <= 5 and abs(got["border_bottom"] - 920) <= 5
    assert got["content_left"] == got["border_left"] + (got["border_right"] - got["border_left"]) // 100
    blank = ms.frame(np.full((200, 100), 250, np.uint8))
    assert (blank["margin_color"], blank["border_top"], blank["border_bottom"], blank["border_left"]) == ("none", 10, 190, 5)


def test_ruled_lines_without_letters():
    page, xs = ruled_page()
    page[48:852, int(xs[3]) : int(xs[3]) + 2] = (60, 60, 220)  # a red divider (BGR)
    got = ms.ruled_mask(page)
    assert got[100:800, int(xs[3])].mean() > 0.95 and got[100:800, int(xs[2])].mean() > 0.95
    letters = np.zeros(got.shape, bool)
    letters[:, int(xs[0]) + 18 : int(xs[0]) + 44] = True
    assert got[letters][: 60 * 26].mean() < 0.2 and ms.colored_ink(page).sum() == 804 * 2
