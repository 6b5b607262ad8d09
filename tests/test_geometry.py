import numpy as np
import pytest
from leafgrid import api
from leafgrid.functions import geometry as geo
from leafgrid.functions import pixels as px
from leafgrid.functions import restore
from leafgrid.operators import equidistant as eq
from leafgrid.operators import preprocess as pp
from leafgrid.operators import watermark as wm
from leafgrid.sources import profiles as pf
from pyspark.sql import functions as F

from .test_pages import png

#: Left edges of the seal's strokes, between the columns of letters.
STROKES = range(108, 204, 24)
SQUARE = np.array([[0, 0], [100, 0], [100, 200], [0, 200]], float)


def framed(h=500, w=400):
    image = np.full((h, w), 255, np.uint8)
    for k in (0, 20):  # an outer and an inner line on each side
        image[40 + k : 46 + k, 40 : w - 40] = image[h - 46 - k : h - 40 - k, 40 : w - 40] = 0
        image[40 : h - 40, 40 + k : 46 + k] = image[40 : h - 40, w - 46 - k : w - 40 - k] = 0
    return image


def test_homography_round_trip():
    far = np.array([[10, 5], [112, 12], [105, 230], [-3, 210]], float)
    matrix = geo.homography(SQUARE, far)
    assert np.allclose(geo.mapped(matrix, SQUARE), far) and np.allclose(geo.mapped(np.linalg.inv(matrix), far), SQUARE)
    assert geo.homography(np.array([[0, 0], [1, 1], [2, 2], [3, 3]], float), SQUARE) is None
    assert geo.homography(SQUARE[:3], far[:3]) is None


def test_robust_homography_leaves_strays():
    rng = np.random.default_rng(1)
    points = rng.uniform(0, 500, (20, 2))
    matrix = np.array([[1.02, 0.03, 5], [-0.02, 0.98, 9], [1e-5, -2e-5, 1]])
    target = geo.mapped(matrix, points)
    target[[3, 11, 17]] += 60
    found, follows = geo.robust_homography(points, target)
    assert np.flatnonzero(~follows).tolist() == [3, 11, 17] and np.allclose(found, matrix, atol=1e-6)
    assert geo.robust_homography(points[:3], target[:3])[0] is None


def test_hull_and_fill_against_every_cell():
    rng = np.random.default_rng(5)
    points = rng.integers(3, 37, (40, 2))
    corners = geo.hull(points)
    inside = geo.filled((40, 40), corners)
    assert inside[points[:, 1], points[:, 0]].all() and set(map(tuple, corners.astype(int))) <= set(map(tuple, points))
    assert abs(geo.area(corners) - inside.sum()) < 100  # half the rim more
    assert geo.area(SQUARE) == 20_000 and not geo.filled((5, 5), np.zeros((0, 2))).any()


def test_growing_by_an_ellipse_against_every_cell():
    rng = np.random.default_rng(2)
    gray = rng.integers(0, 256, (17, 23)).astype(np.uint8)
    r = 3
    near = [(dy, dx) for dy in range(-r, r + 1) for dx in range(-round(r * np.sqrt(1 - (dy / r) ** 2)), round(r * np.sqrt(1 - (dy / r) ** 2)) + 1)]
    for a, pick, made in ((gray, max, restore.dilated(gray, 7)), (gray, min, restore.eroded(gray, 7)), (gray > 200, max, restore.dilated(gray > 200, 7))):
        want = [[pick(a[y + dy, x + dx] for dy, dx in near if 0 <= y + dy < 17 and 0 <= x + dx < 23) for x in range(23)] for y in range(17)]
        assert (made == np.array(want)).all()


def test_painting_fills_from_the_rim():
    image = np.tile(np.linspace(50, 200, 40), (30, 1)).astype(np.uint8)
    mask = np.zeros(image.shape, bool)
    mask[10:14, 5:35] = True
    broken = np.where(mask, 0, image).astype(np.uint8)
    done = restore.painted(broken, mask)
    assert (done[~mask] == image[~mask]).all() and np.abs(done.astype(int) - image)[mask].max() <= 8
    assert (restore.painted(broken, np.ones_like(mask)) == broken).all()
    coloured = np.stack([broken] * 3, axis=2)
    assert (restore.painted(coloured, mask) == done[..., None]).all()


def test_deskew_maps_a_tilted_frame_to_a_rectangle():
    straight = framed()
    seen = np.array([[40, 40], [360, 40], [360, 460], [40, 460]], float)
    tilted = geo.warp(straight, geo.homography(seen, seen + np.array([[0, 0], [2, 5], [-3, 6], [1, -3]])), 500, 400)
    (_, done), = pp.deskew(tilted)
    assert abs(done.shape[0] - 420) < 16 and abs(done.shape[1] - 320) < 16
    found = pp.page_borders(np.pad(done, 20, constant_values=255))
    assert max(abs(g["slope"]) for g in found.values()) < 0.004
    assert pp.rectified(straight) is None  # no tilt
    assert pp.rectified(np.full((200, 200), 255, np.uint8)) is None  # no lines


@pytest.fixture(scope="module")
def marked(tmp_path_factory):
    root = tmp_path_factory.mktemp("marked")
    rng = np.random.default_rng(4)
    clean = {}
    for book, pages in (("seal", 5), ("plain", 4), ("short", 2)):
        (root / book).mkdir()
        for k in range(pages):
            page = np.full((240, 320), 240, np.uint8)
            for x in range(20, 300, 24):
                top = int(rng.integers(10, 200))
                page[top : top + 12, x : x + 12] = 30
            clean[book, k] = page.copy()
            if book != "plain":
                for x in STROKES:
                    page[90:150, x : x + 3] = 90
            (root / book / f"p_{k}.png").write_bytes(png(np.stack([page] * 3, axis=2)))
    return f"file://{root}", clean


def test_common_page_is_the_percentile(spark, marked):
    pages = api.Engine(spark).pages(marked[0])
    small = {r["book"]: r for r in wm.common_pages(pages, tile_bytes=10_000).collect()}
    assert sorted(small) == ["plain", "seal"]  # two pages are too few
    stack = np.stack([px.from_row(*r) for r in pages.where("book = 'seal'").select("image.height", "image.width", "image.nChannels", "image.data").collect()])
    got = small["seal"]
    assert (px.from_row(got["height"], got["width"], got["channels"], got["data"]) == np.percentile(stack, 90, axis=0).astype(np.uint8)).all()
    assert wm.common_pages(pages.limit(0)).count() == 0


def test_mark_is_painted_over_and_letters_stay(spark, marked):
    root, clean = marked
    engine = api.Engine(spark)
    masks = wm.masks(engine.pages(root))
    (mask,) = masks.collect()
    on = np.unpackbits(np.frombuffer(mask["bits"], np.uint8), count=240 * 320).reshape(240, 320).astype(bool)
    lines = np.zeros((240, 320), bool)
    for x in STROKES:
        lines[90:150, x : x + 3] = True
    assert mask["book"] == "seal" and on[lines].all() and not on[~lines].any()
    rows = [(b, "cut_half", ["watermark"], ["deskew", "crop", "enhance_lines", "binarize"]) for b in ("seal", "plain", "short")]
    profiles = pf.normalise(spark.createDataFrame(rows, "book string, layout string, interferences array<string>, skip_steps array<string>"))
    done = engine.preprocess(root, profiles=profiles).select("book", "path", "steps", "image.*").collect()
    assert len(done) == 11 and {(r["book"], tuple(r["steps"])) for r in done} == {("seal", ("remove_watermark",)), ("plain", ()), ("short", ())}
    for r in done:
        if r["book"] == "seal":
            page = px.gray(px.from_row(r["height"], r["width"], r["nChannels"], r["data"]))
            want = clean["seal", int(r["path"].rsplit("_", 1)[1][0])]
            assert (page[~lines] == want[~lines]).all() and np.abs(page.astype(int) - want).max() <= 2


def test_pages_are_warped_onto_their_grid(spark, marked):
    root, _ = marked
    keys = ["book", "path"]
    pages = api.Engine(spark).pages(root).where("book = 'plain'")
    found = F.explode(F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x in (20, 120, 220, 300) for y in (10, 200)])).alias("p")
    points = pages.select(*keys, found).select(*keys, "p.*").withColumn("to_x", F.col("x") + 7).withColumn("to_y", F.col("y") - 4)
    points = points.where("path not like '%p_3.png'").withColumn("x", F.when((F.col("x") == 220) & (F.col("y") == 10), 0.0).otherwise(F.col("x")))
    maps = eq.grid_maps(points, keys)
    assert [r["followers"] for r in maps.collect()] == [7] * 3
    got = {r["path"][-5]: r for r in eq.warped(pages, maps, keys).collect()}
    raw = {r["path"][-5]: px.from_row(*r["image"][1:4], r["image"]["data"]) for r in pages.select("path", F.struct("image.origin", "image.height", "image.width", "image.nChannels", "image.data").alias("image")).collect()}
    a = px.from_row(got["0"]["height"], got["0"]["width"], got["0"]["channels"], got["0"]["data"])
    assert a.shape == (240, 320, 3) and np.abs(a[:230, 10:].astype(int) - raw["0"][4:234, 3:313]).max() <= 1
    assert got["3"]["data"] == raw["3"].tobytes()
    flat = eq.grid_maps(points.withColumn("y", F.lit(5.0)), keys).collect()
    assert {r["matrix"] for r in flat} == {None}


def test_edges_ring_a_block_and_leave_weak_ones():
    image = np.full((60, 60), 200, np.uint8)
    image[20:40, 20:40] = 40
    image[5:9, 5:9] = 190  # below the lower limit
    on = px.edges(image)
    y, x = np.nonzero(on)
    assert y.min() in (19, 20) and y.max() in (39, 40) and x.min() in (19, 20) and x.max() in (39, 40)
    assert not on[22:38, 22:38].any() and (on[:, 25:35].sum(axis=0) == 2).all() and (on[25:35].sum(axis=1) == 2).all()
    assert not px.edges(np.full((10, 10), 7, np.uint8)).any()
    tilted = px.rotate(np.where(np.arange(300)[:, None] % 30 < 4, 0, 255).repeat(300, 1).astype(np.uint8), 1.5)
    assert abs(px.skew(tilted, marks=px.edges) + 1.5) < 0.3


def test_line_widths_against_every_place():
    rng = np.random.default_rng(8)
    mask = rng.random((40, 50)) < 0.45
    along, across, margin = np.arange(-2, 52), rng.integers(-3, 43, 54), 4

    def one(m, c, p):
        if not (0 <= p < m.shape[1] and 0 <= c < m.shape[0]):
            return 0
        near = [c + k for k in sorted(range(-margin, margin + 1), key=lambda k: (abs(k), k)) if 0 <= c + k < m.shape[0] and m[c + k, p]]
        if not near:
            return 0
        low = high = near[0]
        while low > 0 and m[low - 1, p] and near[0] - low < margin:
            low -= 1
        while high < m.shape[0] - 1 and m[high + 1, p] and high - near[0] < margin:
            high += 1
        return high - low + 1

    for axis, m in ((1, mask), (0, mask.T)):
        want = [one(m, int(c), int(p)) for c, p in zip(across, along)]
        assert px.line_widths(mask, along, across, axis, margin).tolist() == want


def test_ends_of_a_grid_are_checked(spark):
    """A grid of three columns, 100 apart, on pages 1000 wide and 500 high."""
    places = {
        "good": ([(285, 400), (300, 400), (400, 400), (500, 400), (600, 400), (615, 400)], [1, 2, 3, 4]),
        "out": ([(185, 400), (200, 400), (300, 400), (400, 400), (500, 400), (515, 400), (600, 400)], [2, 3, 4, 6]),
        "edge": ([(85, 400), (100, 400), (200, 400), (300, 400), (400, 400), (415, 400)], [2, 3, 4, 4]),
        "short": ([(285, 200), (300, 300), (400, 400), (500, 400), (600, 400), (700, 400), (715, 400)], [1, 2, 3, 4]),
        "lost": ([(285, 200), (300, 300), (400, 400), (500, 400), (600, 400), (615, 400)], [1, 2, 3, 4]),
    }
    places["edge"] = (places["edge"][0] + [(500, 400), (515, 400)], [2, 3, 4, 6])
    lines = spark.createDataFrame([(p, k, float(x), float(n)) for p, (ls, _) in places.items() for k, (x, n) in enumerate(ls)], "page string, id int, x double, length double")
    chosen = spark.createDataFrame([(p, ids) for p, (_, ids) in places.items()], "page string, ids array<int>")
    pages = spark.createDataFrame([(p, 1000, 500) for p in places], "page string, page_width int, page_height int")
    got = {r["page"]: (r["ids"], r["spacing"]) for r in eq.checked_ends(lines, chosen, pages, ["page"], 3).collect()}
    assert got["good"] == ([1, 2, 3, 4], 100.0)
    assert got["out"] == ([1, 2, 3, 4], 100.0)  # the left end has no companion, the line outside it has
    assert got["edge"] == ([2, 3, 4, 6], 100.0)  # that line is in the edge zone
    assert got["short"] == ([2, 3, 4, 5], 100.0)
    assert "lost" not in got
