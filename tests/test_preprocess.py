import numpy as np
from leafgrid import api
from leafgrid.functions import pixels as px
from leafgrid.operators import preprocess as pp
from leafgrid.sources import profiles as pf
from pyspark.sql import functions as F

from .test_engine import shelf  # noqa: F401


def page(h=300, w=400):
    image = np.full((h, w), 255, np.uint8)
    for y in range(40, h - 40, 20):
        image[y : y + 3, 50 : w - 50] = 20
    return image


def test_crop_and_split():
    image = page()
    (_, cut), = pp.crop(image)
    assert cut.shape == (203, 300) and pp.content_box(image) == (40, 243, 50, 350)
    blank = np.full((120, 120), 255, np.uint8)
    assert pp.crop(blank)[0][1].shape == (120, 120)
    image[:, 210:214] = 0
    parts = pp.split(image)
    assert [(s, p.shape[1]) for s, p in parts] == [("_right", 189), ("_left", 211)]


def test_deskew_straightens():
    tilted = px.rotate(page(), 2.0)
    assert abs(px.skew(pp.deskew(tilted)[0][1])) < 0.3
    assert pp.deskew(page())[0][1].shape == (300, 400)


def test_enhance_closes_gaps():
    image = page()
    image[40:43, 180:200] = 255
    (_, done), = pp.enhance_lines(image)
    assert (done[40:43, 50:350] <= 20).all() and (done <= image).all() and (done[:, :50] == 255).all()


def test_steps_follow_the_plan(spark, shelf):  # noqa: F811
    pages = api.Engine(spark).pages(shelf)
    rows = [("half", "cut_half", "bw", ["crop"]), ("wide", "uncut_full", "colored", ["enhance_lines"])]
    profiles = pf.normalise(spark.createDataFrame(rows, "book string, layout string, color_mode string, skip_steps array<string>"))
    got = pp.run(pages, pf.plan_steps(profiles)).orderBy("path", "part").collect()
    half = [r for r in got if r["book"] == "half"]
    wide = [r for r in got if r["book"] == "wide"]
    assert [r["steps"] for r in half] == [["deskew", "enhance_lines", "binarize"]] * 3 and {r["channels"] for r in half} == {1}
    assert [r["sub"] for r in wide] == ["_right", "_left"] * 3 and wide[0]["steps"] == ["deskew", "crop", "split"] and wide[0]["channels"] == 3
    for r in got:
        assert len(r["data"]) == r["width"] * r["height"] * r["channels"]
    bare = pp.run(pages.where("book = 'half'"), pf.plan_steps(profiles.where("book = 'none'")))
    assert bare.select(F.size("steps").alias("n")).distinct().collect()[0]["n"] == 0
