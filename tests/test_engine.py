import json

import numpy as np
import pytest
from leafgrid import api
from leafgrid.operators import analyze as an
from leafgrid.sources import profiles as pf
from leafgrid.streaming import progress
from pyspark.sql import functions as F

from .test_pages import png


@pytest.fixture(scope="module")
def shelf(tmp_path_factory):
    root = tmp_path_factory.mktemp("shelf")
    half = np.full((300, 200, 3), 255, np.uint8)
    for x in (10, 70, 130, 188):
        half[10:290, x : x + 2] = 0
    half[10:12, 10:190] = half[288:290, 10:190] = 0
    wide = np.full((200, 400, 3), (240, 210, 140), np.uint8)
    wide[20:180, 30:180] = wide[20:180, 220:370] = 60
    for book, image in (("half", half), ("wide", wide)):
        (root / book).mkdir()
        for k in (1, 2, 3):
            (root / book / f"p_{k}.png").write_bytes(png(image))
    (root / "half" / "profile.json").write_text(json.dumps({"page_type": "table", "background_color": "orange", "interferences": ["stains", "white_margin"]}, indent=2))
    return f"file://{root}"


def test_profiles_of_books(spark, shelf):
    got = {r["book"]: r for r in api.Engine(spark).recognize_profile(shelf).collect()}
    assert (got["half"]["layout"], got["half"]["color_mode"], got["half"]["border_wear"]) == ("cut_half", "bw", "light")
    assert (got["wide"]["layout"], got["wide"]["color_mode"], got["wide"]["background_color"]) == ("spread", "colored", "xuan")
    assert got["half"]["lines_per_page"] == 3 and got["half"]["font_type"] == "printed" and got["half"]["text_color"] == "black"
    assert set(got["half"]["detection_confidence"]) >= {"layout", "lines_per_page", "color_mode", "border_wear", "font_type", "chars_per_line"}


def test_stored_profile_and_manifest(spark, shelf):
    engine = api.Engine(spark)
    p = engine.show_profile(f"{shelf}/*/profile.json")
    r = p.first()
    assert (r["book"], r["layout"], r["content_format"], r["background_color"], r["interferences"]) == ("half", "cut_half", "table", "xuan", ["margin"])
    assert p.columns == ["book", *[n for n, _, _ in pf.FIELDS]]
    doc = json.loads(api.manifest(engine.plan(p), engine.pages(shelf)).first()["manifest"])
    assert [s["name"] for s in doc["steps_executed"]] == ["deskew", "crop", "enhance_lines", "binarize"]
    assert doc["steps_executed"][0]["images"] == 3 and doc["final_output"] == "s6_binarize" and {s["reason"] for s in doc["steps_skipped"]} == {"not needed"}


def test_pages_and_cut(spark, shelf):
    engine = api.Engine(spark)
    assert sorted(r["page_no"] for r in engine.pages(f"{shelf}/wide", "1,3-9").collect()) == [1, 3]
    assert engine.cut(f"{shelf}/wide", "2").count() == 2


def test_sampling_and_mode(spark):
    df = spark.createDataFrame([("a", f"p{k:02}", v) for k, v in enumerate([9, 8, 9, 8, None] * 3)], "book string, path string, count int")
    assert an.sample(df).count() == 10
    assert tuple(an.mode_or(df, "book", "count", "path", 5).first()) == ("a", 9, 0.7)
    assert tuple(an.mode_or(df.where("count is null"), "book", "count", "path", 5).first()) == ("a", 5, 0.3)
    m = df.select("book", "path", F.col("count").alias("characters"), F.lit(False).alias("notes"))
    assert tuple(an.text(m, "book", "path").first()) == ("a", True, 9, False, 0.5, 1.0)


def test_progress_as_a_stream(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "one.log").write_text("s2 deskew: start\n[3/12] 25% p_3\n[6/12] 50% p_6\n")
    (logs / "two.log").write_text("[1/2] 50%\nDone\n")
    query = progress.latest(progress.watch(spark, f"file://{logs}")).writeStream.format("memory").queryName("jobs").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert {r["job"]: (r["pct"], r["finished"]) for r in spark.table("jobs").collect()} == {"one": (50, False), "two": (100, True)}
    r = progress.parse(spark.createDataFrame([("s2 deskew: [4/9] 44%",)], "value string")).first()
    assert (r["phase"], r["step"], r["done"], r["total"], r["pct"]) == ("s2 deskew", "s2 deskew", 4, 9, 44)
    r = progress.parse(spark.createDataFrame([("Phase 2 layout: 12 张",)], "value string")).first()
    assert (r["phase"], r["step"], r["total"], r["pct"]) == ("Phase 2", None, 12, None)
