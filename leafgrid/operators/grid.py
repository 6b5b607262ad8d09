"""Character cells of text columns, from inked regions and recognised words.

``cols``: ``keys, top, bottom, expected`` (how many characters a column holds).
``regions``: ``keys, r_top, r_bottom``, the inked stretches of a column.
``words``: ``keys, word_id, text, w_top, w_bottom`` in reading order by their middle.

Every step is a window, join or aggregate on the column's keys.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures as ms
from . import sequence as sq
from .interlinear import two_humps
from .joins import containment_or_nearest

Keys = Sequence[str]

BREAK, LEAST_HEIGHT, LEAST_CLIPPED = 3.0, 10, 5.0
SPLIT, MARGIN = 1.4, 0.5
#: Narrower columns hold no characters.
LEAST_WIDTH = 30


def inked_regions(profile: DataFrame, keys: Keys, char_height: Column, ink: float = 2.0) -> DataFrame:
    """Regions of a column's row profile (``keys, pos, v``): runs with more ink than ``ink``
    and at least ``LEAST_HEIGHT`` tall; one taller than ``SPLIT`` characters is cut at its
    valleys, or evenly without one (:func:`leafgrid.operators.sequence.valley_cuts`)."""
    height = profile.groupBy(*keys).agg(F.first(char_height).alias("_h"))
    runs = sq.runs(profile, keys, "pos", F.col("v") > ink).where(F.col("run_length") >= LEAST_HEIGHT).join(height, list(keys))
    tall = runs.where(F.col("run_length") > SPLIT * F.col("_h")).select(*keys, "run_start", "run_end", "_h")
    rows = profile.select(*keys, F.col("pos").alias("_p"), "v").join(tall, list(keys)).where((F.col("_p") >= F.col("run_start")) & (F.col("_p") < F.col("run_end")))
    cut = sq.valley_cuts(rows.withColumn("_at", F.col("_p") - F.col("run_start")), [*keys, "run_start"], "_at", "v", F.col("_h"), LEAST_HEIGHT)
    both = runs.join(cut, [*keys, "run_start"], "left")
    top = F.col("run_start") + F.coalesce("cut_start", F.lit(0))
    bottom = F.coalesce(F.col("run_start") + F.col("cut_end"), F.col("run_end"))
    return both.select(*keys, top.cast("double").alias("r_top"), bottom.cast("double").alias("r_bottom"))


def main_group(regions: DataFrame, cols: DataFrame, words: DataFrame, keys: Keys) -> DataFrame:
    """Of the groups that gaps of over ``BREAK`` characters part, the one that is nearest in
    number to the recognised characters (of most regions without any), then the larger, then
    the longer, then the first."""
    height = ((F.col("bottom") - F.col("top")) / F.col("expected")).alias("h")
    r = regions.join(cols.select(*keys, height), list(keys))
    w = Window.partitionBy(*keys).orderBy("r_top", "r_bottom")
    jump = F.coalesce((F.col("r_top") - F.lag("r_bottom").over(w) > BREAK * F.col("h")).cast("int"), F.lit(0))
    r = r.withColumn("jump", jump).withColumn("grp", F.sum("jump").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    read = words.groupBy(*keys).agg(F.sum(F.length("text")).alias("n_read"))
    g = r.groupBy(*keys, "grp").agg(F.count(F.lit(1)).alias("n"), (F.max("r_bottom") - F.min("r_top")).alias("span")).join(read, list(keys), "left")
    off = F.when(F.col("n_read") > 0, -F.abs(F.col("n") - F.col("n_read"))).otherwise(F.lit(0))
    best = g.groupBy(*keys).agg(F.max_by("grp", F.struct(off.alias("off"), "n", "span", -F.col("grp"))).alias("grp"))
    return r.join(best, [*keys, "grp"], "left_semi").select(*keys, "r_top", "r_bottom")


def fuse(regions: DataFrame, words: DataFrame, keys: Keys) -> DataFrame:
    """Where a column has words: one region per word, the word's own stretch and all regions
    that fall to it (those that contain no middle and are far from all words are noise).
    Columns without words keep their regions.  ``ord`` is the order from the top."""
    ids = regions.withColumn("region_id", F.row_number().over(Window.partitionBy(*keys).orderBy("r_top", "r_bottom"))).withColumn("c", (F.col("r_top") + F.col("r_bottom")) / 2)
    boxes = words.select(*keys, F.col("word_id").alias("box_id"), F.col("w_top").alias("lo"), F.col("w_bottom").alias("hi"), ((F.col("w_top") + F.col("w_bottom")) / 2).alias("c_box"))
    held = containment_or_nearest(ids.select(*keys, "region_id", "c"), boxes, keys).select(*keys, "region_id", "box_id").join(ids, [*keys, "region_id"])
    grown = held.groupBy(*keys, "box_id").agg(F.min("r_top").alias("t"), F.max("r_bottom").alias("b"))
    worded = boxes.join(grown, [*keys, "box_id"], "left").select(*keys, F.least("lo", "t").alias("r_top"), F.greatest("hi", "b").alias("r_bottom"), F.col("c_box").alias("at"), F.col("box_id").alias("id"))
    bare = ids.join(words.select(*keys).distinct(), list(keys), "left_anti").select(*keys, "r_top", "r_bottom", F.col("c").alias("at"), F.col("region_id").cast("long").alias("id"))
    both = worded.withColumn("id", F.col("id").cast("long")).unionByName(bare)
    return both.select(*keys, "r_top", "r_bottom", (F.row_number().over(Window.partitionBy(*keys).orderBy("at", "id")) - 1).alias("ord"))


def cells(cols: DataFrame, regions: DataFrame, words: DataFrame, keys: Keys) -> DataFrame:
    """``keys, pos, type, index, y_top, y_bottom, text, confidence``: the cells of every
    column.  Characters and empty cells together are exactly ``expected``; empty ones give
    way to characters; a small rest at either end is a margin, a large one widens the end
    cell.  A column without regions is all empty."""
    kept = main_group(regions, cols, words, keys).join(cols, list(keys))
    top, bottom = F.greatest("r_top", "top"), F.least("r_bottom", "bottom")
    kept = kept.select(*keys, top.alias("r_top"), bottom.alias("r_bottom")).where(F.col("r_bottom") - F.col("r_top") >= LEAST_CLIPPED)
    fused = fuse(kept, words, keys).join(cols, list(keys)).where(F.col("ord") < F.col("expected"))
    h = (F.col("bottom") - F.col("top")) / F.col("expected")
    fused = sq.consecutive_slots(fused, keys, "ord", (F.col("r_top") + F.col("r_bottom")) / 2, F.col("top"), h, F.col("expected"), "index")
    placed = fused.select(*keys, F.col("index").cast("int").alias("index"), "ord", F.col("r_top").cast("double"), F.col("r_bottom").cast("double"))
    letter = words.withColumn("mid", (F.col("w_top") + F.col("w_bottom")) / 2)
    letter = letter.select(*keys, "text", (F.row_number().over(Window.partitionBy(*keys).orderBy("mid", "word_id")) - 1).alias("ord"))
    slots = cols.select(*keys, "top", "bottom", "expected", F.explode(F.sequence(F.lit(0), F.col("expected") - 1)).alias("index"))
    c = slots.join(placed, [*keys, "index"], "left").join(letter, [*keys, "ord"], "left")
    is_char = F.col("r_top").isNotNull()
    c = c.withColumn("type", F.when(is_char, "char").otherwise("empty"))
    c = c.withColumn("y_top", F.round(F.coalesce("r_top", F.col("top") + F.col("index") * h), 2)).withColumn("y_bottom", F.round(F.coalesce("r_bottom", F.col("top") + (F.col("index") + 1) * h), 2))
    order = Window.partitionBy(*keys).orderBy("index")
    before, after = F.lag(F.struct("type", "y_bottom")).over(order), F.lead(F.struct("type", "y_top")).over(order)
    empty = F.col("type") == "empty"
    up = F.when(empty & (before["type"] == "char") & (before["y_bottom"] > F.col("y_top")), before["y_bottom"]).otherwise(F.col("y_top"))
    down = F.when(empty & (after["type"] == "char") & (after["y_top"] < F.col("y_bottom")), after["y_top"]).otherwise(F.col("y_bottom"))
    c = c.withColumn("u", up).withColumn("d", F.greatest(down, up))
    small = MARGIN * h
    first, last = F.col("index") == 0, F.col("index") == F.col("expected") - 1
    over, under = F.col("u") - F.col("top"), F.col("bottom") - F.col("d")
    c = c.withColumn("y_top", F.when(first & (over > small) & (over > 1), F.round("top", 2)).otherwise(F.col("u"))).withColumn("y_bottom", F.when(last & (under > small) & (under > 1), F.round("bottom", 2)).otherwise(F.col("d")))
    text = F.when(F.col("type") == "char", F.col("text"))
    confidence = F.when(text.isNotNull(), 1.0).otherwise(F.lit(0.0))
    own = c.select(*keys, (F.col("index") + 1).alias("pos"), "type", "index", "y_top", "y_bottom", text.alias("text"), confidence.alias("confidence"))
    none = {"index": "int", "text": "string", "confidence": "double"}
    rest = lambda ok, pos, a, b: c.where(ok).select(*keys, pos.alias("pos"), F.lit("margin").alias("type"), a.alias("y_top"), b.alias("y_bottom"), *[F.lit(None).cast(t).alias(k) for k, t in none.items()])
    head = rest(first & (over > 1) & (over <= small), F.lit(0), F.round("top", 2), F.col("u"))
    foot = rest(last & (under > 1) & (under <= small), F.col("expected") + 1, F.col("d"), F.round("bottom", 2))
    return own.unionByName(head).unionByName(foot)


def usual_height(regions: DataFrame, keys: Keys, height: Column) -> DataFrame:
    """``keys, char_height, overlaps``: the median distance of neighbouring regions' middles
    among those within 0.4 and 2 of ``height`` (exclusive), held within 0.7 and 1.3 of it (and it
    itself without any); whether two neighbours overlap by more than 0.3 of it."""
    w = Window.partitionBy(*keys).orderBy("r_top", "r_bottom")
    r = regions.withColumn("_h", height).withColumn("_c", (F.col("r_top") + F.col("r_bottom")) / 2)
    r = r.withColumn("_gap", F.lead("_c").over(w) - F.col("_c")).withColumn("_over", F.col("r_bottom") - F.lead("r_top").over(w))
    fair = F.when((F.col("_gap") > 0.4 * F.col("_h")) & (F.col("_gap") < 2 * F.col("_h")), F.col("_gap"))
    g = r.groupBy(*keys).agg(F.median(fair).alias("m"), F.first("_h").alias("h"), F.coalesce(F.bool_or(F.col("_over") > 0.3 * F.col("_h")), F.lit(False)).alias("overlaps"))
    held = F.greatest(F.least("m", F.col("h") * 1.3), F.col("h") * 0.7)
    return g.select(*keys, F.coalesce(F.when(F.col("m").isNotNull(), held), F.col("h")).alias("char_height"), "overlaps")


def mean_height(columns: DataFrame, page: Keys, height: str = "char_height") -> DataFrame:
    """The mean character height of a page's columns, 0 without any."""
    return columns.groupBy(*page).agg(F.coalesce(F.avg(height), F.lit(0.0)).alias("char_height"))


def column_regions(masks: DataFrame, cols: DataFrame, keys: Keys, pad: int = 4) -> DataFrame:
    """``keys, idx, regions, double_row, split_x``: of every column of every page its inked
    stretches inside the frame (``array<struct<r_top, r_bottom>>``), whether the whole of it
    shows two humps, and where those part.  ``masks`` are :func:`pages.ink_masks`; ``cols`` has
    ``keys, idx, left_x, right_x, top, bottom, expected``.  Columns narrower than
    ``LEAST_WIDTH`` have none."""
    number = lambda c: F.col(c).cast("double").alias(c)
    one = F.struct("idx", *[number(c) for c in ("left_x", "right_x", "top", "bottom", "expected")])
    page = cols.where(F.col("right_x") - F.col("left_x") >= LEAST_WIDTH).groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("cols"))
    both = masks.join(page, list(keys))
    types = {f.name: f.dataType.simpleString() for f in both.schema.fields}
    names = [*keys, "idx", "regions", "double_row", "split_x"]
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "idx int, regions array<struct<r_top:double,r_bottom:double>>, double_row boolean, split_x int"])

    def column(mask: np.ndarray, c: dict) -> dict:
        a, b = max(int(c["left_x"]) + pad, 0), max(int(c["right_x"]) - pad, 0)
        t, e = max(int(c["top"]), 0), max(int(c["bottom"]), 0)
        own = mask[t:e, a:b]
        if own.size == 0:
            return {"idx": c["idx"], "regions": [], "double_row": False, "split_x": None}
        edge = max(4, int(own.shape[1] * 0.05))
        across = own.sum(axis=0)
        dual = two_humps(across[edge : len(across) - edge], own.shape[0])
        found = ms.inked_stretches(own.sum(axis=1), max((c["bottom"] - c["top"]) / c["expected"], 1.0), 2, LEAST_HEIGHT, SPLIT)
        m, n = int(len(across) // 2 * 0.7), max(int(len(across) // 2 * 1.3), 1)
        return {"idx": c["idx"], "regions": [{"r_top": float(t + s), "r_bottom": float(t + f)} for s, f in found], "double_row": dual, "split_x": a + m + int(across[m:n].argmin()) if dual else None}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                h, w = row["height"], row["width"]
                mask = np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8))[: h * w].reshape(h, w)
                out += [{k: row[k] for k in keys} | column(mask, c) for c in row["cols"]]
            made = pd.DataFrame(out, columns=names)
            yield made.astype({"split_x": "Int32"})

    return both.mapInPandas(run, schema)


def page_json(cells_: DataFrame, cols: DataFrame, keys: Keys, column: str, page: DataFrame | None = None) -> DataFrame:
    """``page_keys, result``: one JSON document per page, columns from 0 and characters in
    order, margins left out and missing text empty.  ``cols`` with ``left_x, right_x`` gives
    positions; ``page`` (``page_keys, page_id, page_width, page_height, lines_per_page,
    chars_per_line, char_height``, and a struct ``border``, which may be null) the head."""
    own = [k for k in keys if k != column]
    placed = "left_x" in cols.columns
    both = cells_.join(cols.select(*keys, "left_x", "right_x"), list(keys)) if placed else cells_
    kind = F.when(F.col("type") == "char", "normal").otherwise(F.col("type"))
    x = [F.round((F.col("left_x") + F.col("right_x")) / 2, 2).alias("x")] if placed else []
    sub = ["sub_col"] if "sub_col" in cells_.columns else []
    sure = F.when(F.col("type") != "empty", F.col("confidence")) if placed else F.col("confidence")
    char = F.struct(F.coalesce("text", F.lit("")).alias("char"), F.col("index").alias("row_index"), F.struct(*x, "y_top", "y_bottom").alias("position"), kind.alias("type"), sure.alias("confidence"), *sub)
    order = [F.col("index" if sub else "pos").alias("o"), *(F.col(c).alias(f"o_{c}") for c in sub)]
    per = both.where("type <> 'margin'").groupBy(*keys, *(["left_x", "right_x"] if placed else [])).agg(F.sort_array(F.collect_list(F.struct(*order, char.alias("c")))).alias("a"))
    where = [F.struct(F.round("left_x", 2).alias("left_x"), F.round("right_x", 2).alias("right_x")).alias("position")] if placed else []
    one = F.struct((F.col(column) - 1).alias("col_index"), *where, F.transform("a", lambda v: v["c"]).alias("characters"))
    made = per.groupBy(*own).agg(F.array_sort(F.collect_list(one)).alias("columns"))
    if page is None:
        return made.select(*own, F.to_json(F.struct("columns")).alias("result"))
    size = F.struct(F.concat("page_id", F.lit(".jpg")).alias("file"), F.col("page_width").alias("width"), F.col("page_height").alias("height"))
    head = F.struct("lines_per_page", "chars_per_line", "char_height", F.lit("rtl_vertical").alias("writing_direction"))
    doc = F.struct("page_id", size.alias("image"), head.alias("layout"), "border", F.coalesce("columns", F.array()).alias("columns"))
    return page.join(made, own, "left").select(*own, F.to_json(doc).alias("result"))


def book_json(results: DataFrame, book: str, page: str, profile: str | None = None) -> DataFrame:
    """``book, result``: a book's page documents in one, in the order of ``page``."""
    doc = F.struct(F.col(page).alias("p"), "result")
    held = results.groupBy(book, *([profile] if profile else [])).agg(F.sort_array(F.collect_list(doc)).alias("a"))
    pages = F.concat(F.lit("["), F.array_join(F.transform("a", lambda x: x["result"]), ","), F.lit("]"))
    head = F.to_json(F.struct(F.col(book).alias("book"), *([F.col(profile).alias("profile")] if profile else [])))
    return held.select(book, F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"pages":'), pages, F.lit("}")).alias("result"))
