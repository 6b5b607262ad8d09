"""From page images to relations: profiles, halves, tables.

One Arrow-batched pass over the images turns pixels into vectors, lines, halves or packed
masks; the image bytes go no further, so no shuffle carries them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import measures as ms
from ..functions import pixels as px
from ..functions.scalars import cell_label
from . import sequence as sq

Keys = Sequence[str]


def per_image(pages: DataFrame, keys: Keys, schema: str, kernel: Callable[[np.ndarray], list[dict]]) -> DataFrame:
    """``keys`` and the rows that ``kernel`` makes of each page's image."""
    fields = {f.name: f for f in pages.schema.fields}
    full = ", ".join([*(f"{k} {fields[k].dataType.simpleString()}" for k in keys), schema])
    columns = [c.split()[0] for c in schema.replace("<", " ").split(", ")]
    narrow = pages.select(*keys, *[F.col(f"image.{c}").alias(f"_{c}") for c in ("height", "width", "nChannels", "data")])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                image = px.from_row(row["_height"], row["_width"], row["_nChannels"], row["_data"])
                out += [{k: row[k] for k in keys} | made for made in kernel(image)]
            yield pd.DataFrame(out, columns=[*keys, *columns])

    return narrow.mapInPandas(run, full)


def ink_profiles(pages: DataFrame, keys: Keys) -> DataFrame:
    """``axis, size, values``: dark cells per column (axis ``x``) and per row (``y``)."""

    def kernel(image: np.ndarray) -> list[dict]:
        mask = px.ink(image)
        return [{"axis": a, "size": mask.shape[k], "values": mask.sum(axis=k).astype(float).tolist()} for k, a in ((0, "x"), (1, "y"))]

    return per_image(pages, keys, "axis string, size int, values array<double>", kernel)


def points(profiles: DataFrame, keys: Keys) -> DataFrame:
    """A profile's vector as rows ``keys, axis, pos, v``."""
    return profiles.select(*keys, "axis", F.posexplode("values").alias("pos", "v"))


def segments(pages: DataFrame, keys: Keys, least: int = 30) -> DataFrame:
    """``keys, x1, y1, x2, y2, width``: the straight ruled stretches of every page."""
    return per_image(pages, keys, "x1 double, y1 double, x2 double, y2 double, width double", lambda image: px.line_segments(px.ink(image), least))


def sizes(pages: DataFrame, keys: Keys) -> DataFrame:
    """``keys, page_width, page_height``, without decoding."""
    return pages.select(*keys, F.col("image.width").alias("page_width"), F.col("image.height").alias("page_height"))


def ink_masks(pages: DataFrame, keys: Keys) -> DataFrame:
    """``keys, height, width, bits``: a page's ink, a bit a cell.  A join that needs a page's
    cells again carries these, a 24th of the image."""

    def kernel(image: np.ndarray) -> list[dict]:
        mask = px.gray(image) < 128
        return [{"height": mask.shape[0], "width": mask.shape[1], "bits": np.packbits(mask).tobytes()}]

    return per_image(pages, keys, "height int, width int, bits binary", kernel)


def frames(pages: DataFrame, keys: Keys) -> DataFrame:
    """``keys`` and each page's margins, border and content (:func:`measures.frame`)."""
    return per_image(pages, keys, ms.FRAME_SCHEMA, lambda image: [ms.frame(image)])


def drawings(found: dict[str, DataFrame], cells: DataFrame, keys: Keys) -> DataFrame:
    """``keys, layer, x0, y0, x1, y1, color, label``: what an annotated page shows, as a list of
    boxes and lines: columns, the inner frame, and cells with their number (margins without)."""
    f = found["frame"].select(*keys, F.lit("frame").alias("layer"), F.col("left").alias("x0"), F.col("top").alias("y0"), F.col("right").alias("x1"), F.col("bottom").alias("y1"), F.lit("green").alias("color"), F.lit("").alias("label"))
    cols = found["columns"].join(found["frame"].select(*keys, "top", "bottom"), list(keys))
    c = cols.select(*keys, F.lit("column").alias("layer"), F.col("left_x").alias("x0"), F.col("top").alias("y0"), F.col("right_x").alias("x1"), F.col("bottom").alias("y1"), F.lit("blue").alias("color"), F.col("idx").cast("string").alias("label"))
    tint = F.when(F.col("type") == "char", "red").when(F.col("type") == "empty", "gray").when(F.col("type") == "margin", "yellow").otherwise("orange")
    sub = F.col("sub_col") if "sub_col" in cells.columns else F.lit(None).cast("int")
    label = F.when(F.col("index").isNull(), F.lit("")).otherwise(cell_label(F.col("index"), sub))
    held = cells.join(found["columns"].select(*keys, "idx", "left_x", "right_x"), [*keys, "idx"])
    e = held.select(*keys, F.lit("cell").alias("layer"), F.col("left_x").alias("x0"), F.col("y_top").alias("y0"), F.col("right_x").alias("x1"), F.col("y_bottom").alias("y1"), tint.alias("color"), label.alias("label"))
    return f.unionByName(c).unionByName(e)


def halves(pages: DataFrame, keys: Keys, fixed: bool = False) -> DataFrame:
    """``keys, sub, part, center, width, height, data``: the right half first, then the left,
    cut at the fold that the same pass finds, or in the middle if ``fixed``."""

    def kernel(image: np.ndarray) -> list[dict]:
        c = image.shape[1] // 2 if fixed else ms.fold_center(px.gray(image))
        parts = (("right", image[:, c:]), ("left", image[:, :c]))
        return [{"sub": s, "part": k, "center": c, "width": p.shape[1], "height": p.shape[0], "data": np.ascontiguousarray(p).tobytes()} for k, (s, p) in enumerate(parts)]

    return per_image(pages, keys, "sub string, part int, center int, width int, height int, data binary", kernel)


def cut_document(halves_: DataFrame, keys: Keys) -> DataFrame:
    """``keys, cut``: where a page was cut and the sizes of its parts, as a JSON document."""
    part = F.struct("part", F.struct("sub", "width", "height").alias("p"))
    got = halves_.groupBy(*keys).agg(F.first("center").alias("center"), F.sort_array(F.collect_list(part)).alias("a"))
    return got.select(*keys, F.to_json(F.struct(F.col("center"), F.transform("a", lambda x: x["p"]).alias("parts"))).alias("cut"))


def table_lines(pages: DataFrame, keys: Keys, coverage: float = 0.10, min_gap: int = 25) -> DataFrame:
    """``axis, pos, strength``: ruled lines of a table page, the runs of each axis's profile
    of long strokes; of lines within ``min_gap`` the stronger stays."""

    def kernel(image: np.ndarray) -> list[dict]:
        mask, out = px.ink(image), []
        for k, a in ((1, "h"), (0, "v")):
            v = px.line_profile(mask, k)
            out += [{"axis": a, "pos": (s + e) // 2, "strength": float(v[s:e].max())} for s, e in ms.runs(v > coverage)]
        return out

    return sq.stronger_replaces(per_image(pages, keys, "axis string, pos int, strength double", kernel), [*keys, "axis"], "pos", "strength", min_gap)


def table_cells(lines: DataFrame, keys: Keys) -> DataFrame:
    """``row, col, x0, y0, x1, y1`` of every cell; none without two lines on both axes."""

    def between(axis: str, index: str, a: str, b: str) -> DataFrame:
        gaps = sq.spacings(lines.where(F.col("axis") == axis), keys, "pos")
        return sq.place(gaps, keys, ["left_x"], index).select(*keys, index, F.col("left_x").alias(a), F.col("right_x").alias(b))

    return between("h", "row", "y0", "y1").join(between("v", "col", "x0", "x1"), list(keys))


def cell_texts(cells: DataFrame, words: DataFrame, keys: Keys, least: float = 0.15) -> DataFrame:
    """Recognised ``words`` (``keys, text, confidence, x, y`` in page places) joined to the
    cell that holds them: ``text`` from top to bottom, mean ``confidence`` (0 if none)."""
    sure = words.where(F.col("confidence") >= least)
    held = cells.join(sure, list(keys), "left").where("text is null or (x >= x0 and x < x1 and y >= y0 and y < y1)")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("y", "x", "text"))), lambda w: w["text"]), "")
    got = held.where("text is not null").groupBy(*keys, "row", "col").agg(text.alias("text"), F.avg("confidence").alias("confidence"), F.count(F.lit(1)).alias("n"))
    return cells.join(got, [*keys, "row", "col"], "left").withColumns({"text": F.coalesce("text", F.lit("")), "confidence": F.coalesce("confidence", F.lit(0.0)), "n": F.coalesce("n", F.lit(0))})


def table_document(texts: DataFrame, lines: DataFrame, keys: Keys) -> DataFrame:
    """``keys, result``: one JSON document per table page: its lines, and the cells that hold
    text in order, the confidence to three places."""
    box = F.array("x0", "y0", "x1", "y1").alias("bbox")
    size = F.array(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")).alias("size")
    cell = F.struct("row", "col", F.lit(1).alias("row_span"), F.lit(1).alias("col_span"), box, size, "text", F.round("confidence", 3).alias("confidence"), F.length("text").alias("char_count"))
    some = F.col("text") != ""
    cells = texts.groupBy(*keys).agg((F.max("row") + 1).alias("rows"), (F.max("col") + 1).alias("cols"), F.array_sort(F.collect_list(F.when(some, cell))).alias("cells"))
    at = lambda a: F.array_sort(F.collect_list(F.when(F.col("axis") == a, F.col("pos"))))
    ruled = lines.groupBy(*keys).agg(at("h").alias("h_lines"), at("v").alias("v_lines"))
    both = cells.join(ruled, list(keys))
    return both.select(*keys, F.to_json(F.struct(F.struct("rows", "cols", "h_lines", "v_lines").alias("table"), "cells")).alias("result"))


def line_wear(coverage: Column) -> Column:
    """How worn a border is, by the mean share of it that is there."""
    return F.when(coverage >= 0.95, "none").when(coverage >= 0.7, "light").when(coverage >= 0.4, "medium").otherwise("heavy")
