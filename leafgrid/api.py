"""The engine's verbs, on DataFrames and folders."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.scalars import clean_stem, expand_ranges
from .operators import analyze as an
from .operators import grid, layout
from .operators import pages as pg
from .operators import preprocess as pp
from .operators import watermark
from .sources import profiles as pf
from .sources import scan, store

#: Characters of a column whose profile names no number.
CHARS = 21


class Engine:
    """Pages in, profiles, steps and tables out.  Nothing is collected."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def pages(self, path: str, pages: str | None = None) -> DataFrame:
        """The page images below ``path``, the folder's name as ``book``; ``pages`` keeps
        page numbers, such as ``1,3-5``."""
        found = scan.read_pages(self.spark, path).withColumn("book", F.element_at(F.split("path", "/"), -2))
        if pages is None:
            return found
        wanted = self.spark.range(1).select(F.explode(expand_ranges(F.lit(pages))).alias("page_no"))
        return found.join(wanted, "page_no", "left_semi")

    def recognize_profile(self, path: str) -> DataFrame:
        found = an.analyze(self.pages(path))
        known = [n for n, _, _ in pf.FIELDS]
        return pf.normalise(found.select("book", *[c for c in found.columns if c in known]))

    def show_profile(self, path: str) -> DataFrame:
        return pf.normalise(pf.read_profiles(self.spark, path))

    def plan(self, profiles: DataFrame) -> DataFrame:
        return pf.plan_steps(profiles)

    def cut(self, path: str, pages: str | None = None, fixed: bool = False) -> DataFrame:
        return pg.halves(self.pages(path, pages), ["book", "path"], fixed)

    def tables(self, path: str, pages: str | None = None) -> DataFrame:
        keys = ["book", "path"]
        return pg.table_cells(pg.table_lines(self.pages(path, pages), keys), keys)

    def profiles(self, path: str, stored: DataFrame | None = None) -> DataFrame:
        """A profile per book: the stored one, else what an analysis finds."""
        found = self.recognize_profile(path)
        return pf.resolved(found.limit(0), found.limit(0) if stored is None else stored, found).drop("origin")

    def preprocess(self, path: str, pages: str | None = None, profiles: DataFrame | None = None) -> DataFrame:
        """``book, path, sub, page_id, image, steps``: pages after the steps that their book's
        profile asks for; the parts of a cut page have a row each."""
        known = self.profiles(path) if profiles is None else profiles
        plan = pf.plan_steps(known)
        marked = plan.where("active and step = 'remove_watermark'").select("book")
        masks = None
        if not marked.isEmpty():  # a mark is looked for on all pages of a book
            masks = store.cut(watermark.masks(self.pages(path).join(store.small(marked), "book", "left_semi")))
        made = pp.run(self.pages(path, pages), plan, masks=masks)
        image = F.struct("height", "width", F.col("channels").alias("nChannels"), "data")
        return made.select("book", "path", "sub", F.concat(clean_stem(F.col("path")), "sub").alias("page_id"), image.alias("image"), "steps")

    def extract(self, prepared: DataFrame, profiles: DataFrame, words: DataFrame | None = None) -> dict[str, DataFrame]:
        """The layout and the character grid of prepared pages: ``layouts``, ``columns``,
        ``cells``, ``pages`` (a JSON document each), ``books``, and ``drawings``, the boxes of an
        annotated page.

        ``words`` (``book, page_id, idx, word_id, text, w_top, w_bottom``) are recognised
        characters by column; without them cells follow the ink alone.
        """
        keys = ["book", "page_id"]
        head = profiles.select("book", "lines_per_page", F.coalesce("chars_per_line", F.lit(CHARS)).alias("chars_per_line"), "border_style")
        sizes = store.cut(pg.sizes(prepared, keys).join(head, "book"))
        found = layout.detect(pg.segments(prepared, keys), sizes, keys, F.col("lines_per_page"), store.cut)
        cols = store.cut(found["columns"].join(found["frame"].select(*keys, "top", "bottom"), keys).join(head.select("book", F.col("chars_per_line").alias("expected")), "book"))
        own = [*keys, "idx"]
        regions = store.cut(grid.column_regions(pg.ink_masks(prepared, keys), cols, keys).select(*own, F.inline("regions")))
        height = cols.select(*own, ((F.col("bottom") - F.col("top")) / F.col("expected")).alias("char_height"))
        none = self.spark.createDataFrame([], "book string, page_id string, idx int, word_id long, text string, w_top double, w_bottom double")
        read = store.cut(none if words is None else words)
        cells = store.cut(grid.cells(cols.select(*own, "top", "bottom", "expected"), regions, read, own))
        rect = lambda layer: F.struct(*[F.round(F.coalesce(F.max(F.when(F.col("side") == k, layer)), F.lit(0.0)), 2).alias(k) for k in ("top", "bottom", "left", "right")])
        outer = found["pairs"].groupBy(*keys).agg(rect(F.coalesce("outer.intercept", "inner.intercept")).alias("outer"))
        inner = found["frame"].select(*keys, F.struct(*[F.round(k, 2).alias(k) for k in ("top", "bottom", "left", "right")]).alias("inner"))
        tall = grid.mean_height(height, keys)
        page = sizes.join(tall, keys, "left").join(inner, keys, "left").join(outer, keys, "left")
        border = F.struct(F.col("border_style").alias("style"), "outer", "inner")
        page = page.select(*keys, "page_width", "page_height", "lines_per_page", "chars_per_line", F.round(F.coalesce("char_height", F.lit(0.0)), 2).alias("char_height"), border.alias("border"))
        done = store.cut(grid.page_json(cells, cols, own, "idx", page))
        shown = pg.drawings(found, cells, keys)
        return {"layouts": layout.layout_document(found, keys), "drawings": shown, "columns": cols, "cells": cells, "pages": done, "books": grid.book_json(done, "book", "page_id")}

    def run(self, path: str, pages: str | None = None, output: str | None = None, profiles: DataFrame | None = None, words: DataFrame | None = None) -> dict[str, DataFrame]:
        """From a folder of page images to result documents.  With ``output`` the profiles, the
        prepared pages and each result are written below it, as Parquet, and read again; else
        they are checkpoints.  No page is decoded or prepared twice."""
        known = self.profiles(path) if profiles is None else profiles
        known = store.cut(known) if output is None else self._kept(known, f"{output}/profiles")
        prepared = self.preprocess(path, pages, known)
        prepared = store.cut(prepared) if output is None else self._kept(prepared, f"{output}/prepared")
        out = self.extract(prepared, known, words)
        out["manifest"] = manifest(pf.plan_steps(known), self.pages(path, pages))
        if output is not None:
            out = {name: self._kept(df, f"{output}/{name}") for name, df in out.items()}
        return out | {"profiles": known, "prepared": prepared}

    def _kept(self, df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def manifest(plan: DataFrame, images: DataFrame) -> DataFrame:
    """``book, manifest``: the steps that ran (with the book's number of images), those that
    did not and why, and the last folder, as a JSON document."""
    folder = F.concat(F.lit("s"), F.col("number").cast("string"), F.lit("_"), F.col("step"))
    n = images.groupBy("book").agg(F.count(F.lit(1)).alias("images"))
    p = plan.join(n, "book", "left").withColumn("folder", folder)
    ran = F.struct("number", F.col("step").alias("name"), "folder", F.coalesce("images", F.lit(0)).alias("images"))
    not_run = F.struct("number", F.col("step").alias("name"), "reason")
    some = p.groupBy("book").agg(
        F.array_sort(F.collect_list(F.when(F.col("active"), ran))).alias("steps_executed"),
        F.array_sort(F.collect_list(F.when(~F.col("active"), not_run))).alias("steps_skipped"),
        F.max_by(F.when(F.col("active"), F.col("folder")), F.when(F.col("active"), F.col("number"))).alias("final_output"),
    )
    return some.select("book", F.to_json(F.struct("book", "steps_executed", "steps_skipped", "final_output")).alias("manifest"))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="leafgrid", description=__doc__)
    parser.add_argument("verb", choices=["recognize-profile", "analyze", "show-profile", "cut", "tables", "preprocess", "run"])
    parser.add_argument("path")
    parser.add_argument("-o", "--output", help="folder for the rows, as Parquet; shown without")
    parser.add_argument("--range", dest="pages", help="page numbers, such as 1,3-5")
    parser.add_argument("--profile", help="stored profiles (JSON) that go before an analysis")
    a = parser.parse_args(argv)
    engine = Engine(SparkSession.builder.getOrCreate())
    known = engine.profiles(a.path, engine.show_profile(a.profile)) if a.profile else None
    if a.verb == "run":
        rows = engine.run(a.path, a.pages, a.output, known)["pages"]
    else:
        rows = {
            "recognize-profile": lambda: engine.recognize_profile(a.path), "analyze": lambda: engine.recognize_profile(a.path), "show-profile": lambda: engine.show_profile(a.path),
            "cut": lambda: engine.cut(a.path, a.pages), "tables": lambda: engine.tables(a.path, a.pages), "preprocess": lambda: engine.preprocess(a.path, a.pages, known),
        }[a.verb]()
        if a.output:
            rows.write.mode("overwrite").parquet(a.output)
    if not a.output:
        rows.show(truncate=40)


if __name__ == "__main__":
    main()
