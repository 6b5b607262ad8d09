"""The mark that all pages of a book bear, from the 90th percentile of each cell.

Pages are cut into tiles of cells, and a tile of all pages of a book meets in one task.  The
more pages a book has, the smaller its tiles, so that a task holds ``TILE_BYTES`` at most
and a large book has many tasks.  Only the pages of the books asked for are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import pixels as px
from ..functions import restore
from ..sources import store

Keys = Sequence[str]
TILE_BYTES = 32_000_000
LEAST_PAGES = 3


def common_pages(pages: DataFrame, keys: Keys = ("book", "path"), share: float = 90, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """``book, height, width, channels, data``: of every cell the percentile ``share`` over the
    book's pages, rounded down.  ``keys`` begin with the book; pages are brought to the size of
    its first one.  Books of fewer than ``LEAST_PAGES`` pages and unread images give no rows."""
    book, *order = keys
    types = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    read = pages.where("image.data is not null").select(*keys, *[F.col(f"image.{c}").alias(f"_{c}") for c in ("height", "width", "nChannels", "data")])
    size = F.struct(*[F.col(f"_{c}").alias(c) for c in ("height", "width", "nChannels")])
    first = read.groupBy(F.col(book).alias("_book")).agg(F.min_by(size, F.struct(*order)).alias("_to"), F.count(F.lit(1)).alias("_n"))
    first = first.where(F.col("_n") >= LEAST_PAGES).select("_book", "_n", F.col("_to.height").alias("_h"), F.col("_to.width").alias("_w"), F.when(F.col("_to.nChannels") == 1, 1).otherwise(3).alias("_c"))
    both = read.join(store.small(first), F.col(book) == F.col("_book"))

    def tiles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.to_dict("records"):  # one page at a time: images are large
                image = px.from_row(r["_height"], r["_width"], r["_nChannels"], r["_data"])
                if r["_c"] == 1:
                    image = px.gray(image)
                elif image.ndim == 2:
                    image = np.repeat(image[..., None], r["_c"], axis=2)
                flat = np.ascontiguousarray(geo.resize(image, r["_h"], r["_w"])).ravel()
                n = max(1, tile_bytes // int(r["_n"]))
                cut = range(0, len(flat), n)
                yield pd.DataFrame({"book": r[book], "tile": range(len(cut)), "height": r["_h"], "width": r["_w"], "channels": r["_c"], "cells": [flat[k : k + n].tobytes() for k in cut]})

    head = f"book {types[book]}, tile int, height int, width int, channels int, cells binary"
    cut = both.select(book, *[c for c in both.columns if c.startswith("_") and c != "_book"]).mapInPandas(tiles, head)

    def level(own: pd.DataFrame) -> pd.DataFrame:
        stack = np.stack([np.frombuffer(c, np.uint8) for c in own["cells"]])
        return own.iloc[:1].assign(cells=[np.percentile(stack, share, axis=0).astype(np.uint8).tobytes()])

    levels = cut.groupBy("book", "tile").applyInPandas(level, head)
    joined = F.array_sort(F.collect_list(F.struct("tile", "cells")))  # the cells of one page
    whole = levels.groupBy("book", "height", "width", "channels").agg(joined.alias("t"))
    return whole.select("book", "height", "width", "channels", F.aggregate("t", F.lit(b""), lambda a, x: F.concat(a, x["cells"])).alias("data"))


def masks(pages: DataFrame, keys: Keys = ("book", "path")) -> DataFrame:
    """``book, height, width, bits``: the cells of each book's mark, a bit each; a book
    without one has no row."""

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.to_dict("records"):
                mask = restore.mark_lines(px.from_row(r["height"], r["width"], r["channels"], r["data"]))
                if mask.any():
                    yield pd.DataFrame([{"book": r["book"], "height": r["height"], "width": r["width"], "bits": np.packbits(mask).tobytes()}])

    common = common_pages(pages, keys)
    return common.mapInPandas(find, f"book {common.schema['book'].dataType.simpleString()}, height int, width int, bits binary")


def without_mark(image: np.ndarray, height: int, width: int, bits: bytes) -> np.ndarray:
    """The image with the mask's cells painted over; the mask takes the image's size."""
    mask = np.unpackbits(np.frombuffer(bits, np.uint8), count=height * width).reshape(height, width).astype(bool)
    h, w = image.shape[:2]
    mask = mask[(np.arange(h) * height // h)[:, None], (np.arange(w) * width // w)[None, :]]
    return restore.painted(image, mask)
