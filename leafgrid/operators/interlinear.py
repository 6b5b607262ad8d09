"""Double rows of small notes inside a text column.

A stretch of a column is a double row if its ink, summed down the stretch, has two humps with
a clear valley between them.  The test is on one vector, so it is a NumPy function; which
regions belong to a double row, and how normal and double stretches alternate, are windows on
the column's keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import sequence as sq

Keys = Sequence[str]

#: Regions of a window, and the least of a double row.
WINDOW_REGIONS, LEAST_REGIONS = 5, 2
#: Share of the lower hump that the valley must stay below, and of the higher that the lower reaches.
VALLEY, LIKE_HUMPS = 0.3, 0.35
TRIES = 3
#: Height of a small character against a normal one.
SMALL_HEIGHT = 0.65


def _still_edges(v: np.ndarray, height: float) -> np.ndarray:
    """The vector without ruled lines at its ends: leading and trailing cells of the outer
    quarters that stand far above the middle's level."""
    n, out = len(v), v.astype(float).copy()
    middle = out[n // 4 : n * 3 // 4]
    level = float(np.median(middle)) if len(middle) else float(out.mean())
    high = out > max(3 * level, min(0.15 * height, float(n)))
    head = int(np.argmin(np.append(high[: n // 4], False)))
    tail = int(np.argmin(np.append(high[n * 3 // 4 + 1 :][::-1], False)))
    out[:head] = 0
    out[n - tail :] = 0
    return out


def two_humps(ink: Sequence[float], height: float) -> bool:
    """Whether a stretch's ink per column (``height`` rows summed) falls into two humps.

    The deepest of the columns near the middle is tried as the valley, then, with its
    surroundings set aside, the next, ``TRIES`` in all."""
    v = np.asarray(ink, dtype=float)
    n = len(v)
    if n < 20 or v.mean() < 1:
        return False
    v = _still_edges(v, height)
    if v.mean() < 1:
        return False
    half, faint, wide = max(2, n // 40), max(2.0, 0.1 * v.mean()), max(5, int(0.15 * n))
    reach, aside = max(10, n // 5), max(5, n // 10)
    a, b = max(0, n // 2 - reach), min(n, n // 2 + reach)
    left_open = v.copy()
    for _ in range(TRIES):
        zone = left_open[a:b]
        if not len(zone) or zone.max() < 1:
            return False
        at = a + int(zone.argmin())
        s, e = max(0, at - half), min(n, at + half + 1)
        left, right = v[:s], v[e:]
        if len(left) >= 3 and len(right) >= 3:
            low, high = sorted((float(left.mean()), float(right.mean())))
            if high < 1:
                return False
            parted = low >= LIKE_HUMPS * high and v[s:e].mean() < VALLEY * low
            if parted and min((left > faint).sum(), (right > faint).sum()) >= wide and 0.30 <= at / n <= 0.70:
                return True
        left_open[max(0, at - aside) : min(n, at + aside)] = left_open.max()
    return False


def split_place(ink: Column, width: Column) -> Column:
    """The emptiest column of the middle (0.7 to 1.3 of the half), the first on ties."""
    mid = F.floor(width / 2)
    a, b = F.greatest(F.lit(0), F.floor(mid * 0.7)).cast("int"), F.least(width, F.floor(mid * 1.3)).cast("int")
    part = F.slice(ink, a + 1, F.greatest(b - a, F.lit(1)))
    return (a + F.array_position(part, F.array_min(part)) - 1).cast("int")


def hump_flags(stretches: DataFrame, keys: Keys) -> DataFrame:
    """``keys, dual`` of stretches ``keys, ink`` (an array) and ``height``."""
    types = {f.name: f.dataType.simpleString() for f in stretches.schema.fields}
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "dual boolean"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f[list(keys)].assign(dual=[two_humps(v, h) for v, h in zip(f["ink"], f["height"])])

    return stretches.select(*keys, "ink", F.col("height").cast("double").alias("height")).mapInPandas(run, schema)


def double_rows(regions: DataFrame, keys: Keys, size: int = WINDOW_REGIONS, least: int = LEAST_REGIONS, whole: Callable[[], Column] | None = None) -> DataFrame:
    """``keys, first, last``: the runs of regions (``keys, pos, ok``) that lie in some window
    of ``size`` regions (all, if a column has fewer) whose ``ok`` holds at its first region.

    ``whole`` is a condition under which a column is one run from end to end; runs shorter
    than ``least`` are none.
    """
    marked = sq.window_mark(regions, keys, "pos", F.col("ok"), size)
    if whole is not None:
        marked = marked.withColumn("marked", F.col("marked") | F.coalesce(whole(), F.lit(False)))
    found = sq.runs(marked, keys, "pos", F.col("marked")).where(F.col("run_length") >= least)
    return found.select(*keys, F.col("run_start").alias("first"), (F.col("run_end") - 1).alias("last"))


def alternating(regions: DataFrame, rows: DataFrame, keys: Keys) -> DataFrame:
    """``keys, seg, kind, first, last``: a column's regions (``keys, pos``) as normal and
    double stretches in turn, ``rows`` (``first, last``) being the double ones."""
    r = regions.select(*keys, "pos")
    inside = (F.col("pos") >= F.col("first")) & (F.col("pos") <= F.col("last"))
    held = r.join(rows.select(*[F.col(k).alias(f"_{k}") for k in keys], "first", "last"), [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left")
    mark = held.groupBy(*keys, "pos").agg(F.max(F.when(inside, F.col("first"))).alias("row"))
    w = Window.partitionBy(*keys).orderBy("pos")
    before = F.lag(F.coalesce("row", F.lit(-1))).over(w)
    opened = (before.isNull() | (before != F.coalesce("row", F.lit(-1)))).cast("int")
    numbered = mark.withColumn("_o", opened).withColumn("seg", F.sum("_o").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    kind = F.when(F.col("row").isNull(), "normal").otherwise("double")
    return numbered.withColumn("kind", kind).groupBy(*keys, "seg", "kind").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))


def interleaved(cells: DataFrame, keys: Keys, sub: str, i: str) -> DataFrame:
    """Two ordered sides of a key in reading order: row ``i`` of side 1, then of side 2;
    ``place`` counts them from 1."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(i, sub))
    return cells.withColumn("place", place.cast("long"))


def column_cells(segments: DataFrame, pieces: DataFrame, keys: Keys) -> DataFrame:
    """``keys, index, sub_col, type, y_top, y_bottom, text, confidence`` of columns with
    double rows.

    ``segments`` are :func:`alternating`'s; ``pieces`` (``keys, seg, sub_col, i, y_top,
    y_bottom, text``) are the regions of each stretch with their recognised character, if
    any: ``sub_col`` is null in a normal one, 1 (right) or 2 (left) in a double one, and
    ``i`` counts from 0.  A double stretch takes as many rows as its longer side.
    """
    long = pieces.groupBy(*keys, "seg").agg((F.max("i") + 1).alias("rows"))
    order = Window.partitionBy(*keys).orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    base = segments.join(long, [*keys, "seg"], "left").withColumn("base", F.coalesce(F.sum(F.coalesce("rows", F.lit(0))).over(order), F.lit(0)))
    both = pieces.join(base.select(*keys, "seg", "kind", "base"), [*keys, "seg"])
    text = F.when(F.length("text") > 0, F.col("text"))
    kind = F.when(F.col("kind") == "double", "jiazhu").when(text.isNotNull(), "char").otherwise("empty")
    return both.select(
        *keys, (F.col("base") + F.col("i")).cast("int").alias("index"), "sub_col", kind.alias("type"), F.round("y_top", 2).alias("y_top"), F.round("y_bottom", 2).alias("y_bottom"),
        text.alias("text"), F.when(text.isNotNull(), 1.0).otherwise(0.0).alias("confidence"),
    )
