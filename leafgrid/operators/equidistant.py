"""Evenly spaced lines among candidates: which N + 1 upright lines are a page's grid.

Pairs of outer lines are enumerated by a self-join on the page's key, the candidates of a page
being a few dozen; for each pair the inner lines are chosen by a fold over the ideal places
(each takes the nearest candidate after the last one taken), and pairs are scored by
expressions.  A page's map onto its ideal grid is a robust fit of its few dozen points.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import pixels as px
from ..sources import store

Keys = Sequence[str]

#: Least share of the page's height, of its width for the whole grid, and of the spacing.
LEAST_LENGTH, LEAST_SPAN, STRAY = 0.3, 0.3, 0.3
#: A frame's outer line stands nearer than this, and than half a spacing.
COMPANION, COMPANION_BONUS = 80.0, 0.15
EDGE_ZONE, EDGE_PENALTY = 0.15, 0.3
#: Of a grid that was chosen: how near an end's outer line is, in spacings, and how long an
#: end must be beside the lines between.
NEAR_SHARE, SHORT_SHARE = 0.4, 0.85


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` worked out once a row: a generator of one row is not folded into
    the expressions that use it, as a plain column would be, down to the elements of arrays."""
    return df.withColumn(name, F.explode(F.array(value)))


def median_of(xs: Column) -> Column:
    """The median of an array, the mean of the middle two."""
    s, n = F.array_sort(xs), F.size(xs)
    return (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2


def spread_of(xs: Column) -> Column:
    """Population standard deviation of an array."""
    n = F.size(xs)
    mean = F.aggregate(xs, F.lit(0.0), lambda a, x: a + x) / n
    return F.sqrt(F.aggregate(xs, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / n)


def _inner_lines(lines: Column, left: Column, right: Column, spacing: Column, n: int) -> Column:
    """``struct<dev, taken, failed>``: for each ideal place between the ends the nearest line
    after the last one taken (the first on ties), none if all are too far."""
    zero = F.struct(F.lit(0.0).alias("dev"), F.array(left["id"]).alias("taken"), left["rank"].alias("last"), F.lit(False).alias("failed"))

    def step(acc: Column, k: Column) -> Column:
        at = left["x"] + k * spacing
        open_ = F.filter(lines, lambda c: (c["rank"] > acc["last"]) & (c["rank"] < right["rank"]))
        near = F.array_min(F.transform(open_, lambda c: F.struct(F.abs(c["x"] - at).alias("d"), c["rank"].alias("rank"), c["id"].alias("id"))))

        def taken(near: Column) -> Column:
            failed = acc["failed"] | near.isNull() | (near["d"] > STRAY * spacing)
            return F.struct(
                F.when(failed, acc["dev"]).otherwise(acc["dev"] + near["d"]).alias("dev"), F.when(failed, acc["taken"]).otherwise(F.concat(acc["taken"], F.array(near["id"]))).alias("taken"),
                F.when(failed, acc["last"]).otherwise(near["rank"]).alias("last"), failed.alias("failed"),
            )

        return F.get(F.transform(F.array(near), taken), F.lit(0))

    places = F.sequence(F.lit(1), F.lit(n - 1)) if n > 1 else F.array().cast("array<int>")
    return F.aggregate(places, zero, step)


def equidistant(lines: DataFrame, pages: DataFrame, keys: Keys, n: int) -> DataFrame:
    """``keys, ids, spacing, score``: the ``n + 1`` lines of each page (``keys, id, x,
    length``) that part it best into ``n`` columns; ``pages`` has ``keys, page_width,
    page_height``.  Pages without such lines give no row.

    The score adds the mean stray from even places, the spread of the lengths over their
    median, and a penalty near the page's edges, and takes off a bonus for each end that has
    an outer companion; the smallest wins, the leftmost pair on ties.
    """
    rows = lines.join(pages.select(*keys, "page_width", "page_height"), list(keys))
    long_enough = F.col("length") >= LEAST_LENGTH * F.col("page_height")
    item = F.struct("x", "id", F.col("length").cast("double").alias("length"))
    page = rows.groupBy(*keys).agg(
        F.first("page_width").cast("double").alias("page_width"), F.array_sort(F.collect_list(item)).alias("every"), F.array_sort(F.collect_list(F.when(long_enough, item))).alias("some"),
    )
    page = page.where(F.size("some") >= n + 1)
    ranked = F.transform("some", lambda c, k: F.struct(k.alias("rank"), c["x"].cast("double").alias("x"), c["id"].alias("id"), c["length"].alias("length")))
    page = page.withColumn("some", ranked).withColumn("least", median_of(F.transform("some", lambda c: c["length"])) * 0.5)
    # few bytes and much work a page: as many tasks as the session shuffles to
    page = page.repartition(int(page.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    left = page.withColumn("a", F.explode("some"))
    pair = left.withColumn("b", F.explode(F.filter("some", lambda c: (c["rank"] >= F.col("a.rank") + n) & (c["x"] - F.col("a.x") >= LEAST_SPAN * F.col("page_width")))))
    pair = pair.withColumn("spacing", (F.col("b.x") - F.col("a.x")) / n)
    pair = once(pair, "fold", _inner_lines(F.col("some"), F.col("a"), F.col("b"), F.col("spacing"), n)).where(~F.col("fold.failed") & (F.col("spacing") > 0))
    pair = once(pair, "ids", F.concat("fold.taken", F.array("b.id")))
    lengths = F.transform(F.filter("some", lambda c: F.array_contains("ids", c["id"])), lambda c: c["length"])
    pair = once(pair, "lengths", lengths)
    middle = median_of(F.col("lengths"))
    cv = F.when(middle > 0, spread_of(F.col("lengths")) / middle).otherwise(0.0)
    reach = F.least(F.lit(COMPANION), F.col("spacing") * 0.5)
    long = F.filter("every", lambda c: c["length"] >= F.col("least"))
    beside = lambda gap: F.when(F.exists(long, lambda c: (gap(c) > 5) & (gap(c) <= reach)), COMPANION_BONUS).otherwise(0.0)
    bonus = beside(lambda c: F.col("a.x") - c["x"]) + beside(lambda c: c["x"] - F.col("b.x"))
    zone = EDGE_ZONE * F.col("page_width")
    edge = lambda depth: F.when(depth < zone, EDGE_PENALTY * (1.0 - depth / zone)).otherwise(0.0)
    penalty = edge(F.col("a.x")) + edge(F.col("page_width") - F.col("b.x"))
    score = F.col("fold.dev") / (n * F.col("spacing")) + cv - bonus + penalty
    best = F.min(F.struct(score.alias("score"), F.col("a.rank").alias("r1"), F.col("b.rank").alias("r2"), "ids", "spacing")).alias("best")
    return pair.groupBy(*keys).agg(best).select(*keys, "best.ids", "best.spacing", "best.score")


def _with_checked_ends(x: np.ndarray, length: np.ndarray, chosen: list[int], n: int, width: float, height: float) -> list[int] | None:
    """Places of a page's lines, in order of ``x``, after the checks of :func:`checked_ends`."""
    candidate = np.flatnonzero(length >= LEAST_LENGTH * height)
    long = length >= np.median(length[candidate]) * 0.5
    spacing = (x[chosen[-1]] - x[chosen[0]]) / n
    reach = min(COMPANION, NEAR_SHARE * spacing)

    def beside(k: int, side: int) -> bool:
        gap = side * (x - x[k])
        return bool((long & (gap > 5) & (gap <= reach)).any())

    def next_out(end: int, side: int, step: float, wanted) -> int | None:
        gap = side * (x[candidate] - x[end])
        return next((int(k) for k in candidate[np.abs(gap - step) < STRAY * step][::side] if wanted(k)), None)

    out = list(chosen)
    for side, end in ((-1, chosen[0]), (1, chosen[-1])):
        if beside(end, side):
            continue
        depth = (lambda k: x[k]) if side < 0 else (lambda k: width - x[k])
        more = next_out(end, side, spacing, lambda k: depth(k) >= EDGE_ZONE * width and beside(k, side))  # noqa: B023
        if more is not None:
            out = [more, *out[:n]] if side < 0 else [*out[1:], more]
    usual = float(np.median(length[out[1:-1]])) if n > 1 else 0.0
    for side in (-1, 1):
        if len(out) != n + 1 or length[out[0 if side < 0 else -1]] >= usual * SHORT_SHARE:
            continue
        out = out[1:] if side < 0 else out[:-1]
        other = out[-1] if side < 0 else out[0]
        more = next_out(other, -side, (x[out[-1]] - x[out[0]]) / max(len(out) - 1, 1), lambda k: True)
        out = out if more is None else [*out, more] if side < 0 else [more, *out]
    return out if len(out) == n + 1 else None


def checked_ends(lines: DataFrame, chosen: DataFrame, pages: DataFrame, keys: Keys, n: int) -> DataFrame:
    """``keys, ids, spacing``: the grids of :func:`equidistant` with their ends checked.

    An end without an outer companion moves one spacing out to a line that has one, not into
    the page's edge zone; an end shorter than 85 % of the lines between is dropped, and the
    other end moves out instead.  Pages left with another number of lines give no row.
    """
    item = F.struct(F.col("x").cast("double").alias("x"), "id", F.col("length").cast("double").alias("length"))
    every = lines.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("c"))
    page = every.join(chosen.select(*keys, "ids"), list(keys)).join(pages.select(*keys, "page_width", "page_height"), list(keys))
    part = lambda name: F.transform("c", lambda c: c[name])
    picked = F.transform("ids", lambda i: (F.array_position(part("id"), i) - 1).cast("int"))
    narrow = page.select(*keys, part("x").alias("_x"), part("length").alias("_length"), picked.alias("_picked"), F.col("page_width").cast("double").alias("_w"), F.col("page_height").cast("double").alias("_h"), part("id").alias("_id"))
    types = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), f"ids {types['_id']}, spacing double"])

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.to_dict("records"):
                x = np.asarray(r["_x"], float)
                kept = _with_checked_ends(x, np.asarray(r["_length"], float), list(r["_picked"]), n, r["_w"], r["_h"])
                if kept is not None:
                    out.append({k: r[k] for k in keys} | {"ids": [r["_id"][k] for k in kept], "spacing": (x[kept[-1]] - x[kept[0]]) / n})
            yield pd.DataFrame(out, columns=[*keys, "ids", "spacing"])

    return narrow.mapInPandas(check, schema)


def expected_places(ends: DataFrame, keys: Keys, n: int) -> DataFrame:
    """``keys, k, x``: the ideal places of ``n`` equal columns between ``left`` and ``right``."""
    return ends.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(n))).alias("k"), "left", "right").select(
        *keys, "k", (F.col("left") + F.col("k") * (F.col("right") - F.col("left")) / n).alias("x")
    )


def grid_maps(points: DataFrame, keys: Keys, tolerance: float = 5.0) -> DataFrame:
    """``keys, matrix, followers``: the projective map (nine numbers, by rows) that most of a
    page's ``points`` (``x, y`` found, ``to_x, to_y`` ideal) follow within ``tolerance``.

    A page has two points a line.  One with fewer than four points that agree, or all of them
    in a line, has a null matrix.
    """
    types = {f.name: f.dataType.simpleString() for f in points.schema.fields}
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "matrix array<double>, followers int"])

    def fit(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["to_x", "to_y", "x", "y"])
        matrix, follows = geo.robust_homography(own[["x", "y"]].to_numpy(float), own[["to_x", "to_y"]].to_numpy(float), tolerance)
        return pd.DataFrame([dict(zip(keys, key)) | {"matrix": None if matrix is None else matrix.ravel().tolist(), "followers": int(follows.sum())}])

    whole = points.select(*keys, *[F.col(c).cast("double").alias(c) for c in ("x", "y", "to_x", "to_y")]).dropna(subset=["x", "y", "to_x", "to_y"])
    return whole.groupBy(*keys).applyInPandas(fit, schema)


def warped(pages: DataFrame, maps: DataFrame, keys: Keys) -> DataFrame:
    """``keys, width, height, channels, data``: pages under their maps, at the median size of
    all pages; a page without a map comes out as it is read."""
    size = pages.agg(F.median("image.width").cast("int").alias("_w"), F.median("image.height").cast("int").alias("_h"))
    own = maps.select(*keys, F.col("matrix").alias("_matrix"))
    both = pages.join(store.small(own), list(keys), "left").join(F.broadcast(size))  # one row
    types = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "width int, height int, channels int, data binary"])
    narrow = both.select(*keys, "_matrix", "_w", "_h", *[F.col(f"image.{c}").alias(f"_{c}") for c in ("height", "width", "nChannels", "data")])

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.to_dict("records"):  # one page at a time: images are large
                image = px.from_row(r["_height"], r["_width"], r["_nChannels"], r["_data"])
                if r["_matrix"] is not None:
                    image = geo.warp(image, np.array(r["_matrix"], float).reshape(3, 3), r["_h"], r["_w"])
                out = {"width": image.shape[1], "height": image.shape[0], "channels": 1 if image.ndim == 2 else image.shape[2], "data": np.ascontiguousarray(image).tobytes()}
                yield pd.DataFrame([{k: r[k] for k in keys} | out])

    return narrow.mapInPandas(apply, schema)
