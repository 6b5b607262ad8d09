"""Ruled-page structure from line segments: clusters, frame, dividers, columns.

Clustering depends on the order of the segments (each joins the nearest line so far, which
is refitted), so it runs as a fold per (page, axis), a few thousand rows; everything after it
is expressions, windows and joins on the page's keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import angle_from_vertical, segment_kind
from .joins import best_candidate

Keys = Sequence[str]

POS_TOL, MAX_GAP = 15.0, 60.0
MIN_COVERAGE, LAYER_DIST, EDGE, SLOPE_DIFF = 0.3, 80.0, 10.0, 0.02
MIN_LENGTH = 30.0


def tolerances(profiles: DataFrame) -> DataFrame:
    """``book, pos_tol, max_gap, min_coverage``: wider and lower for heavily worn borders."""
    heavy = F.col("border_wear") == "heavy"
    scaled = lambda base, by: F.when(heavy, base * by).otherwise(F.lit(base))
    return profiles.select("book", scaled(POS_TOL, 1.3).alias("pos_tol"), scaled(MAX_GAP, 1.5).alias("max_gap"), scaled(MIN_COVERAGE, 0.7).alias("min_coverage"))


def classify(segments: DataFrame, least: float = MIN_LENGTH, tolerance: float = 10.0) -> DataFrame:
    """Segments ``x1, y1, x2, y2`` long enough, with ``length``, ``angle`` and ``type``."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    s = segments.withColumn("length", F.sqrt(dx * dx + dy * dy)).where(F.col("length") >= least)
    return s.withColumn("angle", angle_from_vertical(dx, dy)).withColumn("type", segment_kind(F.col("angle"), tolerance))


def summary(segments: DataFrame, keys: Keys) -> DataFrame:
    count = lambda t: F.count_if(F.col("type") == t).alias(t)
    return segments.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), count("vertical"), count("horizontal"), count("other"))


class _Line:
    """A weighted line through end points, kept as sums about its first coordinate."""

    def __init__(self) -> None:
        self.s = np.zeros(5)
        self.n = 0
        self.low, self.high, self.total = np.inf, -np.inf, 0.0
        self.origin: float | None = None
        self.spans: list[tuple[float, float]] = []
        self.widths: list[float] = []
        self.slope = self.intercept = 0.0

    def add(self, c: np.ndarray, p: np.ndarray, weight: float) -> None:
        if self.origin is None:
            self.origin = float(c[0])
        u, w = c - self.origin, weight * weight
        self.s += w * np.array([2, u.sum(), (u * u).sum(), p.sum(), (u * p).sum()])
        self.n += 2
        self.total += p.sum()
        self.low, self.high = min(self.low, c.min()), max(self.high, c.max())

    def absorb(self, other: "_Line") -> None:
        shift = other.origin - self.origin
        w, wu, wuu, wp, wup = other.s
        self.s += np.array([w, wu + shift * w, wuu + 2 * shift * wu + shift * shift * w, wp, wup + shift * wp])
        self.n += other.n
        self.total += other.total
        self.low, self.high = min(self.low, other.low), max(self.high, other.high)
        self.spans += other.spans
        self.widths += other.widths

    def fit(self) -> None:
        w, wu, wuu, wp, wup = self.s
        bottom = w * wuu - wu * wu
        if self.high - self.low < 5 or bottom <= 0:
            self.slope, self.intercept = 0.0, self.total / self.n
        else:
            self.slope = (w * wup - wu * wp) / bottom
            self.intercept = (wp - self.slope * wu) / w - self.slope * self.origin

    def distance(self, c: np.ndarray, p: np.ndarray) -> float:
        return float(np.abs(p - (self.slope * c + self.intercept)).max())


def _cluster(rows: pd.DataFrame, pos_tol: float, max_gap: float) -> list[dict]:
    along = rows[["c1", "c2"]].to_numpy(float)
    across = rows[["p1", "p2"]].to_numpy(float)
    width = rows["width"].to_numpy(float)
    lines: list[_Line] = []
    for k in np.argsort(across.mean(axis=1), kind="stable"):
        c, p = along[k], across[k]
        near = [line.distance(c, p) for line in lines]
        best = int(np.argmin(near)) if near else -1
        if best < 0 or near[best] > pos_tol:
            lines.append(_Line())
        line = lines[best if best >= 0 and near[best] <= pos_tol else -1]
        line.add(c, p, max((c.max() - c.min()) / 2, 1.0))
        line.spans.append((c.min(), c.max()))
        line.widths.append(width[k])
        line.fit()
    lines.sort(key=lambda g: g.intercept)
    merged: list[_Line] = []
    for g in lines:
        if merged and abs(g.intercept - merged[-1].intercept) <= pos_tol:
            merged[-1].absorb(g)
            merged[-1].fit()
        else:
            merged.append(g)
    out = []
    for g in sorted(merged, key=lambda g: g.intercept):
        spans: list[list[float]] = []
        for s, e in sorted(g.spans):
            if spans and s <= spans[-1][1] + max_gap:
                spans[-1][1] = max(spans[-1][1], e)
            else:
                spans.append([s, e])
        out.append({
            "intercept": g.intercept, "slope": g.slope, "segments": [{"s": s, "e": e} for s, e in spans],
            "total_length": float(sum(e - s for s, e in spans)), "avg_width": float(np.mean(g.widths)), "line_count": len(g.spans),
        })
    return out


def fold_lines(rows: pd.DataFrame, pos_tol: float = POS_TOL, max_gap: float = MAX_GAP) -> list[dict]:
    """The collinear clusters of one axis, by intercept, from ``c1, p1, c2, p2, width``: ends
    along the axis and across it."""
    return _cluster(rows.sort_values(["c1", "p1", "c2", "p2", "width"], kind="stable"), pos_tol, max_gap)


def cluster(segments: DataFrame, keys: Keys, pos_tol: float = POS_TOL, max_gap: float = MAX_GAP) -> DataFrame:
    """Collinear clusters of the horizontal and vertical segments of :func:`classify` (with
    ``width``): ``keys, axis, cluster_id, intercept, slope, segments, total_length, avg_width,
    line_count``, numbered by intercept.  Lines are position = slope * coordinate + intercept."""
    across = F.col("type") == "horizontal"
    pick = lambda a, b: F.when(across, F.col(a)).otherwise(F.col(b)).cast("double")
    rows = segments.where("type in ('horizontal', 'vertical')").select(
        *keys, F.when(across, "h").otherwise("v").alias("axis"), pick("x1", "y1").alias("c1"), pick("y1", "x1").alias("p1"),
        pick("x2", "y2").alias("c2"), pick("y2", "x2").alias("p2"), F.coalesce(F.col("width").cast("double"), F.lit(1.0)).alias("width"),
    )
    keyed = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keys)]]
    schema = ", ".join([*keyed, "axis string, cluster_id int, intercept double, slope double, segments array<struct<s:double,e:double>>, total_length double, avg_width double, line_count int"])
    names = [*keys, "axis"]

    def fold(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        found = fold_lines(own, pos_tol, max_gap)
        return pd.DataFrame([dict(zip(names, key)) | {"cluster_id": k} | c for k, c in enumerate(found)])

    return rows.groupBy(*names).applyInPandas(fold, schema)


def longest_piece(segments: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(segments, lambda x: x["e"] - x["s"])), F.lit(0.0))


def structural(span: Column, coverage: float = MIN_COVERAGE) -> Column:
    """A frame or column line rather than strokes of letters: long enough in all, or many
    segments that join into few long pieces."""
    pieces = F.size("segments")
    dense = (F.try_divide(F.col("line_count"), pieces) >= 5) & (longest_piece(F.col("segments")) >= 100) & (F.col("line_count") >= 5)
    return (F.coalesce(F.try_divide(F.col("total_length"), span), F.lit(0.0)) >= coverage) | dense


def frame_pairs(clusters: DataFrame, pages: DataFrame, keys: Keys, coverage: float = MIN_COVERAGE) -> DataFrame:
    """``keys, side, outer, inner`` for top, bottom, left and right; ``pages`` has ``keys,
    page_width, page_height``.  The outer line is the first structural one from its edge that
    is no scanning artefact; the inner one the next within reach and of like slope."""
    c = clusters.join(pages.select(*keys, "page_width", "page_height"), list(keys))
    size = F.when(F.col("axis") == "h", F.col("page_height")).otherwise(F.col("page_width"))
    span = F.when(F.col("axis") == "h", F.col("page_width")).otherwise(F.col("page_height"))
    at = F.col("intercept")
    artefact = ((at < EDGE) | (at > size - EDGE)) & ((F.col("avg_width") < 2) | (F.col("line_count") <= 1))
    c = c.where(structural(span, coverage) & ~artefact)
    sides = F.when(F.col("axis") == "h", F.array(F.lit("top"), F.lit("bottom"))).otherwise(F.array(F.lit("left"), F.lit("right")))
    c = c.withColumn("side", F.explode(sides)).withColumn("depth", F.when(F.col("side").isin("top", "left"), at).otherwise(-at))
    w = Window.partitionBy(*keys, "side").orderBy("depth", "cluster_id")
    line = F.struct("cluster_id", "intercept", "slope", "avg_width", "total_length", "line_count", "segments")
    c = c.withColumn("line", line).withColumn("first", F.first("line").over(w)).withColumn("rank", F.row_number().over(w))
    reach = (F.abs(at - F.col("first.intercept")) <= LAYER_DIST) & (F.abs(F.col("slope") - F.col("first.slope")) <= SLOPE_DIFF) & (F.col("rank") > 1)
    return c.groupBy(*keys, "side").agg(F.min_by("line", "rank").alias("outer"), F.min_by(F.when(reach, F.col("line")), F.when(reach, F.col("rank"))).alias("inner"))


def inner_frame(pairs: DataFrame, pages: DataFrame, keys: Keys) -> DataFrame:
    """``keys, top, bottom, left, right`` of the innermost lines, the page's edges without."""
    inner = F.coalesce("inner.intercept", "outer.intercept")
    got = pairs.groupBy(*keys).agg(*[F.max(F.when(F.col("side") == s, inner)).alias(s) for s in ("top", "bottom", "left", "right")])
    both = pages.join(got, list(keys), "left")
    edge = {"top": F.lit(0.0), "left": F.lit(0.0), "bottom": F.col("page_height").cast("double"), "right": F.col("page_width").cast("double")}
    return both.select(*keys, "page_width", "page_height", *[F.coalesce(F.col(s), e).alias(s) for s, e in edge.items()])


def dividers(clusters: DataFrame, pairs: DataFrame, frame: DataFrame, keys: Keys, pos_tol: float = POS_TOL) -> DataFrame:
    """The upright lines inside the frame that part columns, told from borders by id."""
    border = pairs.where("side in ('left', 'right')").select(*keys, F.explode(F.array("outer.cluster_id", "inner.cluster_id")).alias("cluster_id")).where("cluster_id is not null")
    v = clusters.where("axis = 'v'").join(border, [*keys, "cluster_id"], "left_anti").join(frame, list(keys))
    height = F.when(F.col("bottom") > F.col("top"), F.col("bottom") - F.col("top")).otherwise(F.col("page_height"))
    v = v.withColumn("coverage", F.col("total_length") / height).withColumn("piece", longest_piece(F.col("segments")) / height)
    dense = (F.try_divide(F.col("line_count"), F.size("segments")) >= 5) & (F.col("line_count") >= 5)
    long_enough = ((F.col("coverage") >= 0.30) | (F.col("piece") >= 0.20)) & (F.col("piece") >= 0.10)
    at = F.col("intercept")
    inside = at.between(F.col("left") - pos_tol, F.col("right") + pos_tol) & at.between(EDGE, F.col("page_width") - EDGE)
    return v.where(inside & (dense | long_enough) & (F.abs("slope") <= 0.04)).select(*keys, "cluster_id", "intercept", "slope", "coverage")


def columns(dividers_: DataFrame, frame: DataFrame, keys: Keys) -> DataFrame:
    """``keys, idx, left_x, right_x, width`` numbered from the right, after dropping the
    weaker divider beside each column narrower than 0.3 of the page's median width."""

    def between(lines: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy("x", "cluster_id")
        nxt = F.lead(F.struct("x", "cluster_id", "coverage")).over(w)
        return lines.withColumn("n", nxt).where("n is not null").withColumn("width", F.col("n.x") - F.col("x"))

    ends = frame.select(*keys, F.explode(F.array("left", "right")).alias("x"), F.lit(None).cast("int").alias("cluster_id"), F.lit(None).cast("double").alias("coverage"))
    lines = dividers_.select(*keys, F.col("intercept").alias("x"), "cluster_id", "coverage").unionByName(ends)
    first = between(lines)
    usual = first.groupBy(*keys).agg(F.median("width").alias("usual"), F.count(F.lit(1)).alias("many"))
    narrow = first.join(usual, list(keys)).where("many >= 3 and width < usual * 0.3")
    weaker = F.when(F.col("cluster_id").isNull(), F.col("n.cluster_id")).when(F.col("n.cluster_id").isNull(), F.col("cluster_id")).when(F.col("coverage") <= F.col("n.coverage"), F.col("cluster_id")).otherwise(F.col("n.cluster_id"))
    drop = narrow.select(*keys, weaker.alias("cluster_id")).where("cluster_id is not null").distinct()
    kept = lines.join(drop, [*keys, "cluster_id"], "left_anti")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("x"), F.desc("n.x")))
    return between(kept).select(*keys, rank.alias("idx"), F.col("x").alias("left_x"), F.col("n.x").alias("right_x"), "width")


def column_stats(cols: DataFrame, keys: Keys, expected: int | None = None) -> DataFrame:
    """``mean, std, cv, is_uniform`` of the widths, the number of columns, and whether it is
    the expected one."""
    mean, std = F.avg("width"), F.stddev_pop("width")
    out = cols.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("num_columns"), mean.alias("mean"), std.alias("std"), F.coalesce(F.try_divide(std, mean), F.lit(0.0)).alias("cv"))
    out = out.withColumn("is_uniform", F.col("cv") < 0.15)
    return out if expected is None else out.withColumn("mismatch", F.when(F.col("num_columns") != expected, F.struct(F.lit(expected).alias("expected"), F.col("num_columns").alias("detected"))))


def corrected(cols: DataFrame, keys: Keys, expected: Column) -> DataFrame:
    """Columns of pages that have fewer than ``expected``, uneven in width: those wider than one
    and a half of the expected width are cut evenly into as many as they hold; numbered from
    the right.  Other pages keep their columns."""
    w = Window.partitionBy(*keys)
    mean, std = F.avg("width").over(w), F.stddev_pop("width").over(w)
    c = cols.withColumn("_want", expected).withColumn("_few", (F.count(F.lit(1)).over(w) < F.col("_want")) & (F.coalesce(F.try_divide(std, mean), F.lit(0.0)) >= 0.15))
    c = c.withColumn("_usual", (F.max("right_x").over(w) - F.min("left_x").over(w)) / F.col("_want"))
    pieces = F.when(F.col("_few") & (F.col("width") > 1.5 * F.col("_usual")), F.greatest(F.bround(F.col("width") / F.col("_usual")).cast("int"), F.lit(1))).otherwise(F.lit(1))
    c = c.withColumn("_n", pieces).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).withColumn("_part", F.col("width") / F.col("_n"))
    left = F.col("left_x") + F.col("_k") * F.col("_part")
    right = F.when(F.col("_n") > 1, left + F.col("_part")).otherwise(F.col("right_x"))
    made = c.select(*keys, left.alias("left_x"), right.alias("right_x"), F.col("_part").alias("width"))
    return made.select(*keys, F.row_number().over(w.orderBy(F.desc("left_x"), F.desc("right_x"))).alias("idx"), "left_x", "right_x", "width")


def recovered(clusters: DataFrame, frame: DataFrame, cols: DataFrame, pairs: DataFrame, keys: Keys, expected: Column) -> DataFrame:
    """``keys, side, at, origin``: for pages with fewer columns than ``expected`` (a column of
    ``frame``'s page), the faint border that would make one more.

    ``line``: a structural line beyond the frame that is no border, whose new column is nearest
    to the mean width and within half and one and a half of it, right before left on ties.
    ``width``: without one, and with even columns, the mean width beyond the frame, on the side
    with more room.  The old border then parts columns.
    """
    even = F.coalesce(F.try_divide(F.stddev_pop("width"), F.avg("width")), F.lit(1.0))
    usual = cols.groupBy(*keys).agg(F.avg("width").alias("mean"), even.alias("cv"), F.count(F.lit(1)).alias("n"))
    page = frame.withColumn("_want", expected).join(usual, list(keys)).where(F.col("n") < F.col("_want"))
    used = pairs.where("side in ('left', 'right')").select(*keys, F.explode(F.array("outer.cluster_id", "inner.cluster_id")).alias("cluster_id")).where("cluster_id is not null")
    free = clusters.where("axis = 'v'").join(used, [*keys, "cluster_id"], "left_anti").join(page, list(keys))
    free = free.where(structural(F.col("bottom") - F.col("top")))
    at = F.col("intercept")
    side = F.when((at > F.col("right") + 10) & (at <= F.col("page_width") - 5), 0).when((at < F.col("left") - 10) & (at >= 5), 1)
    wide = F.when(side == 0, at - F.col("right")).otherwise(F.col("left") - at)
    found = free.withColumn("side", side).withColumn("width", wide).where("side is not null")
    best = best_candidate(found, keys, "width", "mean", "side", "cluster_id").join(clusters.where("axis = 'v'").select(*keys, "cluster_id", "intercept"), [*keys, "cluster_id"])
    line = best.select(*keys, F.when(F.col("side") == 0, "right").otherwise("left").alias("side"), F.col("intercept").alias("at"), F.lit("line").alias("origin"))
    rest = page.join(best.select(*keys), list(keys), "left_anti").where("cv < 0.10")
    to_right, to_left = F.col("right") + F.col("mean"), F.col("left") - F.col("mean")
    right_ok = (to_right > 10) & (to_right < F.col("page_width") - 5)
    left_ok = (to_left > 5) & (to_left < F.col("page_width") - 10)
    roomy = F.col("page_width") - F.col("right") >= F.col("left")
    which = F.when(right_ok & (~left_ok | roomy), "right").when(left_ok, "left")
    guess = rest.withColumn("side", which).where("side is not null").select(*keys, "side", F.when(F.col("side") == "right", to_right).otherwise(to_left).alias("at"), F.lit("width").alias("origin"))
    return line.unionByName(guess)


def with_recovered(dividers_: DataFrame, frame: DataFrame, found: DataFrame, keys: Keys) -> tuple[DataFrame, DataFrame]:
    """Dividers and frame with the recovered borders: the old border parts columns."""
    both = frame.join(found.select(*keys, F.col("side").alias("_side"), F.col("at").alias("_at")), list(keys), "left")
    old = both.where("_side is not null").select(*keys, F.lit(-1).alias("cluster_id"), F.when(F.col("_side") == "right", F.col("right")).otherwise(F.col("left")).alias("intercept"), F.lit(0.0).alias("slope"), F.lit(1.0).alias("coverage"))
    moved = both.withColumn("right", F.when(F.col("_side") == "right", F.col("_at")).otherwise(F.col("right"))).withColumn("left", F.when(F.col("_side") == "left", F.col("_at")).otherwise(F.col("left")))
    return dividers_.unionByName(old), moved.drop("_side", "_at")


def sane_frame(frame: DataFrame, clusters: DataFrame, keys: Keys) -> DataFrame:
    """A frame lower than 30 % of its page takes for its top and bottom the longest level line
    of the outer 15 %, else the median ends of the upright lines."""
    low = (F.col("bottom") - F.col("top")) < 0.30 * F.col("page_height")
    flat = clusters.join(frame.where(low).select(*keys, "page_height"), list(keys))
    zone = lambda ok: F.when((F.col("axis") == "h") & ok, F.col("intercept"))
    top_zone, bottom_zone = F.col("intercept") < 0.15 * F.col("page_height"), F.col("intercept") > 0.85 * F.col("page_height")
    longest = lambda ok: F.max_by(zone(ok), F.when(zone(ok).isNotNull(), F.struct("total_length", -F.col("cluster_id"))))
    ends = F.when((F.col("axis") == "v") & (F.size("segments") > 0), F.array_min(F.transform("segments", lambda x: x["s"]))), F.when((F.col("axis") == "v") & (F.size("segments") > 0), F.array_max(F.transform("segments", lambda x: x["e"])))
    better = flat.groupBy(*keys).agg(F.coalesce(longest(top_zone), F.median(ends[0])).alias("_t"), F.coalesce(longest(bottom_zone), F.median(ends[1])).alias("_b"))
    both = frame.join(better, list(keys), "left")
    return both.withColumn("top", F.coalesce("_t", "top")).withColumn("bottom", F.coalesce("_b", "bottom")).drop("_t", "_b")


def detect(segments: DataFrame, pages: DataFrame, keys: Keys, expected: Column | None = None, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> dict[str, DataFrame]:
    """``clusters, pairs, frame, dividers, columns`` of every page from its segments; with
    ``expected`` columns (an expression over ``pages``), faint borders are sought and wide
    columns cut.

    Each table is used by several that follow; ``keep`` says how it is kept between (a
    checkpoint), without which the plan grows with every use.
    """
    clusters = keep(cluster(classify(segments), keys))
    pairs = keep(frame_pairs(clusters, pages, keys))
    frame = keep(sane_frame(inner_frame(pairs, pages, keys), clusters, keys))
    parts = keep(dividers(clusters, pairs, frame, keys))
    cols = keep(columns(parts, frame, keys))
    if expected is not None:
        want = keep(pages.select(*keys, expected.alias("_want")))
        found = keep(recovered(clusters, frame.join(want.withColumnRenamed("_want", "expected"), list(keys)), cols, pairs, keys, F.col("expected")))
        parts, frame = (keep(df) for df in with_recovered(parts, frame, found, keys))
        cols = keep(columns(parts, frame, keys))
        cols = keep(corrected(cols.join(want, list(keys)), keys, F.col("_want")))
    return {"clusters": clusters, "pairs": pairs, "frame": frame, "dividers": parts, "columns": cols}


def layout_document(found: dict[str, DataFrame], keys: Keys) -> DataFrame:
    """``keys, layout``: one JSON document per page: borders by side and layer, the inner
    frame, dividers and columns with their spread."""
    layer = lambda c: F.struct(*[F.col(f"{c}.{f}").alias(f) for f in ("intercept", "slope", "avg_width", "total_length", "line_count", "segments")])
    side = F.struct("side", F.when(F.col("outer").isNotNull(), layer("outer")).alias("outer"), F.when(F.col("inner").isNotNull(), layer("inner")).alias("inner"))
    borders = found["pairs"].groupBy(*keys).agg(F.array_sort(F.collect_list(side)).alias("outer_frame"))
    parts = found["dividers"].groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("intercept", "slope", "coverage"))).alias("column_dividers"))
    col = F.struct(F.col("idx").alias("index"), "left_x", "right_x", "width")
    cols = found["columns"].groupBy(*keys).agg(F.array_sort(F.collect_list(col)).alias("columns"))
    stats = column_stats(found["columns"], keys)
    both = found["frame"].join(borders, list(keys), "left").join(parts, list(keys), "left").join(cols, list(keys), "left").join(stats, list(keys), "left")
    doc = F.struct(
        F.struct(F.col("page_width").alias("width"), F.col("page_height").alias("height")).alias("image_size"),
        F.struct("outer_frame", F.struct("top", "bottom", "left", "right").alias("inner_frame"), F.coalesce("num_columns", F.lit(0)).alias("num_columns"), "column_dividers").alias("borders"),
        F.struct("columns", F.struct("mean", "std", "cv").alias("column_width_stats"), "is_uniform").alias("columns"),
    )
    return both.select(*keys, F.to_json(doc).alias("layout"))
