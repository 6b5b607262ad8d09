"""Kernels over ordered rows: runs, merged intervals, peaks, groups at gaps.

Each takes the key columns that make rows independent (they are the only shuffle) and an
ordering column; ties need an ordinal of the caller's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keys = Sequence[str]


def place(df: DataFrame, keys: Keys, order: Sequence[str], name: str = "pos") -> DataFrame:
    """``name``: the rows of a key counted from 0."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def runs(df: DataFrame, keys: Keys, pos: str, flag: Column) -> DataFrame:
    """Maximal runs of consecutive places with a true flag: ``run_start, run_end`` (exclusive)
    and ``run_length``."""
    kept = df.select(*keys, pos, F.coalesce(flag, F.lit(False)).alias("_on")).where("_on")
    island = F.col(pos) - F.row_number().over(Window.partitionBy(*keys).orderBy(pos))
    grouped = kept.withColumn("_island", island).groupBy(*keys, "_island")
    out = grouped.agg(F.min(pos).alias("run_start"), (F.max(pos) + 1).alias("run_end"))
    return out.drop("_island").withColumn("run_length", F.col("run_end") - F.col("run_start"))


def longest_run(df: DataFrame, keys: Keys, pos: str, flag: Column) -> DataFrame:
    """The longest run of each key, the earliest on ties."""
    best = F.max_by(F.struct("run_start", "run_length"), F.struct("run_length", -F.col("run_start")))
    return runs(df, keys, pos, flag).groupBy(*keys).agg(best.alias("b")).select(*keys, "b.run_start", "b.run_length")


def merge_intervals(df: DataFrame, keys: Keys, start: str, end: str, gap: float) -> DataFrame:
    """Intervals joined while the next starts within ``gap`` of the furthest end so far:
    ``m_start, m_end, parts``."""
    order = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = df.withColumn("_new", (reach.isNull() | (F.col(start) > reach + F.lit(gap))).cast("int"))
    numbered = opened.withColumn("_group", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_group").agg(F.min(start).alias("m_start"), F.max(end).alias("m_end"), F.count(F.lit(1)).alias("parts")).drop("_group")


def gap_groups(df: DataFrame, keys: Keys, order: Sequence[str], at: Column, limit: float, name: str = "grp") -> DataFrame:
    """``name``: number of the group, a new one where ``at`` grows by more than ``limit``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    jump = (at - F.lag(at).over(w) > limit).cast("int")
    return df.withColumn("_jump", F.coalesce(jump, F.lit(0))).withColumn(name, F.sum("_jump").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_jump")


def local_maxima(df: DataFrame, keys: Keys, pos: str, value: str, distance: int, least: Column) -> DataFrame:
    """Inner rows at or above ``least`` that are the largest of ``distance`` rows before and
    ``distance - 1`` after; plateaus keep all rows, the two ends of a key none."""
    w = Window.partitionBy(*keys).orderBy(pos)
    around = F.max(value).over(w.rowsBetween(-distance, distance - 1))
    inner = F.lag(pos).over(w).isNotNull() & F.lead(pos).over(w).isNotNull()
    marked = df.withColumn("_peak", inner & (F.col(value) >= least) & (F.col(value) == around))
    return marked.where("_peak").drop("_peak")


def _fold(df: DataFrame, keys: Keys, items: Column, zero: Column, step, out: str) -> DataFrame:
    """A fold over each key's rows in order; a key's rows come together as one array, so the
    callers reduce first (peaks, lines) to a few rows per key."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(items)).alias("_items")).select(*keys, F.aggregate("_items", zero, step).alias(out))


def spaced(df: DataFrame, keys: Keys, pos: str, distance: int) -> DataFrame:
    """Places kept when at least ``distance`` after the last one kept."""
    zero = F.array().cast("array<int>")
    step = lambda kept, p: F.when((F.size(kept) == 0) | (p - F.element_at(kept, -1) >= distance), F.concat(kept, F.array(p))).otherwise(kept)
    return _fold(df, keys, F.col(pos).cast("int"), zero, step, "_kept").select(*keys, F.explode("_kept").alias(pos))


def stronger_replaces(df: DataFrame, keys: Keys, pos: str, strength: str, gap: int) -> DataFrame:
    """As :func:`spaced` with gap exclusive, but a stronger row within the gap takes the
    place of the last one kept."""
    zero = F.array().cast("array<struct<p:int,s:double>>")

    def step(kept: Column, x: Column) -> Column:
        last = F.element_at(kept, -1)
        far = (F.size(kept) == 0) | (x["p"] - last["p"] > gap)
        swapped = F.concat(F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))), F.array(x))
        return F.when(far, F.concat(kept, F.array(x))).when(x["s"] > last["s"], swapped).otherwise(kept)

    item = F.struct(F.col(pos).cast("int").alias("p"), F.col(strength).cast("double").alias("s"))
    return _fold(df, keys, item, zero, step, "_kept").select(*keys, F.explode("_kept").alias("_x")).select(*keys, F.col("_x.p").alias(pos), F.col("_x.s").alias(strength))


def spacings(df: DataFrame, keys: Keys, pos: str) -> DataFrame:
    """Neighbouring places as ``left_x, right_x, width``."""
    nxt = F.lead(pos).over(Window.partitionBy(*keys).orderBy(pos))
    return df.select(*keys, F.col(pos).alias("left_x"), nxt.alias("right_x")).where("right_x is not null").withColumn("width", F.col("right_x") - F.col("left_x"))


def moving_average(df: DataFrame, keys: Keys, pos: str, value: str, width: int, name: str) -> DataFrame:
    """Mean of ``width`` (odd) rows around, with zeros beyond the ends."""
    half = width // 2
    w = Window.partitionBy(*keys).orderBy(pos).rowsBetween(-half, half)
    return df.withColumn(name, F.sum(value).over(w) / F.lit(float(width)))


def first_failure(df: DataFrame, keys: Keys, pos: str, holds: Column, limit: int) -> DataFrame:
    """``depth``: how many leading rows hold, ``limit`` at most."""
    return df.where(F.col(pos) < limit).groupBy(*keys).agg(F.coalesce(F.min(F.when(~holds, F.col(pos))), F.least(F.lit(limit), F.max(pos) + 1)).alias("depth"))


def window_mark(df: DataFrame, keys: Keys, pos: str, flag: Column, size: int) -> DataFrame:
    """``marked``: the row is in some window of ``size`` rows (fewer for a shorter key) whose
    rows pass ``flag`` of the window's aggregates."""
    w = Window.partitionBy(*keys).orderBy(pos)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    k = F.least(F.lit(size), n)
    starts = df.withColumn("_k", k).withColumn("_ok", flag & (F.col(pos) <= n - k)).withColumn("_ok", F.coalesce("_ok", F.lit(False)))
    return starts.withColumn("marked", F.max(F.col("_ok").cast("int")).over(w.rowsBetween(-(size - 1), 0)) == 1).drop("_k", "_ok")


def resolve_overlaps(df: DataFrame, keys: Keys, pos: str, top: str, bottom: str, movable: Column) -> DataFrame:
    """Neighbours that overlap: a movable row gives way to a fixed one, and of two movable
    ones the later does; two fixed ones stay.  Rows then have no negative height.  Each
    boundary is touched once, so neighbours suffice."""
    w = Window.partitionBy(*keys).orderBy(pos)
    moved = df.withColumn("_m", movable)
    after = F.lead(F.struct(F.col(top).alias("t"), F.col("_m").alias("m"))).over(w)
    before = F.lag(F.struct(F.col(bottom).alias("b"))).over(w)
    new_bottom = F.when(F.col("_m") & ~after["m"] & (after["t"] < F.col(bottom)), after["t"]).otherwise(F.col(bottom))
    new_top = F.when(F.col("_m") & (before["b"] > F.col(top)), before["b"]).otherwise(F.col(top))
    both = moved.withColumn("_b", new_bottom).withColumn("_t", new_top)
    return both.withColumn(bottom, F.greatest("_b", "_t")).withColumn(top, F.col("_t")).drop("_m", "_b", "_t")


def consecutive_slots(df: DataFrame, keys: Keys, ord_: str, at: Column, top: Column, height: Column, slots: Column, name: str = "slot") -> DataFrame:
    """``name``: the first row of a key takes the slot that its place ``at`` falls into, held
    back so that all fit, and the others the slots after it; rows beyond ``slots`` are cut."""
    kept = df.where(F.col(ord_) < slots)
    per = Window.partitionBy(*keys)
    n = F.count(F.lit(1)).over(per)
    first = F.min(F.when(F.col(ord_) == 0, ((at - top) / height).cast("long"))).over(per)
    start = F.greatest(F.lit(0), F.least(slots - n, first))
    return kept.withColumn(name, start + F.col(ord_))


def usual_spacing(peaks: DataFrame, sizes: DataFrame, keys: Keys, pos: str, size: str) -> DataFrame:
    """``spacing, lines``: the usual distance of a key's peaks (the fullest bin of distances, 3 %
    of ``size`` wide, then the median of all within 40 % of it), and how often it fits between
    the outermost peaks so spaced, where within 3 to 15."""
    w = spacings(peaks, keys, pos).join(sizes.select(*keys, F.greatest(F.col(size) * 0.03, F.lit(10.0)).alias("bin")), list(keys))
    most = F.max("width").over(Window.partitionBy(*keys))
    w = w.withColumn("bins", F.greatest(F.floor(most / F.col("bin")) + 1, F.lit(3))).withColumn("step", (most + F.col("bin")) / F.col("bins"))
    w = w.withColumn("k", F.least(F.floor(F.col("width") / F.col("step")), F.col("bins") - 1))
    n = w.groupBy(*keys, "k").agg(F.count(F.lit(1)).alias("n"))
    fullest = n.groupBy(*keys).agg(F.max_by("k", F.struct("n", -F.col("k"))).alias("fullest"))
    w = w.join(fullest, list(keys)).withColumn("center", (F.col("fullest") + 0.5) * F.col("step"))
    like = w.where(F.col("width").between(F.col("center") * 0.6, F.col("center") * 1.4))
    est = like.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.median("width").alias("spacing"), (F.max("right_x") - F.min("left_x")).alias("content"))
    lines = F.bround(F.col("content") / F.col("spacing")).cast("int")
    return est.select(*keys, "spacing", F.when((F.col("n") >= 2) & lines.between(3, 15), lines).alias("lines"))


def valley_cuts(v: DataFrame, keys: Keys, pos: str, value: str, height: float | Column, least: int = 10) -> DataFrame:
    """Where a stretch of rows (``keys, pos, value``, from 0) that holds several characters of
    ``height`` is cut: ``keys, cut_start, cut_end``.

    Cuts are at clear valleys (least of 15 % of a character on each side, below 0.35 of the
    mean) half a character apart; without one, even.  Pieces below ``least`` join the one
    before; a stretch of up to 1.2 characters stays whole.  A stretch, some thousand rows at
    most, is one array.
    """
    h = (height if isinstance(height, Column) else F.lit(float(height))).cast("double")
    item = F.struct(F.col(pos).alias("p"), F.col(value).cast("double").alias("v"))
    held = v.groupBy(*keys).agg(F.first(h).alias("h"), F.sort_array(F.collect_list(item)).alias("a"))
    held = held.withColumn("a", F.transform("a", lambda x: x["v"])).withColumn("n", F.size("a"))
    held = held.withColumn("half", F.greatest(F.lit(3), (F.col("h") * 0.15).cast("int"))).withColumn("apart", (F.col("h") * 0.5).cast("int"))
    low = F.aggregate("a", F.lit(0.0), lambda acc, x: acc + x) / F.col("n") * 0.35
    held = held.withColumn("low", low)
    inner = F.when(F.col("n") > 2 * F.col("half"), F.sequence(F.col("half"), F.col("n") - F.col("half") - 1)).otherwise(F.array().cast("array<int>"))
    here = lambda y: F.get("a", y)
    valley = F.filter(inner, lambda y: (here(y) < F.col("low")) & (here(y) == F.array_min(F.slice("a", y - F.col("half") + 1, 2 * F.col("half") + 1))))
    held = held.withColumn("at", valley)
    none = F.array().cast("array<int>")
    kept = F.aggregate("at", none, lambda acc, p: F.when((F.size(acc) == 0) | (p - F.element_at(acc, -1) >= F.col("apart")), F.concat(acc, F.array(p))).otherwise(acc))
    many = F.greatest(F.lit(2), F.bround(F.col("n") / F.col("h")).cast("int"))
    even = F.transform(F.sequence(F.lit(1), many - 1), lambda i: F.floor(i * F.col("n") / many).cast("int"))
    held = held.withColumn("at", F.when(F.col("n") / F.col("h") <= 1.2, none).otherwise(F.when(F.size(kept) > 0, kept).otherwise(even)))

    def join_small(acc: Column, c: Column) -> Column:
        moved = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(c))
        return F.when(c - F.element_at(acc, -1) >= least, F.concat(acc, F.array(c))).when(F.size(acc) > 1, moved).otherwise(acc)

    cuts = F.aggregate(F.concat("at", F.array("n")), F.array(F.lit(0)), join_small)
    held = held.withColumn("cuts", cuts).withColumn("cuts", F.when(F.element_at("cuts", -1) == F.col("n"), F.col("cuts")).otherwise(F.concat("cuts", F.array("n"))))
    pieces = F.transform(F.sequence(F.lit(1), F.size("cuts") - 1), lambda i: F.struct(F.get("cuts", i - 1).alias("s"), F.get("cuts", i).alias("e")))
    whole = F.array(F.struct(F.lit(0).alias("s"), F.col("n").alias("e")))
    long = F.filter(pieces, lambda x: x["e"] - x["s"] >= least)
    out = held.select(*keys, F.explode(F.when(F.size(long) > 0, long).otherwise(whole)).alias("x"))
    return out.select(*keys, F.col("x.s").alias("cut_start"), F.col("x.e").alias("cut_end"))


def split_largest(regions: Column, wanted: Column, height: Column) -> Column:
    """An array of ``struct<s, e>`` cut evenly, the largest (first on ties) at a time and into
    as many characters of ``height`` as it holds, until there are ``wanted`` or the largest
    is no longer than 1.2 characters."""
    zero = F.struct(regions.alias("r"), F.lit(False).alias("done"))

    def step(acc: Column, _: Column) -> Column:
        r = acc["r"]
        sizes = F.transform(r, lambda x: x["e"] - x["s"])
        top = F.array_max(sizes)
        k = F.array_position(sizes, top).cast("int")
        missing = wanted - F.size(r)
        n = F.least(missing + 1, F.greatest(F.lit(2), F.bround(top / height).cast("int"))).cast("int")
        stop = acc["done"] | (missing <= 0) | (n <= 1) | (top < height * 1.2)
        own = F.get(r, k - 1)
        cut = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.struct((own["s"] + i * top / n).alias("s"), (own["s"] + (i + 1) * top / n).alias("e")))
        grown = F.concat(F.slice(r, 1, k - 1), cut, F.slice(r, k + 1, F.size(r)))
        return F.struct(F.when(stop, r).otherwise(grown).alias("r"), stop.alias("done"))

    rounds = F.when((F.size(regions) > 0) & (wanted > F.size(regions)), F.sequence(F.lit(1), wanted - F.size(regions))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(rounds, zero, step, lambda acc: acc["r"])
