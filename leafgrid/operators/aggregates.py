"""Votes, spreads, histograms and weighted lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mode_first(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """The most frequent value of each key, the one seen first on ties: ``mode, votes, share``."""
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    best = F.min_by(F.struct(F.col(value).alias("mode"), F.col("n").alias("votes")), F.struct(-F.col("n"), F.col("first")))
    out = counted.groupBy(*keys).agg(best.alias("b"), F.sum("n").alias("all"))
    return out.select(*keys, "b.mode", "b.votes", (F.col("b.votes") / F.col("all")).alias("share"))


def variation(value: Column) -> Column:
    """Population standard deviation over the mean; null for a mean of 0."""
    return F.try_divide(F.stddev_pop(value), F.avg(value))


def fixed_bins(value: Column, low: float, high: float, bins: int) -> Column:
    """Bin from 0 of a closed range, the last bin closed too; null outside."""
    at = F.floor((value - low) / ((high - low) / bins))
    return F.when((value >= low) & (value <= high), F.least(at, F.lit(bins - 1)))


def histogram_peak(df: DataFrame, keys: Sequence[str], bin_column: str) -> DataFrame:
    """The fullest bin of each key, the lowest on ties: ``bin, votes``."""
    n = df.where(F.col(bin_column).isNotNull()).groupBy(*keys, bin_column).agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by(F.struct(F.col(bin_column).alias("bin"), F.col("n").alias("votes")), F.struct("n", -F.col(bin_column)))
    return n.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.bin", "b.votes")


def weighted_line(df: DataFrame, keys: Sequence[str], x: Column, y: Column, w: Column) -> DataFrame:
    """``slope, intercept`` of the least squares line whose residuals are weighted by ``w``,
    so squares by its square; flat at the plain mean with fewer than two points or a range
    of x below 5.  All of it is sums, which combine before the shuffle."""
    rows = df.select(*keys, x.cast("double").alias("x"), y.cast("double").alias("y"), (w * w).cast("double").alias("c"))
    s = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), (F.max("x") - F.min("x")).alias("range"), F.avg("y").alias("mean"),
        F.sum("c").alias("s0"), F.sum(F.expr("c*x")).alias("s1"), F.sum(F.expr("c*x*x")).alias("s2"), F.sum(F.expr("c*y")).alias("t0"), F.sum(F.expr("c*x*y")).alias("t1"),
    )
    # about the weighted mean, which keeps the differences well conditioned
    slope = F.expr("(t1 - s1*t0/s0) / nullif(s2 - s1*s1/s0, 0)")
    flat = (F.col("n") < 2) | (F.col("range") < 5) | slope.isNull()
    line = s.withColumn("slope", F.when(flat, F.lit(0.0)).otherwise(slope))
    at = F.when(flat, F.col("mean")).otherwise(F.expr("(t0 - slope*s1) / s0"))
    return line.select(*keys, "slope", at.alias("intercept"))


def scale_bin(value: Column, fine: int = 256) -> Column:
    """A bin that grows with the value, ``fine`` of them from one power of two to the next."""
    return (F.signum(value) * F.floor(F.log2(F.abs(value) + 1) * fine)).cast("long")


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """``keys, p0, p1, ...``: interpolated percentiles of few keys with many rows each.

    A first pass counts growing bins (a few thousand rows a key, combined before the
    shuffle) and finds those that hold the wanted ranks; only their rows, counted by value,
    are then put in order.  Nulls are left out.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("v")).withColumn("bin", scale_bin(F.col("v")))
    counted = rows.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    up_to = Window.partitionBy(*keys).orderBy("bin")
    counted = counted.withColumn("end", F.sum("n").over(up_to.rowsBetween(Window.unboundedPreceding, 0))).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    ranks = F.array(*[F.struct(F.lit(k).alias("k"), (F.lit(float(p)) * (F.col("all") - 1)).alias("at")) for k, p in enumerate(shares)])
    asked = counted.withColumn("r", F.explode(ranks)).withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("r.at"), F.ceil("r.at")))))
    asked = asked.where((F.col("rank") >= F.col("end") - F.col("n")) & (F.col("rank") < F.col("end"))).select(*keys, "bin", "rank", F.col("r.k").alias("k"), F.col("r.at").alias("at"), (F.col("end") - F.col("n")).alias("before"))
    some = rows.join(asked.select(*keys, "bin").distinct(), [*keys, "bin"], "left_semi").groupBy(*keys, "bin", "v").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy(*keys, "bin").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    placed = some.withColumn("upto", F.sum("n").over(inside))
    hit = placed.join(asked, [*keys, "bin"]).where((F.col("rank") - F.col("before") >= F.col("upto") - F.col("n")) & (F.col("rank") - F.col("before") < F.col("upto")))
    low, high = F.min_by("v", "rank"), F.max_by("v", "rank")
    part = F.first("at") - F.floor(F.first("at"))
    each = hit.groupBy(*keys, "k").agg((low + (high - low) * part).alias("p"))
    return each.groupBy(*keys).agg(*[F.max(F.when(F.col("k") == k, F.col("p"))).alias(f"p{k}") for k in range(len(shares))])
