"""Connected components of an edge table, by alternating large-star and small-star steps.

Both steps are joins and minimum aggregates on the edge's end; nothing is collected.
Each round is written to the shared folder, and the loop ends when a round leaves the
edges as they were (then every component is a star around its smallest node).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written

ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("hi", "lo")), F.lit(0))).first()
    return tuple(r)


def stars(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``node, root`` for every node of an edge that is not its component's smallest.

    ``edges`` has two columns of one ordered type; loops and null ends are ignored,
    repeated edges count once, no edges give no rows.
    """
    a, b = (F.col(c) for c in edges.columns[:2])
    now = written(edges.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges")
    state = _state(now)
    if state[0] == 0:
        return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    for _ in range(rounds):
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(now.select("lo", "hi"))
        # written, so that the join deals both sides anew and a hub's edges can be split
        step = written(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("u", "m").alias("m")), "least")
        large = both.join(step, both.u == step["at"]).where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("at"), "m")
        small = large.join(least, F.col("hi") == F.col("at")).where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        old, now = (now, step), written(small.unionAll(least.select("at", "m")).distinct(), "edges")
        for stale in old:
            discard(stale)
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    raise RuntimeError(f"components did not settle in {rounds} rounds")
