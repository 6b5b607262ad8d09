"""Kernels against plain loops on random rows."""

import random

import pytest
from leafgrid.functions import scalars as fn
from leafgrid.operators import aggregates as ag
from leafgrid.operators import joins as jn
from leafgrid.operators import sequence as sq
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def signal():
    rng = random.Random(1)
    return {k: [rng.randint(0, 9) for _ in range(rng.randint(3, 60))] for k in range(12)}


@pytest.fixture(scope="module")
def frame(spark, signal):
    return spark.createDataFrame([(k, i, v) for k, s in signal.items() for i, v in enumerate(s)], "k int, pos int, v int").cache()


def by_key(rows, *cols):
    out = {}
    for r in sorted(tuple(r[c] for c in ("k", *cols)) for r in rows):
        out.setdefault(r[0], []).append(r[1:] if len(cols) > 1 else r[1])
    return out


def test_runs(frame, signal):
    want = {}
    for k, s in signal.items():
        i = 0
        while i < len(s):
            if s[i] > 4:
                j = i
                while j < len(s) and s[j] > 4:
                    j += 1
                want.setdefault(k, []).append((i, j))
                i = j
            i += 1
    assert by_key(sq.runs(frame, ["k"], "pos", F.col("v") > 4).collect(), "run_start", "run_end") == want
    best = {k: [max(((b - a, -a) for a, b in r))] for k, r in want.items()}
    got = sq.longest_run(frame, ["k"], "pos", F.col("v") > 4).collect()
    assert {r["k"]: [(r["run_length"], -r["run_start"])] for r in got} == best


@pytest.mark.parametrize("d", [2, 5])
def test_peaks(frame, signal, d):
    found, kept = {}, {}
    for k, s in signal.items():
        for i in range(1, len(s) - 1):
            if s[i] >= 3 and s[i] == max(s[max(0, i - d) : i + d]):
                found.setdefault(k, []).append(i)
        for p in found.get(k, []):
            if not kept.get(k) or p - kept[k][-1] >= d:
                kept.setdefault(k, []).append(p)
    peaks = sq.local_maxima(frame, ["k"], "pos", "v", d, F.lit(3))
    assert by_key(peaks.collect(), "pos") == found
    assert by_key(sq.spaced(peaks, ["k"], "pos", d).collect(), "pos") == kept


def test_stronger_replaces(frame, signal):
    want = {}
    for k, s in signal.items():
        out = []
        for i, v in enumerate(s):
            if v < 3:
                continue
            if not out or i - out[-1][0] > 4:
                out.append((i, float(v)))
            elif v > out[-1][1]:
                out[-1] = (i, float(v))
        if out:
            want[k] = out
    assert by_key(sq.stronger_replaces(frame.where("v >= 3"), ["k"], "pos", "v", 4).collect(), "pos", "v") == want


def test_merge_intervals(spark):
    rng = random.Random(2)
    rows = [(k, s, s + rng.randint(0, 30)) for k in range(5) for s in rng.sample(range(400), 25)]
    want = {}
    for k in range(5):
        merged = []
        for s, e in sorted((s, e) for q, s, e in rows if q == k):
            if merged and s <= merged[-1][1] + 6:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        want[k] = [tuple(m) for m in merged]
    df = spark.createDataFrame(rows, "k int, s int, e int")
    got = by_key(sq.merge_intervals(df, ["k"], "s", "e", 6).collect(), "m_start", "m_end")
    assert got == want
    assert all(b[0] - a[1] > 6 for v in got.values() for a, b in zip(v, v[1:]))


def test_weighted_line_is_a_residual_weighted_fit(spark):
    np = pytest.importorskip("numpy")
    rng = np.random.default_rng(4)
    rows = [(k, float(x), float(3 * x - k + rng.normal()), float(rng.uniform(0.5, 4))) for k in range(4) for x in rng.uniform(0, 200, 9)]
    rows += [(9, 1.0, 5.0, 2.0), (8, 1.0, 4.0, 1.0), (8, 3.0, 6.0, 9.0)]
    got = {r["k"]: (r["slope"], r["intercept"]) for r in ag.weighted_line(spark.createDataFrame(rows, "k int, x double, y double, w double"), ["k"], F.col("x"), F.col("y"), F.col("w")).collect()}
    for k in range(4):
        own = [r[1:] for r in rows if r[0] == k]
        x, y, w = map(np.array, zip(*own))
        assert got[k] == pytest.approx(tuple(np.polyfit(x, y, 1, w=w)))
    assert got[9] == (0.0, 5.0) and got[8] == (0.0, 5.0)


def test_mode_takes_the_first_seen(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([2, 1, 2, 1])], "k int, o int, v int")
    assert tuple(ag.mode_first(df, ["k"], "v", "o").first()) == (1, 2, 2, 0.5)


def test_containment(spark):
    rng = random.Random(6)
    regions = [(k, i, float(rng.randint(0, 200))) for k in range(3) for i in range(20)]
    boxes = [(k, i, float(c - rng.randint(1, 15)), float(c + rng.randint(1, 15)), float(c)) for k in range(3) for i, c in enumerate(rng.sample(range(200), 6))]
    want = {}
    for k in range(3):
        own = [b for b in boxes if b[0] == k]
        heights = sorted(b[3] - b[2] for b in own)
        reach = 1.5 * (heights[2] + heights[3]) / 2
        for _, i, c in (r for r in regions if r[0] == k):
            hits = [b for b in own if b[2] <= c <= b[3]]
            pool = hits or [b for b in own if abs(b[4] - c) <= reach]
            if pool:
                want[k, i] = min(pool, key=lambda b: (abs(b[4] - c), b[1]))[1]
    got = jn.containment_or_nearest(spark.createDataFrame(regions, "k int, region_id int, c double"), spark.createDataFrame(boxes, "k int, box_id int, lo double, hi double, c_box double"), ["k"])
    assert {(r["k"], r["region_id"]): r["box_id"] for r in got.collect()} == want


@pytest.mark.parametrize("tile", [1, 3, 2048])
def test_all_pairs(spark, tile):
    rng = random.Random(4)
    side = lambda n: [(rng.choice([None, 0, 0, 0, 1, 2, rng.randint(3, 9)]), rng.choice([None, rng.randint(0, 20)])) for _ in range(n)]
    left, right = side(40), side(70)
    got = jn.all_pairs(spark.createDataFrame(left, "k int, a int"), spark.createDataFrame(right, "k int, b int"), ["k"], tile)
    assert got.columns == ["k", "a", "b"]
    key = lambda r: tuple((v is None, v or 0) for v in r)
    want = [(k, a, b) for k, a in left for q, b in right if k is not None and k == q]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    none = spark.createDataFrame([], "k int, b int")
    assert jn.all_pairs(got.select("k", "a"), none, ["k"], tile).count() == 0


def test_scalars(spark):
    row = spark.sql("select 'book/vol_3_page12.PNG' as p, '3-5,9' as r, '营x青' as c").select(
        fn.last_number(fn.clean_stem(F.col("p"))).alias("n"), fn.expand_ranges(F.col("r")).alias("r"), fn.correct_characters(F.col("c")).alias("c")
    ).first()
    assert (row["n"], row["r"], row["c"]) == (12, [3, 4, 5, 9], "宫x七")


def test_empty(spark):
    df = spark.createDataFrame([], "k int, pos int, v int")
    assert sq.runs(df, ["k"], "pos", F.col("v") > 1).count() == 0
    assert sq.spaced(df, ["k"], "pos", 3).count() == 0
    assert ag.mode_first(df, ["k"], "v", "pos").count() == 0
