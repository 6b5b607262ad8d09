import math
import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
import regex
import xxhash
from leafgrid.llm import importance, quality_rules
from pyspark.sql import functions as F

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    t = text or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    hit = [False] * len(w)
    for k in range(len(w) - 7):
        if windows[tuple(w[k : k + 8])] > 1:
            hit[k : k + 8] = [True] * 8
    n, r = len(w), sum(hit)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, r, n < 20 or 100 * r > 30 * n


@pytest.fixture(scope="module")
def labelled(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(3)
    rows, labels, known = [], [], prose(rng, 150).split()
    for k in range(120):
        good = k % 4 > 0
        text = " ".join(rng.choices(known, k=rng.randint(40, 120)))
        if not good:
            text = "### ".join(text.split()) if k % 8 else " | ".join(text.upper().split())
        rows.append((k, text, "en", "a"))
        if k % 3:
            labels.append((k, int(good), 0))
    return rows, labels


def test_counts_match_brute_force(documents, hard_rows, labelled):
    rng = random.Random(8)
    line = prose(rng, 9)
    rows = hard_rows + [
        (400, "\n".join([line, line, " ", " ", "x", line]), "en", "a"), (401, " ".join([line] * 5), "en", "a"), (402, "a " * 30, "en", "a"),
        (403, prose(rng, 40) + " " + line + " " + prose(rng, 40) + " " + line + " # * $", "en", "a"), (404, "one two three four five six seven eight", "en", "a"),
    ]
    got = quality_rules.rules(documents(rows), labelled([(1, 1, 0), (2, 1, 0), (None, 1, 1), (1, 1, 0)])).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((str(r["doc_id"]), *(r[n] for n in names)) for r in got) == sorted((str(d), *counts(t)) for d, t, _, _ in rows)
    assert all(not (r["kept"] and r["base_failed"]) for r in got)


def test_rules_keep_clean_and_drop_junk(documents, mixed, labelled):
    rows, labels = mixed
    kept = {r["doc_id"] for r in quality_rules.rules(documents(rows), labelled(labels)).where("kept").collect()}
    assert kept == {k for k in range(120) if k % 4}


def test_rules_without_labels(documents, labelled, mixed):
    got = quality_rules.rules(documents(mixed[0][:20]), labelled([]))
    assert got.where("log_ratio <> 0").count() == 0
    assert quality_rules.rules(documents([]), labelled([])).collect() == []


def test_resampling_keeps_clean_and_drops_junk(documents, mixed, labelled):
    rows, labels = mixed
    df = documents(rows + [(900, None, None, None), (901, "", "en", "a"), rows[1]])
    got = importance.resample(df, labelled(labels + [(None, 1, 0), (5000, 1, 0), (1, None, 0)]))
    ids = Counter(r["row"]["doc_id"] for r in got.collect())
    assert ids[1] == 2
    assert {k for k in ids if k < 900} >= {k for k in range(120) if k % 4} and not {k for k in ids if k < 120 and k % 4 == 0}
    again = Counter(r["row"]["doc_id"] for r in importance.resample(df.repartition(3), labelled(labels)).collect())
    assert {k for k in again if k < 900} == {k for k in ids if k < 900}


def test_resampling_without_labels_draws_all(documents, labelled):
    df = documents([(1, "a b c", "en", "a"), (2, "d", "en", "a")])
    assert importance.resample(df, labelled([])).count() == 2
    assert importance.resample(documents([]), labelled([(1, 1, 0)])).collect() == []


def test_scores_match_a_plain_count(documents, mixed, labelled):
    rows, labels = mixed
    sample = importance.labelled_sample(labelled(labels))
    raw, good = importance.counts(documents(rows), sample)
    trusted = {r["id"] for r in sample.where("fit and good > 0").collect()}
    assert 0 < len(trusted) < sum(q for _, q, _ in labels)
    tokens = [importance.TOKEN.findall(t) for _, t, _, _ in rows]
    n = sum(map(len, tokens))
    assert raw[: importance.BUCKETS].sum() == n and raw[importance.BUCKETS :].sum() == n - len(rows)
    assert good[: importance.BUCKETS].sum() == sum(len(t) for t, r in zip(tokens, rows) if r[0] in trusted)


def spark_hash(seed, *parts):
    """The engine's xxhash64 of ints, longs and strings; nulls pass."""
    h = 42
    for kind, x in (("i", seed), *parts):
        if x is not None:
            raw = x.encode() if kind == "s" else struct.pack("<i" if kind == "i" else "<q", x)
            h = xxhash.xxh64_intdigest(raw, h)
    return h


@pytest.mark.parametrize("seed", [11, 99])
def test_draw_matches_brute_force(documents, mixed, labelled, seed):
    rows, labels = mixed
    rows = rows + [(900, None, None, None), (901, "", "en", "a"), (None, "no id", "en", "a"), rows[1]]
    got = importance.resample(documents(rows), labelled(labels), seed=seed, draws=4.0, columns=["doc_id"]).collect()

    sample = {r["id"]: (r["good"], r["fit"]) for r in importance.labelled_sample(labelled(labels)).collect()}
    raw, good = [Counter(), Counter()], [Counter(), Counter()]

    def grams(t):
        h = [xxhash.xxh64_intdigest(x) for x in importance.TOKEN.findall(t or "")]
        m = (1 << 64) - 1
        pair = [(a * 0x9E3779B97F4A7C15 & m) ^ (b * 0xC2B2AE3D27D4EB4F & m) for a, b in zip(h, h[1:])]
        return [x >> 7 & importance.BUCKETS - 1 for x in h], [x >> 23 & importance.BUCKETS - 1 for x in pair]

    for d, t, *_ in rows:
        for k, g in enumerate(grams(t)):
            raw[k].update(g)
            if sample.get(d) == (1, True):
                good[k].update(g)

    def ratio(t):
        total, n = 0.0, 0
        for k, g in enumerate(grams(t)):
            for b in g:
                p = (raw[k][b] + 0.5) / (raw[k].total() + 0.5 * importance.BUCKETS)
                q = (good[k][b] + importance.PRIOR * p) / (good[k].total() + importance.PRIOR)
                total, n = total + math.log(q / p), n + 1
        return total / (n + importance.SHRINK)

    ratios = [ratio(t) for _, t, *_ in rows]
    held = {d: r for (d, *_), r in zip(rows, ratios) if d in sample and not sample[d][1]}
    cut = importance.learned_cut(np.array(list(held.values())), np.array([sample[d][0] > 0 for d in held]))
    keys = []
    for (d, t, *_), r in zip(rows, ratios):
        u = ((spark_hash(seed, ("l", d), ("s", t)) >> 11) + 0.5) / (1 << 53)
        keys.append(4.0 * r - math.log(-math.log(u)))
    k = sum(r >= cut for r in ratios)
    least = sorted(keys, reverse=True)[k - 1]
    want = sorted((str(d), round(4.0 * r, 6), round(x, 6)) for (d, *_), r, x in zip(rows, ratios, keys) if x >= least)
    assert sorted((str(r["row"]["doc_id"]), round(r["log_weight"], 6), round(r["key"], 6)) for r in got) == want
    assert list(got[0]["row"].asDict()) == ["doc_id"]


def test_draws_follow_the_weights_over_seeds(spark):
    """The first of the keys is document i in proportion to its weight; another seed draws anew."""
    n, seeds = 6, 1500
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(n)], "doc_id long, text string")
    u = np.array([r[0] for r in docs.orderBy("doc_id").select(F.array(*[importance.uniform(s) for s in range(seeds)])).collect()])
    weight = np.array([0.0, 0.5, 1.0, -1.0, 2.0, 0.2])
    key = weight[:, None] - np.log(-np.log(u))
    first = np.bincount(key.argmax(axis=0), minlength=n) / seeds
    want = np.exp(weight) / np.exp(weight).sum()
    assert np.abs(first - want).max() < 4 * np.sqrt(want.max() / seeds)


def test_seeds_draw_different_documents(documents, labelled):
    rng = random.Random(7)
    clean, junk = prose(rng, 60).split(), prose(rng, 60, "qwxyzkj").split()
    rows = [(k, " ".join(rng.choice(junk if rng.random() < k % 10 / 9 else clean) for _ in range(40)), "en", "a") for k in range(200)]
    labels = labelled([(k, int(k % 10 < 5), 0) for k in range(200) if k % 3])
    sets = [{r["row"]["doc_id"] for r in importance.resample(documents(rows), labels, seed=s, columns=["doc_id"]).collect()} for s in (11, 99)]
    assert sets[0] != sets[1] and len(sets[0]) == len(sets[1]) and len(sets[0] & sets[1]) > 0.6 * len(sets[0])


def test_log_ratio_and_kept_match_brute_force(documents, mixed, labelled):
    rows, labels = mixed
    rows = rows + [(900, None, None, None), (901, "", "en", "a"), (902, "ünï 12 --- " * 9, "en", "a"), (903, "one", "en", "a")]
    got = {r["doc_id"]: r for r in quality_rules.rules(documents(rows), labelled(labels)).collect()}
    token = regex.compile(rf"[\p{{L}}\p{{M}}]+|\p{{N}}+|[^\p{{L}}\p{{M}}\p{{N}}\x20\x09-\x0D]+")

    def grams(t):
        h = [xxhash.xxh64_intdigest(x, 42) for x in token.findall(t or "")]
        pair = [xxhash.xxh64_intdigest(struct.pack("<Q", b), xxhash.xxh64_intdigest(struct.pack("<Q", a), 42)) for a, b in zip(h, h[1:])]
        return [[x & quality_rules.BUCKETS - 1 for x in y] for y in (h, pair)]

    trusted = {d for d, q, _ in labels if q}
    raw, good = [Counter(), Counter()], [Counter(), Counter()]
    for d, t, *_ in rows:
        for k, g in enumerate(grams(t)):
            raw[k].update(g)
            if d in trusted:
                good[k].update(g)
    for d, t, *_ in rows:
        total, n = 0.0, 0
        for k, g in enumerate(grams(t)):
            for b in g:
                p = (raw[k][b] + 0.5) / (raw[k].total() + 0.5 * quality_rules.BUCKETS)
                total += math.log((good[k][b] + quality_rules.PRIOR * p) / (good[k].total() + quality_rules.PRIOR) / p)
                n += 1
        want = total / (n + quality_rules.SHRINK)
        assert abs(got[d]["log_ratio"] - want) < 1e-5
        assert got[d]["kept"] == (not counts(t)[-1] and want >= quality_rules.THRESHOLD)


@pytest.mark.parametrize("k", [1, 2, 57, 199, 200])
def test_kth_largest(spark, k):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=120), np.full(40, 0.25), rng.normal(size=40) * 1e-9])
    df = spark.createDataFrame([(float(v),) for v in x], "key double")
    assert importance.largest(df, k, bins=4) == sorted(x, reverse=True)[k - 1]
