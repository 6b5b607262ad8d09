import random
import re

import numpy as np
import pytest
import xxhash
from leafgrid.llm import components, simhash


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes, linked):
    root = {a: a for a in nodes}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {a: find(a) for a in nodes}


def test_groups_match_brute_force(documents, hard_rows):
    got = simhash.groups(documents(hard_rows)).collect()
    fps = [brute_print(t) for _, t, _, _ in hard_rows]
    root = brute_components(set(fps), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (d, *_), f in zip(hard_rows, fps):
        least[root[f]] = min((x for x in (least.get(root[f]), d) if x is not None), default=None)
    want = sorted([(d, f"{f:016x}", least[root[f]]) for (d, *_), f in zip(hard_rows, fps)], key=str)
    assert sorted(map(tuple, got), key=str) == want


@pytest.mark.parametrize("seed", range(4))
def test_forest_finds_every_link(seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = list({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(40)})
    shard = np.array([rng.randint(0, 3) for _ in fps])
    forest = simhash.Forest(shard, np.array(fps, dtype=np.uint64))
    got = {(int(a), int(b)) for x, y in forest.links() for a, b in zip(x, y)}
    want = {(i, j) for i in range(len(fps)) for j in range(i) if shard[i] == shard[j] and (fps[i] ^ fps[j]).bit_count() <= 3}
    assert got == want


def test_shards_lose_no_link(spark):
    rng = random.Random(9)
    fps = set()
    for _ in range(60):
        f = rng.getrandbits(64)
        for _ in range(8):
            fps.add(f)
            f ^= sum(1 << k for k in rng.sample(range(64), rng.choice([2, 3, 3, 4])))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long").repartition(7)
    for blocks in (4, 5, 6):
        got = {r["node"] & (1 << 64) - 1: r["root"] & (1 << 64) - 1 for r in components.stars(simhash.shard_links(df, blocks)).collect()}
        root = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
        same = {}
        for f in fps:
            same.setdefault(root[f], set()).add(got.get(f, f))
        assert all(len(v) == 1 for v in same.values()) and len({min(v) for v in same.values()}) == len(same)


def test_components_of_a_long_path(spark):
    order = list(range(300))
    random.Random(3).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])) + [(5, 5), (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.stars(edges).collect()}
    assert got == {k: 0 for k in range(1, 300)}


def test_groups_cut_between_batches():
    import pyarrow as pa

    keys = sorted([1] * 5 + [2] * 400 + [3] * 7 + list(range(10, 300)))
    batches = [pa.RecordBatch.from_pydict({"shard": keys[k : k + 17]}) for k in range(0, len(keys), 17)]
    parts = [t.column(0).to_pylist() for t in simhash.whole_groups(iter(batches), rows=50)]
    assert sum(parts, []) == keys
    assert all(not set(a) & set(b) for i, a in enumerate(parts) for b in parts[:i])


def test_empty_table(documents):
    assert simhash.groups(documents([])).collect() == []


def shingle_set(text):
    w = re.findall(r"[^\W_]+", text.lower())
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b)


def changed_copies(seed, n):
    """(text, copy) with text appended, cut off or edited in a few places."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(3, 8)))
    for k in range(n):
        w = [word() for _ in range(rng.randint(150, 600))]
        kind, c = k % 3, list(w)
        if kind == 0:
            c += [word() for _ in range(len(w) * rng.randint(6, 16) // 100)]
        elif kind == 1:
            c = c[: len(w) * rng.randint(86, 94) // 100]
        else:
            for at in rng.sample(range(len(w)), len(w) * 15 // 1000):
                c[at] = word()
        yield " ".join(w), " ".join(c)


def test_near_copies_with_added_cut_and_edited_text(documents):
    pairs = list(changed_copies(8, 240))
    assert all(jaccard(a, b) >= 0.8 for a, b in pairs)
    rows = [(2 * k + j, t, "en", "a") for k, p in enumerate(pairs) for j, t in enumerate(p)]
    # texts that share a third of their shingles are not copies
    common = pairs[0][0]
    rows += [(1000 + k, f"{common} {' '.join(a.split()[: 2 * len(common.split())])}", "en", "a") for k, (a, _) in enumerate(pairs) if len(a.split()) >= 1.5 * len(common.split())][:20]
    kept = {r["doc_id"] for r in simhash.without_copies(documents(rows)).select("doc_id").collect()}
    assert kept >= {2 * k for k in range(len(pairs))}
    assert {r[0] for r in rows if r[0] >= 1000} <= kept
    missed = [k for k in range(len(pairs)) if 2 * k + 1 in kept]
    assert len(missed) <= 0.03 * len(pairs), [(k % 3, round(jaccard(*pairs[k]), 3)) for k in missed]


@pytest.mark.parametrize("patience", [0, 3, 1000])
@pytest.mark.parametrize("width", [1, 3])
def test_large_shards_link_as_all_pairs_do(width, patience):
    rng = np.random.default_rng(width)
    n, radius = 400, 4 * width
    prints = rng.integers(0, 1 << 63, (8, width), dtype=np.uint64)[rng.integers(0, 8, n)]
    for k in range(n):  # chains away from eight centres
        for _ in range(int(rng.integers(0, 12))):
            prints[k, rng.integers(width)] ^= np.uint64(1 << int(rng.integers(0, 24)))
    shard = np.sort(rng.integers(0, 3, n))
    refused = rng.integers(0, 50, n)
    close = lambda a, b: abs(refused[a] - refused[b]) <= 30
    flat = prints[:, 0] if width == 1 else prints
    far = np.bitwise_count(prints[:, None] ^ prints[None]).sum(axis=2)
    want = brute_components(range(n), lambda i, j: shard[i] == shard[j] and far[i, j] <= radius and bool(close(i, j)))
    assert 3 < len(set(want.values())) < n
    got = simhash.follow_sets(shard, flat, radius, close, patience)
    assert list(got) == [want[k] for k in range(n)]
    row, root = simhash.star_edges(shard, flat, radius, close)
    assert dict(zip(row.tolist(), root.tolist())) == {k: v for k, v in want.items() if k != v}


def family(rng, n):
    """Copies of a text with a few words changed, at several distances."""
    word = lambda: "".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(3, 8)))
    w = [word() for _ in range(rng.randint(120, 300))]
    for _ in range(n):
        c = list(w)
        for at in rng.sample(range(len(c)), int(len(c) * rng.choice([0, 0.004, 0.01, 0.03, 0.05]))):
            c[at] = word()
        yield " ".join(c)


def test_one_of_each_group_of_near_copies_stays(documents):
    rng = random.Random(21)
    texts = [t for _ in range(12) for t in family(rng, rng.choice([1, 2, 5, 12]))] + [t for t in family(rng, 90)]
    rng.shuffle(texts)
    rows = [(1000 - k, t, "en", "a") for k, t in enumerate(texts)]
    kept = {r["doc_id"] for r in simhash.without_copies(documents(rows)).select("doc_id").collect()}
    text = {d: t for d, t, *_ in rows}
    sure = brute_components(sorted(text), lambda a, b: jaccard(text[a], text[b]) >= 0.84)
    loose = brute_components(sorted(text), lambda a, b: jaccard(text[a], text[b]) >= 0.72)
    assert all(len(kept & {d for d in text if sure[d] == g}) <= 1 for g in set(sure.values()))
    assert {min(d for d in text if loose[d] == g) for g in set(loose.values())} <= kept
    assert len(set(loose.values())) <= len(kept) <= len(set(sure.values()))


def test_a_large_group_of_near_copies_leaves_its_smallest_id(documents):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(3, 8)))
    base = [word() for _ in range(200)]
    rows = []
    for k in range(1500):
        c = list(base)
        c[rng.randrange(200)] = word()
        rows.append((5 + k, " ".join(c), "en", "hot"))
    got = simhash.without_copies(documents(rows)).collect()
    assert [r["doc_id"] for r in got] == [5]


def test_rows_that_stay_are_whole_with_nulls_ties_and_repeats(spark):
    rows = [(1, "same words in both of these texts", "x"), (1, "same words in both of these texts", "x"), (2, "Same words, in both of these texts!", "y"), (None, "same words in both of these texts", "z"),
            (3, None, "x"), (4, "", "x"), (None, None, "x"), (5, "...", None), (None, "alone with no id", "a"), (6, "another text", "b"), (6, "two texts with one id", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, `odd.name` string")
    got = simhash.without_copies(df)
    assert got.columns == df.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [rows[0], rows[4], rows[8], rows[9], rows[10]]))
    assert simhash.without_copies(df.limit(0)).collect() == []
