import re
from collections import Counter, defaultdict

import pytest
from leafgrid.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, live, target = share * sum(sizes.values()), set(order), {}
    while live:
        unit = left / sum(weight[s] for s in live)
        over = {s for s in live if unit * weight[s] > cap * sizes[s]}
        if not over:
            return target | {s: unit * weight[s] for s in live}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        live -= over
    return target


def expect(rows):
    size = [len(WORD.findall(t or "")) for _, t, _, _ in rows]
    per = defaultdict(int)
    for n, r in zip(size, rows):
        per[r[3]] += n
    return size, per, water_fill(per)


def test_targets_and_budgets(documents, hard_rows):
    got = mixing.mix(documents(hard_rows), keep=["source"]).collect()
    size, per, target = expect(hard_rows)
    assert Counter((r["doc_id"], r["size"], r["row"]["source"]) for r in got) == Counter((r[0], n, r[3]) for n, r in zip(size, hard_rows))
    taken = Counter()
    for r in got:
        s = r["row"]["source"]
        assert r["source_size"] == per[s] and r["target"] == pytest.approx(target[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s in per:
        assert abs(taken[s] - target[s]) <= 0.5


def test_reruns_agree_and_partitions_do_not_matter(documents, hard_rows):
    df = documents(hard_rows)
    a = mixing.mix(df).collect()
    b = mixing.mix(df.repartition(5)).collect()
    assert Counter(map(tuple, a)) == Counter(map(tuple, b))


def test_many_buckets_in_a_hot_source(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    monkeypatch.setattr(mixing, "BLOCK_BUCKETS", 4)
    rows = [(k, " ".join(["w"] * (k % 9)), "en", "hot" if k % 3 else f"s{k % 4}") for k in range(900)]
    got = mixing.mix(documents(rows), keep=["source"]).collect()
    _, per, target = expect(rows)
    taken = Counter()
    for r in got:
        taken[r["row"]["source"]] += r["taken"]
    assert len(got) == 900 and all(abs(taken[s] - target[s]) <= 0.5 for s in per)


def test_mixed_documents(documents, hard_rows):
    df = documents(hard_rows)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    got = out.collect()
    words = Counter()
    for r in got:
        words[r["source"]] += len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"])
    _, per, target = expect(hard_rows)
    assert all(abs(words[s] - target[s]) <= 0.5 for s in per)


def test_empty_table(documents):
    assert mixing.mix(documents([])).collect() == []
    assert mixing.mixed_documents(documents([])).collect() == []


def test_only_empty_texts(documents):
    got = mixing.mix(documents([(1, "", "en", "a"), (2, None, "en", None)])).collect()
    assert [(r["size"], r["taken"]) for r in got] == [(0, 0), (0, 0)]
