"""Toxicity and language: kernels against definitions, chains against enumeration, and
held-out accuracy."""

import itertools
import random
import zlib

import numpy as np
import pytest
from leafgrid.llm import language, toxicity

from .conftest import prose

INSULTS = ["grumbold", "snaffwit", "drokkel"]


def plain_kernel(a, b):
    total = 0.0
    for i in itertools.combinations(range(len(a)), toxicity.ORDER):
        for j in itertools.combinations(range(len(b)), toxicity.ORDER):
            if all(a[x] == b[y] for x, y in zip(i, j)):
                total += toxicity.DECAY ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
    return total


def test_kernel_is_the_subsequence_kernel():
    words = ["^abcab$", "^bca$", "^aaaa$", "^xyz$", "^abxcab$"]
    got = toxicity.kernel(words, words)
    want = np.array([[plain_kernel(a, b) for b in words] for a in words])
    assert np.allclose(got, want, rtol=1e-4) and np.allclose(toxicity.self_kernel(words), np.diag(want), rtol=1e-4)


def test_collapsed_weights_equal_landmarks():
    marks = ["^^abcab$", "^^bca$", "^^cabac$"]
    m = toxicity.Model(marks, np.sqrt(toxicity.self_kernel(marks)), np.array([0.7, -1.1, 0.3], np.float32), 0.2)
    words = ["^^abcab$", "^^abxcab$", "^^zzz$", "^^bcabca$"]
    want = toxicity.normalised(words, marks, m.norm) @ m.beta + m.bias
    assert np.allclose(m.values(words), want, atol=1e-5)


def test_units_fold_disguises():
    folded = {x for u in toxicity.units("i-d.i*o+t 1d1ot I D I O T ok") for x in toxicity.fold(u)}
    assert folded == {"^^idiot$", "^^dot$"}
    assert toxicity.fold("x" * 40) and toxicity.fold("12345678") == [] and toxicity.units(None) == []


@pytest.mark.parametrize(
    "text",
    ["1d10t", "i1d2i3o4t", "12:30:05,idiot", "a1,b2,c3,idiot", "i_d_i_o_t", "i d i o t", "look i _ d _ i _ o _ t here", "http://a.b/c?user=idiot&n=1234", '{"k":"idiot","n":10000}', "2024-01-01T10:00:00;1D10T"],
)
def test_insults_inside_digits_marks_and_runs(text):
    assert "^^idiot$" in {x for u in toxicity.units(text) for x in toxicity.fold(u)}


def test_insults_of_many_digits():
    assert "^^asshole$" in toxicity.fold("a55h0l3") and toxicity.fold("2024-01-01") == []


@pytest.fixture(scope="module")
def insulting():
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(400):
        words = prose(rng, rng.randint(25, 90)).split()
        bad = k % 5 == 0
        if bad:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((k, " ".join(words), "en", "a"))
        labels.append((k, 1, int(bad)))
    return rows, labels


def test_toxicity_held_out(spark, documents, insulting):
    rows, labels = insulting
    odd = [(900, None, "en", "a"), (901, "", "en", "a"), (None, "grumbold snaffwit", "en", "a"), (902, "12 34 ...", "en", "a"), rows[0]]
    odd += [(903, "you g-r-u-m-b-o-l-d and snaffwitt", "en", "a"), (904, "grum-bold drok.kel " + prose(random.Random(1), 20), "en", "a"), (905, "z" * 50_000, "en", "a")]
    df = spark.createDataFrame(labels + [(None, 1, 1), (0, 1, 1), (7777, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(documents(rows + odd), df).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in got}
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [(by[d]["predicted"], y) for d, _, y in labels if by[d]["held_out"]]
    assert np.mean([p == y for p, y in held]) >= 0.95
    assert by[900]["score"] == by[901]["score"] == by[902]["score"] < 0.05
    assert by[903]["predicted"] == by[904]["predicted"] == 1


def test_toxicity_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["predicted"] for r in toxicity.classify(documents([(1, "some text here", "en", "a")]), none).collect()] == [0]
    assert toxicity.classify(documents([]), none).collect() == []


def test_posteriors_match_enumeration(monkeypatch):
    monkeypatch.setattr(language, "BLOCK", 3)
    rng = np.random.default_rng(1)
    score, trans, start = rng.normal(size=(11, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    first = np.array([1, 0, 0, 0, 1, 1, 0, 0, 0, 0, 0], dtype=bool)
    got = language.posteriors(score, first, trans, start)
    begins = [*np.flatnonzero(first), 11]
    for a, b in zip(begins, begins[1:]):
        total = np.zeros((b - a, 3))
        for path in itertools.product(range(3), repeat=b - a):
            w = np.exp(start[path[0]] + sum(score[a + i, s] for i, s in enumerate(path)) + sum(trans[x, y] for x, y in zip(path, path[1:])))
            for i, s in enumerate(path):
                total[i, s] += w
        assert np.allclose(got[a:b], total / total.sum(axis=1, keepdims=True))


def test_language_held_out(documents):
    rng = random.Random(6)
    letters = {"aa": "abcdefg", "bb": "abchijk", "cc": "éèàmnop"}
    rows = [(k, prose(rng, rng.randint(3, 40), letters[g]), g, "a") for k in range(240) for g in [rng.choice(list(letters))]]
    odd = [(900, None, "aa", "a"), (901, "12 ² _ !", "aa", "a"), (902, prose(rng, 20, letters["cc"]), None, None), (None, prose(rng, 20, letters["bb"]), "bb", "a"), rows[0], (903, "m" * 60_000, "cc", "a")]
    got = language.identify(documents(rows + odd)).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in got}
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [(by[d]["lang_pred"], g) for d, _, g, _ in rows if by[d]["held_out"]]
    assert np.mean([p == g for p, g in held]) >= 0.97
    assert (by[900]["lang_pred"], by[901]["lang_pred"], by[902]["lang_pred"], by[None]["lang_pred"]) == ("und", "und", "cc", "bb")


def test_code_switched_words():
    rng = random.Random(3)
    texts = [prose(rng, 30, "abcdefg") for _ in range(40)] + [prose(rng, 30, "éèàmnop") for _ in range(40)]
    model = language.train(texts, ["aa"] * 40 + ["cc"] * 40)
    w = language.words(prose(rng, 10, "abcdefg") + " " + prose(rng, 10, "éèàmnop"))
    score = model.emissions(w)
    p = language.posteriors(score, np.arange(20) == 0, model.trans, model.start)
    assert p[:10, 0].min() > 0.5 and p[10:, 1].min() > 0.5


@pytest.mark.parametrize("word", ["a", "né", "漢" * 300, "abcd" * 5_000])
def test_a_word_has_all_its_letter_ngrams_and_affixes(word):
    ids, owner = language.features(["xy", word, "z"], [{word}, set()])
    padded = len(word) + 2
    ngrams = sum(max(0, padded - n + 1) for n in language.ORDERS)
    assert (owner == 1).sum() == ngrams + len(language.PREFIXES) + len(language.SUFFIXES) + 1 + 1
    alone, _ = language.features([word], [{word}, set()])
    assert sorted(ids[owner == 1]) == sorted(alone) and ids.min() >= 0 and ids.max() < language.FEATURES


def test_equal_ngrams_have_equal_features():
    ids, owner = language.features(["abc", "xabc", "abd"], [])
    a, b, c = (set(ids[owner == k]) for k in range(3))
    assert len(a & b) >= 7 and len(a & c) >= 6 and a != b


def test_training_rows_do_not_depend_on_order(documents):
    own = next(k for k in range(99) if zlib.crc32(str(k).encode()) % 3 != 1)
    rows = [(own, f"text number {'abcdefg'[k]}", "en", "a") for k in range(7)] + [(k, f"words {k}", "en", "a") for k in range(100, 130)]
    one = sorted(map(tuple, language.training_rows(documents(rows)).collect()))
    two = sorted(map(tuple, language.training_rows(documents(rows[::-1]).repartition(5)).collect()))
    assert one == two and [r[0] for r in one].count(own) == 1


def test_language_without_labels(documents):
    assert [r["lang_pred"] for r in language.identify(documents([(1, "abc", None, "a")])).collect()] == ["und"]
    assert language.identify(documents([])).collect() == []
