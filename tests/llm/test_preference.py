import random

import pytest
from leafgrid.llm import preference


def turns_of(spark, rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pair_id", F.lit("clash")).withColumn("side", F.lit("clash"))


def brute(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    out = lambda t: f"<|{t[0] or ''}|>\n{t[1] or ''}\n"

    def side(ts):
        text, mask = "", []
        for t in ts:
            if t[0] == "assistant":
                mask.append((len(text) + len(t[0]) + 5, len(text) + len(out(t))))
            text += out(t)
        return text, mask

    (c, cm), (r, rm) = side(a[n:]), side(b[n:])
    return n, "".join(map(out, a[:n])), c, r, cm, rm


@pytest.mark.parametrize("seed", range(3))
def test_pairs_match_brute_force(spark, seed):
    rng = random.Random(seed)
    convs = {}
    for k in range(40):
        head = convs[k - 1][: rng.randint(0, 4)] if k % 2 else []
        convs[k] = list(head) + [(rng.choice(["user", "assistant", None]), rng.choice(["é\U0001f600", "a\nb", None, "long text", ""])) for _ in range(rng.randint(0, 4))]
    rows = [(k, i, r, t) for k, ts in convs.items() for i, (r, t) in enumerate(ts)]
    rng.shuffle(rows)
    pairs = spark.createDataFrame([(k, 2 * k, 2 * k + 1) for k in range(20)] + [(None, 0, 1), (98, 0, 0), (99, None, 3), (0, 0, 1)], "pair_id long, chosen_id long, rejected_id long")
    got = {r["pair_id"]: r for r in preference.preferences(turns_of(spark, rows), pairs).collect()}
    assert set(got) == {*range(20), 98, 99}
    for p, (c, j) in {**{k: (2 * k, 2 * k + 1) for k in range(20)}, 98: (0, 0), 99: (None, 3)}.items():
        r = got[p]
        shown = (r["prefix_turns"], r["prompt"], r["chosen"], r["rejected"], [tuple(x) for x in r["chosen_mask"]], [tuple(x) for x in r["rejected_mask"]])
        assert shown == brute(convs.get(c, []), convs.get(j, []))


def test_masks_cover_the_answers(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "yes"), (1, 0, "user", "q"), (1, 1, "assistant", "no"), (1, 2, "user", "why"), (2, 0, "user", "alone")]
    turns = turns_of(spark, rows)
    got = {r["pair_id"]: r for r in preference.preferences(turns, preference.neighbour_pairs(turns)).collect()}
    r = got[0]
    assert r["prompt"] == "<|user|>\nq\n" and [r["chosen"][s["start"] : s["end"]] for s in r["chosen_mask"]] == ["yes\n"]
    assert [r["rejected"][s["start"] : s["end"]] for s in r["rejected_mask"]] == ["no\n"]
    assert got[1]["rejected_id"] is None and got[1]["chosen"] == "<|user|>\nalone\n"


def test_empty_tables(spark):
    turns = turns_of(spark, [])
    assert preference.preferences(turns, preference.neighbour_pairs(turns)).collect() == []
