import random
import re

import pytest
from leafgrid.llm import decontamination as dc
from pyspark.sql import functions as F

from .conftest import prose


@pytest.fixture(scope="module")
def benchmark(spark):
    def make(rows):
        return spark.createDataFrame(rows, "item_id long, text string").withColumn("doc_id", F.lit("clash")).withColumn("canon", F.lit("clash"))

    return make


ITEM = "A farmer has 12 apples and gives 5 apples to his friend Mary Ann while keeping the other ones, and after 3 days the farmer buys 12 kg of pears. How many apples and pears does the farmer have now?"


def ids(df):
    return sorted((r["doc_id"], r["item_id"]) for r in df.collect())


def test_copies_and_new_parameters(documents, benchmark):
    rng = random.Random(1)
    same = ITEM.replace("12", "40").replace("5", "7").replace("3 days", "9 weeks").replace("Mary Ann", "John")
    mixed = ITEM
    for k in range(9):
        mixed = re.sub(r"\b12\b", str(100 + k), mixed, count=1)
    rows = [
        (1, f"{prose(rng, 30)}. {ITEM} {prose(rng, 30)}", "en", "a"),
        (2, f"{prose(rng, 30)}. {same} {prose(rng, 30)}", "en", "a"),
        (3, prose(rng, 200), "en", "a"),
        (4, ITEM.upper(), "en", "a"),
        (5, "A farmer has 12 apples and gives 5 apples away.", "en", "a"),
        (6, None, "en", "a"), (7, "", "en", "a"), (None, ITEM, "en", "a"), (1, f"{prose(rng, 3)}. {ITEM}", "en", "a"),
    ]
    got = dc.leaks(documents(rows), benchmark([(7, ITEM), (8, prose(rng, 40)), (9, None), (None, ITEM), (7, ITEM)]))
    assert ids(got.where("doc_id is not null")) == [(1, 7), (1, 7), (2, 7), (4, 7)]
    assert got.where("doc_id is null").count() == 1
    two = got.where("doc_id = 2").first()
    assert two["slots"] > 0 and two["slot_conflicts"] == 0


def test_inconsistent_slots_are_no_leak(documents, benchmark):
    item = "the first box holds 5 red balls and the next box holds 5 blue balls and the last box holds 5 green balls in all"
    scattered = "the first box holds 5 red balls and the next box holds 6 blue balls and the last box holds 7 green balls in all"
    moved = scattered.replace("6", "5").replace("7", "5").replace("5", "8")
    got = dc.leaks(documents([(1, scattered, "en", "a"), (2, moved, "en", "a")]), benchmark([(1, item)]))
    assert ids(got) == [(2, 1)]


def test_short_items_match_as_a_whole(documents, benchmark):
    got = dc.leaks(documents([(1, "x y what is this z", "en", "a"), (2, "what is that", "en", "a")]), benchmark([(1, "What is this"), (2, "some longer text of more than eight words for the mix")]))
    assert ids(got) == [(1, 1)]


def test_matches_brute_force_on_plain_words(documents, benchmark):
    rng = random.Random(4)
    items = [(k, prose(rng, rng.randint(8, 40))) for k in range(12)]
    rows = []
    for d in range(60):
        words = prose(rng, 80).split()
        k = rng.randrange(12)
        part = items[k][1].split()
        a, b = sorted(rng.sample(range(len(part) + 1), 2))
        rows.append((d, " ".join(words[:40] + part[a:b] + words[40:]), "en", "a"))
    windows = {k: {tuple(t.split()[i : i + 8]) for i in range(len(t.split()) - 7)} for k, t in items}
    want = []
    for d, t, _, _ in rows:
        w = t.split()
        own = {tuple(w[i : i + 8]) for i in range(len(w) - 7)}
        want += [(d, k) for k, s in windows.items() if len(s & own) >= -(-3 * len(s) // 10) and s & own]
    assert ids(dc.leaks(documents(rows), benchmark(items))) == sorted(want)


def test_broadcast_and_shuffle_agree(documents, benchmark, monkeypatch, hard_rows):
    items = [(k, t) for k, (_, t, _, _) in enumerate(hard_rows[:30])]
    df = documents(hard_rows)
    a = ids(dc.leaks(df, benchmark(items)).where("doc_id is not null"))
    monkeypatch.setattr(dc, "maybe_broadcast", lambda d, limit=0: d)
    assert a and a == ids(dc.leaks(df, benchmark(items)).where("doc_id is not null"))
    left = dc.decontaminated(df, benchmark(items))
    assert left.columns == df.columns
    assert not {r["doc_id"] for r in left.collect()} & {d for d, _ in a}
    bad = {t for _, t, _, _ in hard_rows[:30] if t}
    assert left.count() >= len([r for r in hard_rows if r[1] not in bad]) - 5


def test_empty_tables(documents, benchmark):
    assert dc.leaks(documents([]), benchmark([(1, ITEM)])).collect() == []
    assert dc.leaks(documents([(1, ITEM, "en", "a")]), benchmark([])).collect() == []
    assert dc.decontaminated(documents([(1, ITEM, "en", "a")]), benchmark([])).count() == 1


def test_items_of_slots_are_found(documents, benchmark):
    item = "What is 17 + 25 * 3 - 12 + 4 * 9?"
    units = "3 kg in 4 m and 5 cm of 6 km at 7 mph for 8 hours"
    rows = [
        (1, f"some words before. {item} and after", "en", "a"),
        (2, item.replace("17", "18").replace("25", "26"), "en", "a"),
        (3, "what is 17 or 25 and so on", "en", "a"),
        (4, "a table of 1 2 3 4 5 6 7 8 9 10 numbers", "en", "a"),
        (5, f"text {units} text", "en", "a"),
        (6, "3 kg in 9 m", "en", "a"),
        (7, "7 3 8 2 9 1 6 4 5", "en", "a"),
    ]
    got = dc.leaks(documents(rows), benchmark([(1, item), (2, units), (3, "7 3 8 2 9 1 6 4 5")]))
    assert ids(got) == [(1, 1), (2, 1), (5, 2), (7, 3)]
    assert got.where("doc_id = 1").first()["slot_conflicts"] == 0


def test_a_copy_after_a_passage_of_its_form(documents, benchmark):
    rng = random.Random(6)
    item = "the old baker sells 12 loaves of bread to every guest in town and then he closes his small shop for the whole winter"
    early = "the old baker sells 30 loaves of bread to nobody"
    edited = item.replace("in town", "in our own lovely little town")
    rows = [(1, f"{early} {prose(rng, 60)} {item}", "en", "a"), (2, f"{early} {prose(rng, 200)} {edited} {prose(rng, 20)}", "en", "a")]
    rows += [(3, f"{early} {prose(rng, 60)}", "en", "a")]
    assert ids(dc.leaks(documents(rows), benchmark([(1, item)]))) == [(1, 1), (2, 1)]
